"""The ten operators against brute force on small tables with awkward rows."""

import hashlib
import io
import math
import random
import wave
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from accordion.llm import common, html_text, media, mixing, ngram_join, oracles, packing, quality, queries, substring_dedup, suffix_dedup, token_counts, toxicity

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, bucket int"
WORDS = [f"w{i}" for i in range(400)]


def words(text):
    return (text or "").encode().split()


@pytest.fixture(scope="module")
def rows():
    """Copies, near copies, shared passages, empty, null, one-word, long and repeating
    texts, repeated rows, and null ids; columns whose names the operators use too."""
    rng = random.Random(5)
    say = lambda n: " ".join(rng.choice(WORDS) for _ in range(n))
    passage, line = say(60), say(8) + ".\n"
    out = []
    for i in range(160):
        kind = i % 8
        text = say(rng.choice([3, 30, 120, 200]))
        if kind == 1 and i > 8:
            text = out[rng.randrange(len(out))][1]
        elif kind == 2 and i > 8:
            w = (out[rng.randrange(len(out))][1] or "x").split()
            for _ in range(max(1, len(w) // 40)):
                w[rng.randrange(len(w))] = rng.choice(WORDS).upper()
            text = " ".join(w) if w else "x"
        elif kind == 3:
            text = f"{say(20)} {passage}\n{line}{say(15)}"
        elif kind == 4:
            text = (rng.choice(WORDS) + " ") * rng.choice([5, 40])
        out.append((i, text, "en", f"s{i % 3}" if i % 11 else None, len(text), "x", 1))
    out += [(200, None, None, None, None, None, None), (201, "", "en", "s0", 0, "x", 1), (202, " \t\n ", "en", "s0", 4, "x", 1), (203, "one", "en", "s0", 3, "x", 1)]
    out += [(204, "é ü 漢字   x y " * 40, "en", "s1", 9, "x", 1), (205, say(6000) + " " + passage, "en", "s1", 9, "x", 1), out[3], out[3]]
    out += [(206, "x" * 3000, "en", "s1", 9, "x", 1), (207, "y" + "x" * 900, "en", "s1", 9, "x", 1)]
    return out


@pytest.fixture(scope="module")
def docs(spark, rows):
    common.shipped(spark)
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


# ---- 9 -------------------------------------------------------------------------------
def words_removed(rows, k=13):
    least = {}
    for i, text, *_ in rows:
        w = words(text)
        for p in range(len(w) - k + 1):
            key = tuple(w[p : p + k])
            least[key] = min(least.get(key, i), i)
    out = []
    for i, text, *_ in rows:
        w = words(text)
        gone = [False] * len(w)
        for p in range(len(w) - k + 1):
            if least[tuple(w[p : p + k])] < i:
                gone[p : p + k] = [True] * k
        kept = [x for x, g in zip(w, gone, strict=True) if not g]
        out.append((i, len(w), sum(gone), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return sorted(out)


def test_substring_dedup(docs, rows):
    got = substring_dedup.dedup_words(docs).select("_id", "n_words", "n_removed", "kept_sha256").collect()
    assert sorted(map(tuple, got)) == words_removed(rows)
    trimmed = substring_dedup.without_repeats(docs)
    assert trimmed.columns == docs.columns and trimmed.count() == len(rows)


def test_substring_dedup_small_window_null_id_and_empty(spark, empty):
    rows = [(2, "a b c d", "", "", 0, "", 0), (None, "b c", "", "", 0, "", 0), (3, "a b c d", "", "", 0, "", 0)]
    got = {r["_id"]: (r["n_words"], r["n_removed"]) for r in substring_dedup.dedup_words(spark.createDataFrame(rows, SCHEMA), 2).collect()}
    assert got == {common.NO_ID: (2, 0), 2: (4, 2), 3: (4, 4)}
    assert substring_dedup.dedup_words(empty).count() == 0


# ---- 7 -------------------------------------------------------------------------------
def bytes_removed(rows, k):
    seen = Counter()
    for _, text, *_ in rows:
        b = (text or "").encode()
        seen.update(b[p : p + k] for p in range(len(b) - k + 1))
    out = []
    for i, text, *_ in rows:
        b = (text or "").encode()
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - k + 1):
            if seen[b[p : p + k]] > 1:
                gone[p : p + k] = True
        spans = int((np.diff(np.r_[False, gone].astype(int)) == 1).sum())
        out.append((i, len(b), int(gone.sum()), spans, hashlib.sha256(np.frombuffer(b, np.uint8)[~gone].tobytes()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("k, hot", [(400, 4096), (50, 4096), (50, 2), (400, 2)])
def test_suffix_dedup(docs, rows, k, hot, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    got = [tuple(r) for r in suffix_dedup.dedup_bytes(docs, k).collect()]
    assert sorted(got, key=str) == bytes_removed(rows, k)


def test_suffix_dedup_empty(empty):
    assert suffix_dedup.dedup_bytes(empty).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=200))
def test_two_stage_sorting(values):
    text = np.array(values, np.uint8)
    raw = text.tobytes()
    got = suffix_dedup.suffix_array(text, 12).tolist()
    assert sorted(got) == list(range(len(raw)))
    assert [raw[i : i + 12] for i in got] == sorted(raw[i : i + 12] for i in range(len(raw)))


# ---- 3 -------------------------------------------------------------------------------
def shingles(text, k=5):
    w = bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode()).split()
    return frozenset(tuple(w[p : p + k]) for p in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def components_of(rows):
    sets = [(i, shingles(t)) for i, t, *_ in rows]
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                parent[find(a)] = find(b)
    least = {}
    for n, (i, _) in enumerate(sets):
        least[find(n)] = min(least.get(find(n), i), i)
    return sorted((i, len(s), least[find(n)] if s else i) for n, (i, s) in enumerate(sets))


def test_ngram_join(docs, rows):
    got = sorted(tuple(r) for r in ngram_join.link_components(docs).select("_id", "n", "component").collect())
    assert got == components_of(rows)
    kept = ngram_join.one_of_each(docs)
    groups = {c for _, n, c in components_of(rows) if n}
    assert kept.columns == docs.columns
    assert kept.where("n_chars is not null and trim(translate(text, '\t\n', '')) <> ''").count() == len(groups)


@pytest.mark.parametrize(("seed", "block"), [(0, 800), (1, 800), (2, 800), (0, 4), (1, 2)])
def test_ngram_join_chains_at_the_threshold(spark, seed, block, monkeypatch):
    """Chains of texts that each link with the next only, equal profiles of many sizes, and
    a passage that unlike texts share; in one block, and in many of few sets each."""
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    monkeypatch.setattr(ngram_join, "PIVOTS", min(block // 2, ngram_join.PIVOTS))
    rng = random.Random(seed)
    out, w = [], [rng.choice(WORDS) for _ in range(60)]
    for i in range(40):
        out.append((i, " ".join(w), "", "", 0, "", 0))
        cut = rng.choice([1, 2, 3, 4])
        w = w[cut:] + [f"{i}x{j}" for j in range(cut)]
    passage = [rng.choice(WORDS) for _ in range(60)]
    for i in range(40, 90):
        own = [f"{i}y{j}" for j in range(rng.choice([0, 2, 5, 8, 12, 15, 20]))]
        out.append((i, " ".join(passage + own if i % 2 else own + passage), "", "", 0, "", 0))
    got = sorted(tuple(r) for r in ngram_join.link_components(spark.createDataFrame(out, SCHEMA)).select("_id", "n", "component").collect())
    assert got == components_of(out)


def test_ngram_join_empty(empty):
    assert ngram_join.link_components(empty).count() == 0


# ---- 1 -------------------------------------------------------------------------------
def base_features(text):
    w = words(text)
    t = text or ""
    seen = Counter(tuple(w[p : p + 8]) for p in range(len(w) - 7))
    hit = set()
    for p in range(len(w) - 7):
        if seen[tuple(w[p : p + 8])] > 1:
            hit |= set(range(p, p + 8))
    lines = [x for x in t.split("\n") if words(x)]
    return len(w), sum(len(x.decode()) for x in w), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(hit)


def test_quality(docs, rows, empty):
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    got = sorted((r["doc_id"], *(r[n] for n in names), r["base_failed"]) for r in quality.judge(docs).collect())
    want = []
    for i, text, *_ in rows:
        f = base_features(text)
        want.append((i, *f, f[0] < 20 or 100 * f[4] > 30 * f[0]))
    assert got == sorted(want)
    assert quality.judge(empty).count() == 0


def test_quality_estimates(spark):
    """The fold over patterns equals plain expectation-maximisation."""
    rng = random.Random(2)
    counts = Counter()
    for _ in range(3000):
        good = rng.random() < 0.8
        counts[tuple((1 if good == (rng.random() < a) else -1) if rng.random() < 0.7 else 0 for a in (0.9, 0.8, 0.7))] += 1
    share, acc = 0.8, [0.8] * 3
    for _ in range(quality.ROUNDS):
        post = {v: 1 / (1 + math.exp(-math.log(share / (1 - share)) - sum(x * math.log(a / (1 - a)) for x, a in zip(v, acc, strict=True)))) for v in counts}
        share = min(0.99, max(0.01, sum(n * post[v] for v, n in counts.items()) / sum(counts.values())))
        acc = [min(0.99, max(0.55, sum(n * (post[v] if v[r] == 1 else 1 - post[v]) for v, n in counts.items() if v[r]) / sum(n for v, n in counts.items() if v[r]))) for r in range(3)]
    table = spark.createDataFrame([(list(v), n) for v, n in counts.items()], "votes array<int>, n long")
    got = quality.posteriors(table, 3).first()
    assert abs(got["share"] - share) < 1e-9 and np.allclose(got["accuracy"], acc) and abs(acc[0] - 0.9) < 0.05


# ---- 4 -------------------------------------------------------------------------------
def test_toxicity_learns_and_scores_any_text(spark):
    rng = random.Random(1)
    bad = ["grimble", "snorfle", "wexlet"]
    texts, marks = [], []
    for i in range(600):
        w = [rng.choice(WORDS).replace("w", "word") + rng.choice("abcdef") for _ in range(rng.choice([20, 90, 200]))]
        if i % 2:
            for _ in range(4):
                w[rng.randrange(len(w))] = rng.choice(bad)
        texts.append(" ".join(w))
        marks.append(i % 2)
    model = toxicity.train(texts[:400], marks[:400])
    raw = [t.encode() for t in [*texts[400:], "", " ", "GRIMBLE".lower()]]
    got = toxicity.scores(model, np.frombuffer(b"".join(raw), np.uint8), np.r_[0, np.cumsum(list(map(len, raw)))].astype(np.int64))
    assert ((got[:200] >= 0.5) == np.array(marks[400:])).mean() > 0.97
    assert got[200] == got[201] < 0.1 and ((got >= 0) & (got <= 1)).all()
    long = (" ".join(texts[0:400:2]) + " grimble snorfle wexlet grimble").encode()  # a sign at the very end
    assert toxicity.scores(model, np.frombuffer(long, np.uint8), np.array([0, len(long)]))[0] >= 0.5
    assert toxicity.train([], []) is None and toxicity.train(["a"], [1]) is None


def test_toxicity_gradients():
    """Back-propagation equals differences."""
    rng = np.random.default_rng(0)
    raw = b"aa bb cc dd ee ff aa gg"
    x = toxicity.Inputs(np.frombuffer(raw, np.uint8), np.array([0, 11, len(raw)]))
    m = {k: v.astype(np.float64) for k, v in toxicity._start(rng).items()}
    vec, (grid, active) = toxicity.vectors(m, x), x.grid()

    def loss(m):
        return float(toxicity.forward(m, toxicity.vectors(m, x), grid, active)[0].sum())

    _, kept = toxicity.forward(m, vec, grid, active, True)
    g = toxicity._gradients(m, x, vec, grid, active, kept, np.ones(2))
    for k in ("W0", "U1", "c0", "A", "v", "w", "b1"):
        at = np.unravel_index(np.abs(g[k]).argmax(), g[k].shape)
        up, down = ({**m, k: m[k].copy()} for _ in range(2))
        up[k][at] += 1e-2
        down[k][at] -= 1e-2
        assert abs((loss(up) - loss(down)) / 2e-2 - g[k][at]) < 2e-2 * max(1, abs(g[k][at]))


def test_toxicity_query_shape(spark, docs, empty):
    labels = spark.createDataFrame([(i, i % 2) for i in range(0, 60)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    got = toxicity.clean_documents(docs, labels.where("false"))
    assert got.columns == docs.columns and got.count() == docs.count()  # no labels: nothing is rejected
    scored = toxicity.score_documents(docs.select("doc_id", "text"), model)
    assert scored.count() == docs.count() and scored.where("score < 0 or score > 1 or score is null").count() == 0
    assert toxicity.score_documents(empty.select("doc_id", "text"), model).count() == 0
    assert spark.range(30).where(toxicity.held_out(F.col("id"))).count() == sum(zlib.crc32(str(i).encode()) % 5 == 0 for i in range(30))


# ---- 6 -------------------------------------------------------------------------------
def test_media(docs, rows, empty):
    got = {}
    for r in media.media_rows(docs, with_media=True).collect():
        with wave.open(io.BytesIO(r["media"])) as w:
            payload = w.readframes(w.getnframes())
        assert hashlib.sha256(payload).hexdigest() == r["payload_sha256"] and zlib.crc32(payload[-64:]) == r["tail_crc32"]
        assert (len(payload), len(r["media"]), hashlib.sha256(r["media"]).hexdigest()) == (r["payload_bytes"], r["media_bytes"], r["media_sha256"])
        assert all(0 < (x >> 16 & 255) <= 128 and 1 <= (x & 255) <= media.REACH for x in r["fingerprint"])
        got[r["doc_id"]] = (payload, r["n_bytes"], r["feature"])
    for i, text, *_ in rows:
        raw = (text or "").encode()
        assert got[i][0] == raw.ljust(max(64, -(-len(raw) // 64) * 64), b"\0") and got[i][1] == len(raw)
    by_text = {}
    for i, text, *_ in rows:
        assert by_text.setdefault(text or "", got[i][2]) == got[i][2]
    assert media.media_rows(empty).count() == 0


def test_media_long_payload_equals_its_frames():
    rng = np.random.default_rng(3)
    long = rng.integers(0, 255, 64 * 40_000).astype(np.uint8).tobytes()
    alone, beside = media.fingerprints([long])[0], media.fingerprints([b"\0" * 64, long, b"x" * 640])[1]
    assert np.array_equal(alone, beside) and len(alone) > 100


# ---- 2 -------------------------------------------------------------------------------
@pytest.mark.parametrize("entropy, repeats", [(0.97, 1.5), (0.8, 9.0), (1.0, 3.0)])
def test_mixing_meets_its_targets(docs, rows, entropy, repeats):
    got = mixing.copies_of(mixing.token_rows(docs), entropy, repeats, 100).collect()
    assert len(got) == len(rows) and all(r["copies"] >= 1 for r in got)
    tokens, mixed = Counter(), Counter()
    for r in got:
        tokens[r["src"]] += r["n_tokens"]
        mixed[r["src"]] += r["n_tokens"] * r["copies"]
    a, weights, budget = mixing.mix_weights(dict(tokens), entropy, repeats)
    most = max(weights[s] * budget / tokens[s] for s in tokens)
    spread = -sum(w * math.log(w) for w in weights.values())
    assert most <= repeats + 1e-9 and abs(sum(weights.values()) - 1) < 1e-12
    assert a == 1 or abs(most - repeats) < 1e-6 or abs(spread - entropy * math.log(len(weights))) < 1e-6 or a < 1e-9
    for s in tokens:  # within a text's length of the goal
        assert weights[s] * budget - 7000 <= mixed[s] <= max(tokens[s], weights[s] * budget + 1)
    out = mixing.mixed(docs, entropy, repeats, 100)
    assert out.columns == docs.columns and out.count() == sum(r["copies"] for r in got)


def test_mixing_empty(empty):
    assert mixing.copies_of(mixing.token_rows(empty)).count() == 0 and mixing.mixed(empty).count() == 0


@pytest.mark.parametrize("name", sorted(oracles.ORACLES))
def test_sql(spark, duck, name):
    from conftest import SMALL

    got = queries.queries()[name](spark, SMALL).toPandas().sort_values("doc_id").reset_index(drop=True)
    want = duck.sql(oracles.ORACLES[name]).df().sort_values("doc_id").reset_index(drop=True)
    assert sorted(got.columns) == sorted(want.columns)
    for c in got.columns:
        assert (got[c] == want[c]).all(), c


# ---- 5 -------------------------------------------------------------------------------
def test_packing(docs, rows, empty):
    texts = packing.packing_rows(docs)
    got = packing.pack(texts, capacity=256, per_source=2, shard_rows=50).collect()
    whole = Counter()
    for r in got:
        whole[r["doc_id"]] += r["n_tokens"]
    want = Counter()
    for i, text, *_ in rows:
        want[i] += len(words(text))
    assert whole == want
    source, cluster = {}, {}
    for r in texts.collect():
        source[r["doc_id"]], cluster[r["doc_id"]] = r["source"], r["cluster"]
    bins = {}
    for r in got:
        if r["bin_id"] is not None:
            bins.setdefault(r["bin_id"], []).append(r)
        else:
            assert r["n_tokens"] == 0
    for held in bins.values():
        held.sort(key=lambda r: r["place"])
        assert sum(r["n_tokens"] for r in held) <= 256
        assert all(a["place"] + a["n_tokens"] == b["place"] for a, b in zip(held, held[1:], strict=False))
        assert max(Counter(source[r["doc_id"]] for r in held).values()) <= 2
        assert max(Counter(cluster[r["doc_id"]] for r in held).values()) == 1
    assert packing.pack(packing.packing_rows(empty)).count() == 0


@settings(max_examples=80, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 30), st.integers(0, 3), st.integers(0, 6)), max_size=60))
def test_best_fit_takes_the_tightest(parts):
    got = packing.best_fit(parts, 30, 2)
    room, held = [], []
    for (size, source, cluster), (number, place) in zip(parts, got, strict=True):
        fits = [(room[b], b) for b in range(len(room)) if room[b] >= size and all(c != cluster for _, c in held[b]) and sum(s == source for s, _ in held[b]) < 2]
        if fits:
            assert room[number] == min(fits)[0] and place == 30 - room[number]
        else:
            assert number == len(room)
            room.append(30)
            held.append([])
        room[number] -= size
        held[number].append((source, cluster))


# ---- 8 -------------------------------------------------------------------------------
@pytest.fixture(scope="module")
def encoder():
    with open(token_counts.VOCABULARY, "rb") as f:
        return token_counts.Encoder(f.read())


def test_token_counts(docs, rows, encoder, empty):
    got = {r["doc_id"]: r for r in token_counts.count_tokens(docs).collect()}
    for i, text, _, source, *_ in rows:
        after = text or ""
        for a, b, new in token_counts.edits_of(after, source or ""):
            after = after[: min(a, len(after))] + new + after[min(b, len(after)) :]
        assert got[i]["n_tokens"] == len(encoder.whole.encode_ordinary(text or ""))
        assert got[i]["n_tokens_after"] == len(encoder.whole.encode_ordinary(after))
    assert got[205]["n_reencoded"] < got[205]["n_pretokens"] / 20
    assert token_counts.count_tokens(empty).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.text("ab '\n1!é ", max_size=60), st.lists(st.tuples(st.integers(0, 70), st.integers(0, 12), st.text("ab '\nl", max_size=5)), max_size=8))
def test_token_edits(encoder, text, edits):
    tree = token_counts.TokenTree(text, encoder)
    for a, n, new in edits:
        b = min(a, len(text))
        text = text[:b] + new + text[min(b + n, len(text)) :]
        tree.replace(a, min(a, len(tree.text)) + n, new)
        assert tree.text == text and tree.total() == len(encoder.whole.encode_ordinary(text))


# ---- 10 ------------------------------------------------------------------------------
@pytest.mark.parametrize(
    "page, text",
    [
        (None, ""),
        ("", ""),
        ("plain &amp; simple", "plain & simple"),
        ("<p>one<p>two", "one\n\ntwo"),
        ("<div>a</div><div>b</div>", "a\nb"),
        ("a<br>b<br/>c", "a\nb\nc"),
        ("<ul><li>a<li>b<ul><li>c</ul></ul>", "- a\n- b\n  - c"),
        ("<ol start=9><li>a</li><li>b</ol>", "9. a\n10. b"),
        ("<table><tr><td>a<td>bb<tr><td>ccc<td>d</table>", "a    bb\nccc  d"),
        ("<table><td>a<td>b</table>", "a  b"),
        ("<head><title>t</title></head><body>x<script>if (a < b) '</p>'</script><style>p{}</style>y<!-- z -->", "xy"),
        ("<p hidden>a</p><p style='color:red; display : none'>b</p><p style=visibility:hidden>c</p><p data-hidden=1>d</p>", "d"),
        ("<pre>  a\n   b</pre>", "  a\n   b"),
        ("a <b>b</b>  <i> c</i>", "a b c"),
        ("</p></div>x<div", "x<div"),
        ("<textarea>a<b</textarea>", "a<b"),
        ('<img alt="A &gt; B"><a href="x>y">l</a>', "A > Bl"),
        ("<dl><dt>k<dd>v</dl>", "k\n    v"),
        ("<h1>T</h1>text", "T\n\ntext"),
    ],
)
def test_html(page, text):
    assert html_text.Page(page).text == text


def test_html_deep_and_table(spark):
    assert html_text.Page("<div>" * 30_000 + "x").text == "x"
    rows = spark.createDataFrame([(1, "u", "<p>a"), (2, None, None), (1, "u", "<p>a")], "page_id long, url string, html string")
    got = sorted((r["page_id"], r["text"], r["n_chars"]) for r in html_text.extract(rows).collect())
    assert got == [(1, "a", 1), (1, "a", 1), (2, "", 0)]
    assert html_text.extract(rows.where("false")).count() == 0


# ---- together ------------------------------------------------------------------------
def test_window_minima():
    rng = np.random.default_rng(1)
    grams = rng.integers(0, 5, 300).astype(np.uint64) << np.uint64(32)
    for w in (1, 2, 9, 100):
        got = common.window_minima(grams, w)
        assert got.tolist() == [max(range(p, p + w), key=lambda q: (-int(grams[q]), q)) for p in range(len(grams) - w + 1)]


def test_every_operator_is_registered():
    assert [sum(n.startswith(f"op{i}_") for n in queries.queries()) for i in range(1, 11)] == [1] * 10
