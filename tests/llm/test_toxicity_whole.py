"""Operator 4: the network against plain loops, the sample's bounds, and clashing columns."""

import math

import numpy as np
import pytest

from accordion.llm import common, toxicity


def plain_score(m, tokens):
    """The highest window's probability, number by number."""
    sig = lambda v: 1 / (1 + math.exp(-v))

    def vector(word):
        raw = word.encode()
        data = np.frombuffer(raw, np.uint8)
        h = int(common.span_hashes(data, np.array([0]), np.array([len(raw)]))[0])
        chars = [0, *(b + 1 for b in raw), 0]
        grams = [int(common.mix(np.array([a * 66_049 + b * 257 + c], np.uint64))[0]) % toxicity.GRAMS for a, b, c in zip(chars, chars[1:], chars[2:], strict=False)]
        return [float(v) for v in m["word"][h % toxicity.WORDS]] + [sum(float(m["gram"][g][j]) for g in grams) / len(grams) for j in range(toxicity.DIM)]

    def run(vectors, d):
        H, h, out = toxicity.HIDDEN, [0.0] * toxicity.HIDDEN, []
        W, b, U, c = (m[f"{n}{d}"].astype(float) for n in "WbUc")
        for x in vectors:
            gate = [sum(x[i] * W[i, j] for i in range(len(x))) + b[j] for j in range(3 * H)]
            rec = [sum(h[i] * U[i, j] for i in range(H)) for j in range(3 * H)]
            z = [sig(gate[j] + rec[j]) for j in range(H)]
            r = [sig(gate[H + j] + rec[H + j]) for j in range(H)]
            new = [math.tanh(gate[2 * H + j] + r[j] * (rec[2 * H + j] + c[j])) for j in range(H)]
            h = [(1 - z[j]) * new[j] + z[j] * h[j] for j in range(H)]
            out.append(h)
        return out

    best = -math.inf
    starts = range(0, max(1, len(tokens) - toxicity.WINDOW + toxicity.STRIDE), toxicity.STRIDE)
    for a in starts:
        vectors = [vector(t) for t in tokens[a : a + toxicity.WINDOW]]
        states = [f + b for f, b in zip(run(vectors, 0), run(vectors[::-1], 1)[::-1], strict=True)]
        level = []
        for s in states:
            hidden = [math.tanh(sum(s[i] * float(m["A"][i, j]) for i in range(len(s))) + float(m["a"][j])) for j in range(toxicity.ATTEND)]
            level.append(sum(h * float(v) for h, v in zip(hidden, m["v"], strict=True)))
        share = [math.exp(x - max(level)) for x in level]
        pooled = [sum(w * s[i] for w, s in zip(share, states, strict=True)) / sum(share) for i in range(len(states[0]))]
        best = max(best, sum(p * float(w) for p, w in zip(pooled, m["w"], strict=True)) + float(m["o"][0]))
    return sig(best)


def test_scores_equal_plain_loops():
    rng = np.random.default_rng(4)
    m = toxicity._start(rng)
    m = {k: (v + rng.normal(0, 0.4, v.shape)).astype(np.float32) for k, v in m.items()}
    texts = [[f"w{chr(97 + i % 26)}{chr(97 + (i * j) % 26)}" for i in range(n)] for j, n in enumerate((1, 7, 48, 49, 88, 89, 130), 3)]
    raw = [" ".join(t).encode() for t in texts]
    got = toxicity.scores(m, np.frombuffer(b"".join(raw), np.uint8), np.r_[0, np.cumsum([len(r) for r in raw])].astype(np.int64))
    assert np.allclose(got, [plain_score(m, t) for t in texts], atol=1e-4)


def test_the_sample_is_bounded_and_has_long_texts(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "PER_CLASS", 5)
    monkeypatch.setattr(toxicity, "PIECE", 50)
    monkeypatch.setattr(toxicity, "LONGEST", 300)
    docs = spark.createDataFrame([(i, "word " * (10 + 20 * i)) for i in range(60)] + [(None, "x")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] * 2 + [(None, 1), (3, None)], "doc_id long, toxic int")
    rows = toxicity.sample(docs, labels).collect()
    assert sum(r["mark"] == 0 for r in rows) == 5 and max(len(r["text"]) for r in rows if not r["mark"]) == 50
    assert all(len(r["text"]) <= 300 for r in rows)
    monkeypatch.setattr(toxicity, "SAMPLE_CHARS", 120)
    assert sum(len(r["text"]) for r in toxicity.sample(docs, labels).where("mark = 0").collect()) <= 120


@pytest.mark.parametrize("name", ["_score", "a.b", "odd`name"])
def test_other_columns_pass_untouched(spark, name):
    docs = spark.createDataFrame([(1, "a b", 5.0), (2, None, None), (1, "a b", 5.0)], "doc_id long, text string, extra double").toDF("doc_id", "text", name)
    out = toxicity.clean_documents(docs, spark.createDataFrame([], "doc_id long, toxic int"))
    assert out.columns == ["doc_id", "text", name] and sorted(map(str, map(tuple, out.collect()))) == sorted(map(str, [(1, "a b", 5.0), (2, None, None), (1, "a b", 5.0)]))
