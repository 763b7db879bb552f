"""Operators 2 and 5 on hot sources, many sources and repeated rows, against brute force."""

from collections import Counter

import pytest
from pyspark.sql import functions as F
from test_operators import SCHEMA

from accordion.llm import mixing, packing

ROWS = [(i, "w " * (i % 17), "en", "hot" if i % 3 else f"s{i % 40}", 0, "x", 1) for i in range(900)] + [(7, "a b c", "en", "hot", 0, "x", 1)] * 200 + [(None, None, None, None, None, None, None)] * 3


def by_hand(rows, entropy, repeats, block_tokens):
    """Copies of each (doc_id, source): plain loops."""
    import hashlib

    h = lambda *p: int(hashlib.md5(":".join(x for x in p if x is not None).encode()).hexdigest()[:8], 16)
    text = lambda d: None if d is None else str(d)
    totals, held = Counter(), Counter()
    for d, t, _, s, *_ in rows:
        totals[s or ""] += len((t or "").split())
        held[d, s or ""] += len((t or "").split())
    _, weights, budget = mixing.mix_weights(dict(totals), entropy, repeats)
    out = {}
    for s, total in totals.items():
        goal = int(weights.get(s, 0) * budget + 1e-6)
        passes = max(1, goal // total) if total else 1
        left, blocks = max(0, goal - passes * total), max(1, -(-total // block_tokens))
        mine = {}
        for (d, source), n in held.items():
            if source == s:
                mine.setdefault(h(text(d), "block") % blocks, []).append((d, n))
                out[d, s] = passes
        for b in sorted(mine, key=lambda b: (h(s, str(b), str(passes)), b)):
            size = sum(n for _, n in mine[b])
            if size <= left:
                for d, _ in mine[b]:
                    out[d, s] += 1
            elif left > 0:
                upto = 0
                for d, n in sorted(mine[b], key=lambda x: (h(text(x[0]), str(passes)), x[0] is not None, x[0] or 0)):
                    upto += n
                    out[d, s] += upto <= left
            left -= size
            if left <= 0:
                break
    return out


@pytest.mark.parametrize(("listed", "ranges", "tokens"), [(100_000, 4096, 100), (3, 4096, 100), (3, 2, 30)])
def test_mixing_equals_plain_loops(spark, listed, ranges, tokens, monkeypatch):
    monkeypatch.setattr(mixing, "LISTED", listed)
    monkeypatch.setattr(mixing, "RANGES", ranges)
    docs = spark.createDataFrame(ROWS, SCHEMA)
    got = mixing.copies_of(mixing.token_rows(docs), 0.9, 3.0, tokens).collect()
    assert len(got) == len(ROWS)
    assert {(r["doc_id"], r["src"]): r["copies"] for r in got} == by_hand(ROWS, 0.9, 3.0, tokens)


def test_packing_spreads_a_repeated_row(spark):
    rows = spark.createDataFrame([(1, "s", 5, 3)] * 500 + [(i, "t", i, 40) for i in range(2, 300)], "doc_id long, source string, cluster long, n_tokens long")
    got = packing.pack(rows, capacity=100, per_source=2, shard_rows=50).withColumn("shard", F.shiftright("bin_id", 24)).collect()
    assert Counter(r["doc_id"] for r in got) == Counter([1] * 500 + list(range(2, 300)))
    shards = Counter(r["shard"] for r in got)
    assert len(shards) > 12 and max(shards.values()) < 90
    assert max(Counter(r["bin_id"] for r in got if r["doc_id"] == 1).values()) == 1


def test_pack_equals_plain_loops(spark):
    """Whole shards: the same bins as a search over all bins, part by part."""
    docs = spark.createDataFrame([(i, "w " * (i * 37 % 300), "en", f"s{i % 2}", 0, "x", 1) for i in range(200)], SCHEMA)
    texts = packing.packing_rows(docs)
    got = sorted((r["doc_id"], r["part"], r["bin_id"], r["place"]) for r in packing.pack(texts, 128, 2, 10**6).where("bin_id is not null").collect())
    parts = []
    for r in sorted(texts.collect(), key=lambda r: (-r["n_tokens"], r["doc_id"])):
        parts += [(min(128, r["n_tokens"] - a), r["doc_id"], a // 128, r["source"], r["cluster"]) for a in range(0, r["n_tokens"], 128)]
    parts.sort(key=lambda p: -p[0])
    bins, want = [], []
    for n, doc, part, source, cluster in parts:
        fits = [(b[0], i) for i, b in enumerate(bins) if b[0] >= n and cluster not in b[2] and b[1][source] < 2]
        if fits:
            i = min(fits)[1]
        else:
            i = len(bins)
            bins.append([128, Counter(), set()])
        want.append((doc, part, i, 128 - bins[i][0]))
        bins[i][0] -= n
        bins[i][1][source] += 1
        bins[i][2].add(cluster)
    assert got == sorted(want)
