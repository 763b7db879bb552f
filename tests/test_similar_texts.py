"""Similar texts: large blocks, copies and odd rows against brute force and the query's SQL, and the time that long
texts take."""

import math
import random
import time

import numpy as np
import pytest

from accordion.operators import similar_texts
from accordion.plans import record_queries, registry

SCHEMA = "doc_id long, text string, lang string"


def grams(text: str) -> set:
    padded = f"  {text.lower()} "
    return {padded[i : i + 3] for i in range(len(padded) - 2)}


def drawn(seed: int, n: int, length: int) -> list[str]:
    """Texts of one opening, some with few or many words changed, some copied."""
    rng = random.Random(seed)
    words = ["".join(rng.choices("abcdefghij", k=rng.randrange(2, 7))) for _ in range(400)]
    out = []
    for _ in range(n):
        body = rng.choice(out).split()[1:] if out and rng.random() < 0.6 else rng.choices(words, k=rng.randrange(length // 4, length))
        for _ in range(rng.choice([0, 1, 3, 10])):
            body[rng.randrange(len(body))] = rng.choice(words)
        out.append(" ".join(["opening,", *body]))
    return out


@pytest.mark.parametrize(("classes", "size"), [(4096, 8 << 20), (8, 8 << 20), (4096, 2000)])
def test_large_blocks_are_dealt_out_and_lose_no_pair(spark, tmp_path, monkeypatch, classes, size):
    monkeypatch.setattr(similar_texts, "CLASSES", classes)
    monkeypatch.setattr(similar_texts, "BYTES", size)
    texts = drawn(1, 150, 60)
    rows = [(i, t, "en") for i, t in enumerate(texts)] + [(1000 + i, t, "de") for i, t in enumerate(texts[:20])]
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    found = sorted(map(tuple, record_queries.trigram_pairs(spark, str(tmp_path)).collect()))
    sets = {(i, lang): grams(t) for i, t, lang in rows}
    places = lambda x: (math.floor(x * 10000) + (x * 10000 % 1 >= 0.5)) / 10000
    every = [(a, b, places(len(x & y) / len(x | y))) for (a, la), x in sets.items() for (b, lb), y in sets.items() if a < b and la == lb]
    assert found == sorted(p for p in every if p[2] >= 0.82) and len(found) > 50


def test_pairs_of_sets_of_any_size():
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 3000, n)) for n in (1, 1, 2, 40, 300, 700)]
    for s in list(sets) * 25:
        sets.append(np.unique(np.r_[s[: len(s) - rng.integers(0, 1 + len(s) // 6)], rng.integers(0, 3000, rng.integers(0, 1 + len(s) // 9))]))
    least = similar_texts.LEAST
    jaccard = lambda x, y: len(np.intersect1d(x, y)) / len(np.union1d(x, y))
    i, j, shared, total = similar_texts.similar_sets(sets)
    assert {(min(p), max(p)) for p in zip(i.tolist(), j.tolist(), strict=True)} == {(a, b) for a in range(len(sets)) for b in range(a + 1, len(sets)) if jaccard(sets[a], sets[b]) >= least}
    assert all(len(np.intersect1d(sets[a], sets[b])) == s and len(np.union1d(sets[a], sets[b])) == t for a, b, s, t in zip(i, j, shared, total, strict=True))
    x, y = sets[:70], sets[70:]
    i, j, *_ = similar_texts.similar_sets(x, y)
    assert sorted(zip(i.tolist(), j.tolist(), strict=True)) == [(a, b) for a in range(len(x)) for b in range(len(y)) if jaccard(x[a], y[b]) >= least]


def test_odd_rows_are_as_in_sql(spark, duck, tmp_path):
    """Rows without language are paired with nothing; a sigma at a word's end, a dotted
    capital I, empty texts, repeated rows and repeated doc_ids."""
    texts = [("the and same", None), ("the and same", None), ("THE AND same", "en"), ("the and same", "en"), ("", "en"), ("", "en"), (None, "en"), (None, "en")]
    texts += [("ΟΔΟΣ ΟΔΟΣ", "el"), ("οδοσ οδοσ", "el"), ("οδος οδος", "el"), ("İSTANBUL İSTANBUL", "tr"), ("istanbul istanbul", "tr"), ("😀😀😀 ñandú", "es"), ("😀😀😀 ÑANDÚ", "es")]
    rows = [(i, t, lang) for i, (t, lang) in enumerate(texts)] + [(2, "the and same", "en"), (2, "the and same", "en"), (None, "the and same", "en")]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    found = sorted(map(tuple, record_queries.trigram_pairs(spark, str(tmp_path)).collect()))
    sql = registry.oracle_sql()["trigram_pairs"]
    want = duck.sql(f"with documents as (select * from '{tmp_path}/documents.parquet/*.parquet') {sql.replace('with d as', ', d as', 1)}").fetchall()
    assert found == sorted(want) and (8, 9, 1.0) in found and (11, 12, 1.0) in found


def test_long_texts_take_time_in_proportion_to_letters(spark, tmp_path):
    """48 million letters, no two texts in one block, against a plain loop that makes their
    sets (5 times its seconds; 16 when Spark's array functions made sets and words)."""
    letters = np.random.default_rng(5).choice(np.frombuffer(b"etaoin shrdlu", np.uint8), (1200, 40_000))
    texts = [t.tobytes().decode() for t in letters]
    took = []
    for some in (texts[:40], texts):
        at = str(tmp_path / str(len(some)))
        spark.createDataFrame([(i, t, f"l{i}") for i, t in enumerate(some)], SCHEMA).repartition(4).write.parquet(f"{at}/documents.parquet")
        began = time.perf_counter()
        assert record_queries.trigram_pairs(spark, at).count() == 0
        took.append(time.perf_counter() - began)
    began = time.perf_counter()
    for t in texts:
        similar_texts.trigram_set(t)
    loop = time.perf_counter() - began
    assert took[1] < 10 * loop
