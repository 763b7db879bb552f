"""The rows of each stage of the pipeline against plain loops over its input."""

import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F
from test_mixing_packing import by_hand
from test_operators import SCHEMA, components_of, rows, words_removed  # noqa: F401

import corpus_pipeline
from accordion.llm import mixing, packing, toxicity
from conftest import SMALL


@pytest.fixture(scope="module")
def docs(spark, rows):  # noqa: F811
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def made(stage, spark, docs):
    return Counter(tuple(r) for r in stage(spark, docs, SMALL).collect())


def test_clean(spark):
    """Scores are held against plain loops in test_toxicity_whole; here whole rows go or stay by them."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    predicted = {r["doc_id"]: r["predicted"] for r in toxicity.op4_toxicity(spark, SMALL).collect()}
    want = Counter(tuple(r) for r in docs.collect() if not predicted[r["doc_id"]])
    assert 0 < want.total() < docs.count()
    assert made(corpus_pipeline.clean, spark, docs) == want


def test_distinct(spark, docs, rows):  # noqa: F811
    links = components_of(rows)
    ids = {c for _, n, c in links if n} | {i for i, n, _ in links if not n}
    assert made(corpus_pipeline.distinct, spark, docs) == Counter({r: 1 for r in rows if r[0] in ids})


def test_trimmed(spark, docs, rows):  # noqa: F811
    removed = {i: (n, kept) for i, _, n, kept in words_removed(rows)}
    given = {r[0]: r for r in rows}
    got = made(corpus_pipeline.trimmed, spark, docs)
    assert Counter(i for i, *_ in got.elements()) == Counter(r[0] for r in rows)
    assert any(n for n, _ in removed.values())
    for row in got:
        n, kept = removed[row[0]]
        if n:
            assert hashlib.sha256(row[1].encode()).hexdigest() == kept and row[4] == len(row[1])
            assert (*row[2:4], *row[5:]) == (*given[row[0]][2:4], *given[row[0]][5:])
        else:
            assert row == given[row[0]]


def test_mixed(spark, docs, rows):  # noqa: F811
    copies = by_hand(rows, mixing.ENTROPY, mixing.REPEATS, mixing.BLOCK_TOKENS)
    want = Counter()
    for r in rows:
        want[r] += copies[r[0], r[3] or ""]
    assert made(corpus_pipeline.mixed, spark, docs) == want


def test_packed(spark, docs):
    texts = packing.packing_rows(docs).collect()
    got = corpus_pipeline.packed(spark, docs, SMALL)
    parts = []
    for r in sorted(texts, key=lambda r: (-r["n_tokens"], r["doc_id"])):
        parts += [(min(packing.CAPACITY, r["n_tokens"] - a), r["doc_id"], a, r["source"], r["cluster"]) for a in range(0, r["n_tokens"], packing.CAPACITY)]
    parts.sort(key=lambda p: -p[0])
    bins, want = [], Counter()
    for n, doc, start, source, cluster in parts:
        fits = [(b[0], i) for i, b in enumerate(bins) if b[0] >= n and cluster not in b[2] and b[1][source] < packing.PER_SOURCE]
        i = min(fits)[1] if fits else len(bins)
        if not fits:
            bins.append([packing.CAPACITY, Counter(), set()])
        want[doc, start, n, i, packing.CAPACITY - bins[i][0]] += 1
        bins[i][0] -= n
        bins[i][1][source] += 1
        bins[i][2].add(cluster)
    assert Counter(tuple(r) for r in got.where(F.col("bin_id").isNotNull()).select("doc_id", "start", "n_tokens", "bin_id", "place").collect()) == want
    empty = sorted(r["doc_id"] for r in texts if not r["n_tokens"])
    assert sorted(r["doc_id"] for r in got.where("bin_id is null").collect()) == empty
