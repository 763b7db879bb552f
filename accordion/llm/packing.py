"""Operator 5, best-fit packing under conflicts.

Texts are cut into parts of at most ``capacity`` tokens and packed into bins. Bins stand
ordered by what room they have left; each carries bitmaps of its sources (one for a first
and one for a second text) and of its duplicate clusters. A part, the largest first, goes
to the tightest bin that has room and does not conflict: the search goes on to the next
roomier bin until one is compatible, and opens a bin if none is. Conflicts: two texts of
one duplicate cluster, or a third text of one source (``per_source``).

Rows are dealt to shards of about ``shard_rows`` by a hash of the id, the cluster and, for
repeated rows, the number of the copy, so a hot source, cluster or row is spread evenly
and a shard is bounded. Inside a shard a source or cluster that has many of its parts has
an ordered list of the bins still open to it, so that the search doesn't walk over the
closed ones. Defined results: a text without tokens takes no bin (null bin_id); repeated
rows are members of one cluster and never share a bin; null source is the source ''; of
parts alike in size the smaller id comes first (null last), and of bins alike in room the
older one is taken.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C
from .mixing import n_words

CAPACITY, PER_SOURCE, SHARD_ROWS = 2048, 2, 4000
#: A source or cluster is frequent in a shard from one in so many parts.
LISTS = 16
SCHEMA = "doc_id long, part long, start long, n_tokens long, bin_id long, place long"


def best_fit(parts: list[tuple], capacity: int, per_source: int) -> list[tuple[int, int]]:
    """Bin and place in it of each part (tokens, source, cluster), in the order given."""
    sources = {s: 1 << i for i, s in enumerate(dict.fromkeys(p[1] for p in parts))}
    clusters = {c: 1 << i for i, c in enumerate(dict.fromkeys(p[2] for p in parts))}
    # Ordered bins (room left, bin): all of them, and those open to a frequent source or cluster.
    frequent = Counter(("s", p[1]) for p in parts) + Counter(("c", p[2]) for p in parts)
    lists: dict[tuple, list[tuple[int, int]]] = {key: [] for key, n in frequent.items() if n * LISTS > len(parts)}
    lists[None] = []
    held: list[list[int]] = []  # bitmaps of each bin: clusters, then sources by count
    out = []

    def open_to(bits: list[int], key) -> bool:
        return key is None or not (bits[per_source] & sources[key[1]] if key[0] == "s" else bits[0] & clusters[key[1]])

    for size, source, cluster in parts:
        s, c = sources[source], clusters[cluster]
        room = min((lists[k] for k in (("s", source), ("c", cluster), None) if k in lists), key=len)
        at = bisect_left(room, (size, -1))
        while at < len(room) and (held[room[at][1]][0] & c or held[room[at][1]][per_source] & s):
            at += 1
        if at < len(room):
            left, number = room[at]
            for key, bins in lists.items():
                if open_to(held[number], key):
                    bins.pop(bisect_left(bins, (left, number)))
        else:
            left, number = capacity, len(held)
            held.append([0] * (per_source + 1))
        bits = held[number]
        bits[0] |= c
        for level in range(1, per_source + 1):
            if not bits[level] & s:
                bits[level] |= s
                break
        out.append((number, capacity - left))
        if left > size:
            for key, bins in lists.items():
                if open_to(bits, key):
                    insort(bins, (left - size, number))
    return out


def pack(rows: DataFrame, capacity: int = CAPACITY, per_source: int = PER_SOURCE, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Packs rows (doc_id, source, cluster, n_tokens)."""
    shards = max(1, -(-rows.count() // shard_rows))

    def packed(table: pa.Table) -> pa.Table:
        shard = table.column("shard")[0].as_py()
        cols = [table.column(n).to_pylist() for n in ("doc_id", "source", "cluster", "n_tokens")]
        parts, empty = [], []
        for doc, source, cluster, n in sorted(zip(*cols, strict=True), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1], r[2])):
            if not n:
                empty.append((doc, 0, 0, 0, None, None))
            parts += [(min(capacity, n - a), a, doc, source, cluster) for a in range(0, n, capacity)]
        parts.sort(key=lambda p: -p[0])
        bins = best_fit([(p[0], p[3], p[4]) for p in parts], capacity, per_source)
        done = [(doc, a // capacity, a, n, (shard << 24) + number, place) for (n, a, doc, _, _), (number, place) in zip(parts, bins, strict=True)] + empty
        names = ("doc_id", "part", "start", "n_tokens", "bin_id", "place")
        return pa.table({n: pa.array([d[i] for d in done], pa.int64()) for i, n in enumerate(names)})

    # Repeated rows are counted and then numbered, so they don't all go to one shard.
    alike = rows.groupBy("doc_id", "source", "cluster", "n_tokens").agg(F.count(F.lit(1)).alias("copies"))
    dealt = alike.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).withColumn("shard", F.pmod(F.xxhash64("doc_id", "cluster", "copy"), F.lit(shards)))
    return dealt.groupBy("shard").applyInArrow(packed, SCHEMA)


def packing_rows(docs: DataFrame) -> DataFrame:
    """doc_id, source, cluster (a hash of the text: exact copies) and n_tokens (words)."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"), F.xxhash64(text).alias("cluster"), n_words(F.col("text")).alias("n_tokens"))


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(C.written(packing_rows(C.shipped(spark).read.parquet(f"{sf_dir}/documents.parquet")), "packing"))
