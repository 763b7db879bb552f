"""Similar texts: every pair within a block whose trigram sets reach a Jaccard bound.

1. The texts of a block with the same trigram set are a class, known by a 128-bit hash of
   block and set. Classes are compared; their members are paired at the end only.
2. Small blocks are dealt to buckets of counted bytes. A block of more than ``CLASSES``
   classes or ``BYTES`` is cut into bands of set size (similar sets lie in one band or in
   neighbouring ones) and these into parts by hash. Each two parts that can hold a similar
   pair are a task of their own, so no task grows with the input.
3. A task compares sets of sizes that allow the bound by parity words first: which
   remainders an odd number of trigrams has. Words of two sets differ in no more bits
   than the sets in trigrams, so this loses no pair. What passes is intersected exactly.

Within a large block the pairs of unlike classes still grow with its square. A text without block or doc_id is paired with nothing, as in SQL.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from accordion.plans.store import written

THRESHOLD = 0.82
#: Pairs below this never round to the threshold.
LEAST = THRESHOLD - 0.0001
CLASSES, BYTES, BUCKET, TILE = 4096, 8 << 20, 16 << 20, 1 << 17
_CLASS = "block string, n int, h1 long, h2 long"


def trigram_set(padded: str) -> np.ndarray:
    """The distinct trigrams of a padded text in order, three code points of 21 bits each."""
    points = np.frombuffer(padded.encode("utf-32-le"), np.uint32).astype(np.int64)
    codes = np.sort(points[:-2] << 42 | points[1:-1] << 21 | points[2:])
    return codes[np.r_[True, codes[1:] != codes[:-1]]]


def _sliced(batches):
    for batch in batches:
        for at in range(0, batch.num_rows, 1000):
            yield batch.slice(at, 1000)


def _class_of(block: str, text: str) -> tuple[int, bytes]:
    grams, name = trigram_set(text), block.encode()
    return len(grams), hashlib.blake2b(b"%d:" % len(name) + name + grams.tobytes(), digest_size=16).digest()


def _halves(digests: list[bytes]) -> list[pa.Array]:
    both = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
    return [pa.array(both[:, 0]), pa.array(both[:, 1])]


def _classed(batches):
    """Rows of doc_id, block and text as rows of doc_id, class and bytes of the text."""
    for s in _sliced(batches):
        made = [_class_of(b, t) for b, t in zip(s.column("block").to_pylist(), s.column("text").to_pylist(), strict=True)]
        size = pc.binary_length(s.column("text")).cast(pa.int64())
        yield pa.RecordBatch.from_arrays([s.column("doc_id"), s.column("block"), pa.array([n for n, _ in made], pa.int32()), *_halves([d for _, d in made]), size], names=["doc_id", "block", "n", "h1", "h2", "size"])


def _once(batches):
    """A text of each class, once for each task."""
    seen = set()
    for s in _sliced(batches):
        take, made = [], []
        for i, (b, t) in enumerate(zip(s.column("block").to_pylist(), s.column("text").to_pylist(), strict=True)):
            n, digest = _class_of(b, t)
            if digest not in seen:
                seen.add(digest)
                take.append(i)
                made.append((n, digest))
        if take:
            kept = s.take(pa.array(take))
            yield pa.RecordBatch.from_arrays([kept.column("block"), pa.array([n for n, _ in made], pa.int32()), *_halves([d for _, d in made]), kept.column("text")], names=["block", "n", "h1", "h2", "text"])


def _spans(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of all spans, one after the other."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - ends + sizes, sizes) + np.arange(ends[-1])


def _parity_words(ids: np.ndarray, starts: np.ndarray, sizes: np.ndarray, bits: int) -> np.ndarray:
    """A column of words for each set: which remainders an odd number of its members has."""
    out, step = [], max(1, (1 << 22) // bits)
    for at in range(0, len(starts), step):
        n = sizes[at : at + step]
        place = np.repeat(np.arange(len(n)) * bits, n) + ids[_spans(starts[at : at + step], n)] % bits
        odd = np.bincount(place, minlength=len(n) * bits).astype(np.uint8) & 1
        out.append(np.packbits(odd.reshape(len(n), bits), axis=1).view(np.uint64))
    return np.ascontiguousarray(np.concatenate(out).T)


def similar_sets(a: list[np.ndarray], b: list[np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Places in ``a`` and ``b`` (without it: both in ``a``, each pair once) of sets that
    reach the bound, and how many members they share and have."""
    every = a if b is None else a + b
    size = np.array([len(s) for s in every])
    lead = np.r_[0, np.cumsum(size)]
    _, ids = np.unique(np.concatenate(every), return_inverse=True)
    rows = np.argsort(size[: len(a)], kind="stable")
    cols = rows if b is None else len(a) + np.argsort(size[len(a) :], kind="stable")
    n, m = size[rows], size[cols]
    high = np.searchsorted(m, n / LEAST, "right")
    low = np.arange(1, len(n) + 1) if b is None else np.searchsorted(m, n * LEAST, "left")
    high = np.maximum(low, high)
    width = np.maximum(512, 2 ** np.ceil(np.log2(2 * n)).astype(np.int64))
    mark = np.zeros(int(ids.max()) + 1, np.uint8)
    out = [np.zeros((4, 0), np.int64)]

    def settle(i: int, places: np.ndarray) -> None:
        own, other = rows[i], cols[places]
        mine = ids[lead[own] : lead[own + 1]]
        mark[mine] = 1
        sizes = size[other]
        shared = np.add.reduceat(mark[ids[_spans(lead[other], sizes)]], np.cumsum(sizes) - sizes, dtype=np.int64)
        mark[mine] = 0
        total = sizes + len(mine) - shared
        good = shared >= LEAST * total
        out.append(np.stack([np.full(good.sum(), own), other[good], shared[good], total[good]]))

    begin = 0
    while begin < len(rows):
        bits = int(width[begin])
        end = int(np.searchsorted(width, bits, "right"))
        first, last = int(low[begin]), int(high[end - 1])
        if last - first > 16:
            of = lambda which: _parity_words(ids, lead[which], size[which], bits)  # noqa: B023, E731
            left, right = of(rows[begin:end]), of(cols[first:last])
        i = begin
        while i < end:
            stop = min(end, i + max(1, TILE // max(1, int(high[i] - low[i]))))
            c, d = int(low[i]), int(high[stop - 1])
            place = np.arange(c, d)
            near = (place >= low[i:stop, None]) & (place < high[i:stop, None])
            if last - first > 16 and d > c:
                apart = np.zeros(near.shape, np.uint32)
                for x, y in zip(left[:, i - begin : stop - begin], right[:, c - first : d - first], strict=True):
                    apart += np.bitwise_count(x[:, None] ^ y)
                near &= apart <= (1 - LEAST) / (1 + LEAST) * (n[i:stop, None] + m[c:d])
            for k in np.flatnonzero(near.any(axis=1)).tolist():
                settle(i + k, c + np.flatnonzero(near[k]))
            i = stop
        begin = end
    mine, other, shared, total = np.concatenate(out, axis=1)
    return mine, other if b is None else other - len(a), shared, total


def _linked(table: pa.Table) -> pa.Table:
    """The similar classes of a bucket of blocks (side -1) or of two parts (sides 0 and 1)."""
    block = table.column("block").combine_chunks().dictionary_encode().indices.to_numpy()
    h1, h2, side = (table.column(c).to_numpy() for c in ("h1", "h2", "side"))
    order = np.lexsort((h2, h1, block))
    order = order[np.r_[True, (h1[order][1:] != h1[order][:-1]) | (h2[order][1:] != h2[order][:-1]) | (block[order][1:] != block[order][:-1])]]
    text, found = table.column("text"), [np.zeros((4, 0), np.int64)]
    names = [[np.zeros(0, np.int64)] for _ in range(4)]
    for own in np.split(order, np.flatnonzero(np.diff(block[order])) + 1):
        parts = [own] if side[own[0]] < 0 else [own[side[own] == s] for s in (0, 1)]
        if min(map(len, parts)) < 3 - len(parts):
            continue
        got = similar_sets(*([trigram_set(text[i].as_py()) for i in p.tolist()] for p in parts))
        found.append(np.stack(got))
        for k, (h, rows) in enumerate([(h1, parts[0][got[0]]), (h2, parts[0][got[0]]), (h1, parts[-1][got[1]]), (h2, parts[-1][got[1]])]):
            names[k].append(h[rows])
    numbers = np.concatenate(found, axis=1)[2:]
    return pa.table([*map(np.concatenate, names), *numbers], names=["a1", "a2", "b1", "b2", "shared", "total"])


def _spots(buckets: int):
    """Where a class goes: its block's bucket, or each pair of parts that its part is in."""
    part = F.pmod(F.col("h1"), F.col("parts"))
    spot = lambda low, i, high, j, side: F.struct(F.concat_ws("|", "block", *[x.cast("string") for x in (low, i, high, j)]).alias("spot"), side.cast("int").alias("side"))
    upto = lambda n, f: F.transform(F.when(n > 0, F.sequence(F.lit(0).cast("long"), n - 1)).otherwise(F.array().cast("array<long>")), f)
    band, below, above = F.col("band"), F.col("band") - 1, F.col("band") + 1
    own = upto(F.col("parts"), lambda j: spot(band, F.least(part, j), band, F.greatest(part, j), F.when(part == j, -1).when(part < j, 0).otherwise(1)))
    up = upto(F.col("above"), lambda j: spot(band, part, above, j, F.lit(0)))
    down = upto(F.col("below"), lambda j: spot(below, j, band, part, F.lit(1)))
    small = F.array(F.struct(F.pmod(F.xxhash64("block"), F.lit(buckets)).cast("string").alias("spot"), F.lit(-1).alias("side")))
    return F.when(F.col("parts").isNull(), small).otherwise(F.concat(own, up, down))


def similar_pairs(docs: DataFrame) -> DataFrame:
    """id_a < id_b and similarity (four places) of docs (doc_id, block, text: lower-cased,
    between two and one spaces)."""
    from accordion.llm.common import shipped

    spark = shipped(docs.sparkSession)
    docs = docs.where("doc_id is not null and block is not null and text is not null")
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = written(docs.mapInArrow(_classed, f"doc_id {kind}, {_CLASS}, size long"))
    classes = written(rows.groupBy("block", "h1", "h2").agg(F.first("n").alias("n"), F.max("size").alias("size"), F.count("*").alias("copies")))
    band = F.floor(F.log(F.col("n").cast("double")) / -math.log(LEAST))
    whole = Window.partitionBy("block")
    bands = classes.groupBy("block", band.alias("band")).agg(F.count("*").alias("m"), F.sum("size").alias("size"))
    bands = written(bands.withColumns({"all_m": F.sum("m").over(whole), "all_size": F.sum("size").over(whole)}).where("all_m > 1"))
    total = bands.agg(F.sum("size")).first()[0] or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // BUCKET))
    large = bands.where((F.col("all_m") > CLASSES) | (F.col("all_size") > BYTES))
    cut = large.select("block", "band", F.ceil(F.greatest(F.col("m") / CLASSES, F.col("size") / BYTES)).alias("parts"))
    w = Window.partitionBy("block").orderBy("band")
    beside = lambda f, by: F.coalesce(F.when(f("band").over(w) == F.col("band") + by, f("parts").over(w)), F.lit(0).cast("long"))
    cut = written(cut.withColumns({"below": beside(F.lag, -1), "above": beside(F.lead, 1)}))

    texts = docs.select("block", "text").mapInArrow(_once, f"{_CLASS}, text string").withColumn("band", band)
    dealt = texts.join(cut, ["block", "band"], "left").select("block", "h1", "h2", "text", F.explode(_spots(buckets)).alias("to")).select("block", "h1", "h2", "text", "to.spot", "to.side")
    links = dealt.groupBy("spot").applyInArrow(_linked, "a1 long, a2 long, b1 long, b2 long, shared long, total long")
    # Ties go up as SQL has it, by the product and not by the decimal digits.
    scaled = F.col("shared") / F.col("total") * 10000
    places = (F.floor(scaled) + F.when(scaled - F.floor(scaled) >= 0.5, 1).otherwise(0)) / F.lit(10000.0)
    links = links.select("a1", "a2", "b1", "b2", places.alias("similarity")).where(F.col("similarity") >= THRESHOLD)
    copies = classes.where("copies > 1").select(F.col("h1").alias("a1"), F.col("h2").alias("a2"), F.col("h1").alias("b1"), F.col("h2").alias("b2"), F.lit(1.0).alias("similarity"))

    pairs = written(links).unionByName(copies)
    for s in "ab":
        pairs = pairs.join(rows.select(F.col("h1").alias(f"{s}1"), F.col("h2").alias(f"{s}2"), F.col("doc_id").alias(f"id_{s}")), [f"{s}1", f"{s}2"])
    once = F.when((F.col("a1") == F.col("b1")) & (F.col("a2") == F.col("b2")), F.col("id_a") < F.col("id_b")).otherwise(F.col("id_a") != F.col("id_b"))
    return pairs.where(once).select(F.least("id_a", "id_b").alias("id_a"), F.greatest("id_a", "id_b").alias("id_b"), "similarity")
