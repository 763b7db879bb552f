"""Pieces that several operators share: byte and word hashing in numpy over Arrow
buffers, packed key exchanges, and tables written to the cluster's shared folder.

Rows are addressed by ``(_id, _th)``: the document id (null: the smallest long) and
the 64-bit hash of the text (null: of the empty text), so that repeated rows and rows
that share an id have a defined result.
"""

from __future__ import annotations

import ctypes
import math
import re
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes that separate words: 0x20 and 0x09 to 0x0D.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
NO_ID = -(2**63)
#: Buckets of a packed exchange up to which their size stays the same.
WIDE = 1 << 17
#: Symbols that are hashed at a time, which bounds the tables of powers.
STRETCH = 1 << 20
U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_POWERS: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit integers (the splitmix64 finaliser)."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


_SYMBOL = mix(np.arange(1, 257, dtype=U64) * U64(0xD1342543DE82EF95))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS.get("up", ())) < n:
        size = max(n, 1 << 16)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 2**64))):
            steps = np.full(size, base, U64)
            steps[0] = 1
            _POWERS[name] = np.multiply.accumulate(steps)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def _prefix(symbols: np.ndarray) -> np.ndarray:
    up, _ = _powers(len(symbols) + 1)
    out = np.zeros(len(symbols) + 1, U64)
    np.cumsum(symbols * up[: len(symbols)], out=out[1:])
    return out


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte strings data[starts:ends], which stand in order; a stretch
    of about ``STRETCH`` bytes at a time."""
    out = np.zeros(len(starts), U64)
    begin = 0
    while begin < len(starts):
        low = int(starts[begin])
        end = max(begin + 1, int(np.searchsorted(ends, low + STRETCH, "right")))
        s, e = starts[begin:end] - low, ends[begin:end] - low
        sums = _prefix(_SYMBOL[data[low : low + int(e[-1])]])
        _, down = _powers(len(sums))
        out[begin:end] = mix((sums[e] - sums[s]) * down[s] + (e - s).astype(U64))
        begin = end
    return out


def gram_hashes(symbols: np.ndarray, k: int) -> np.ndarray:
    """64-bit hashes of every run of k consecutive symbols (64-bit, well mixed)."""
    n = max(0, len(symbols) - k + 1)
    out = np.zeros(n, U64)
    for a in range(0, n, STRETCH):
        part = symbols[a : a + STRETCH + k - 1]
        sums = _prefix(part)
        _, down = _powers(len(sums))
        m = len(part) - k + 1
        out[a : a + m] = mix((sums[k:] - sums[:m]) * down[:m])
    return out


def byte_gram_hashes(data: np.ndarray, k: int) -> np.ndarray:
    return gram_hashes(_SYMBOL[data], k)


_WORD = ~SPACE


def words_of(data: np.ndarray, offsets: np.ndarray, member: np.ndarray = _WORD) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word starts, word ends, and for each text the number of the first of its words
    (one more entry than texts). ``offsets`` bound the texts in ``data``; ``member``
    tells which bytes words are made of."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = member[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    at = offsets[:-1][offsets[:-1] < offsets[1:]]
    first[at] = inside[at]
    last[at[1:] - 1] = inside[at[1:] - 1]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offsets)


def texts_of(batch: pa.RecordBatch, name: str = "text") -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a column of strings, and offsets (nulls: empty)."""
    column = batch.column(batch.schema.get_field_index(name))
    column = column.cast(pa.large_binary() if pa.types.is_binary(column.type) else pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1]
    raw = np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]] if data is not None and n else np.zeros(0, np.uint8)
    return raw, (bounds - bounds[0]) if n else np.zeros(1, np.int64)


def longs_of(batch: pa.RecordBatch, name: str) -> np.ndarray:
    column = batch.column(batch.schema.get_field_index(name))
    return np.asarray(column.fill_null(NO_ID) if column.null_count else column, dtype=np.int64)


def slices_of(batches: Iterable[pa.RecordBatch], most: int = 4 << 20, name: str = "text") -> Iterator[pa.RecordBatch]:
    """Cuts record batches so that each has about ``most`` bytes of text; a text is never cut."""
    for batch in batches:
        _, offsets = texts_of(batch, name)
        begin = 0
        while begin < batch.num_rows:
            end = max(begin + 1, int(np.searchsorted(offsets, offsets[begin] + most, "right")) - 1)
            yield batch.slice(begin, end - begin)
            begin = end


def window_minima(grams: np.ndarray, w: int) -> np.ndarray:
    """For each run of w grams the place of its smallest one, the rightmost of ties."""
    n = len(grams) - w + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    # The upper half of a gram and, below it, its place counted from the right: the least
    # of these is the rightmost of the smallest. Minima of 2^j values by doubling.
    last = U64(0xFFFFFFFF)
    least = (grams & ~last) | (last - np.arange(len(grams), dtype=U64))
    size = 1
    while size * 2 <= w:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    if size < w:
        least = np.minimum(least[: size - w], least[w - size :])
    return (last - (least & last)).astype(np.int64)


def shipped(spark: SparkSession) -> SparkSession:
    """Sends this package to the executors, once for each session (Spark's own file
    server carries it, so no folder needs to be shared)."""
    context = spark.sparkContext
    if not getattr(context, "_accordion_shipped", False):
        top = Path(__file__).resolve().parents[1]
        target = Path(tempfile.mkdtemp(prefix="accordion-")) / "accordion.zip"
        with zipfile.ZipFile(target, "w") as z:
            for f in sorted(top.rglob("*.py")):
                z.write(f, f.relative_to(top.parent))
        context.addPyFile(str(target))
        context._accordion_shipped = True
    return spark


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def buckets_for(df: DataFrame, column: str = "text", each: int = 16 << 20) -> int:
    """Buckets of a packed exchange, from the counted bytes of a column: one for each
    ``each`` bytes up to ``WIDE`` buckets; beyond, buckets and their sizes grow alike, so
    that the pieces a batch sends to a bucket don't become single entries."""
    total = df.agg(F.sum(F.octet_length(F.col(column).cast("binary")))).first()[0] or 0
    n = -(-total // each)
    return max(shuffle_partitions(df.sparkSession), n if n <= WIDE else math.isqrt(n * WIDE))


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, from spark.checkpoint.dir. Where none is set one is
    made, but only if the executors are threads of this process (tests)."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        at = tempfile.mkdtemp(prefix="accordion-")
        spark.conf.set("spark.checkpoint.dir", at)
    return at.rstrip("/")


def written(df: DataFrame, tag: str) -> DataFrame:
    """Cuts the lineage: the rows as a Parquet table in the shared folder."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._written_at = path
    return out


def discard(*tables: DataFrame) -> None:
    """Removes tables made by ``written`` that nothing will read again."""
    for df in tables:
        session = df.sparkSession
        at = session._jvm.org.apache.hadoop.fs.Path(df._written_at)
        at.getFileSystem(session._jsc.hadoopConfiguration()).delete(at, True)


def keyed(docs: DataFrame, *more) -> DataFrame:
    """``_id`` and ``_th`` address a row; text is never null; then the columns ``more``."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("_id"), F.xxhash64(text).alias("_th"), text.alias("text"), *more
    )


def doc_id_of(column) -> F.Column:
    return F.when(column != F.lit(NO_ID), column)


def hand_back() -> None:
    """Gives freed memory back to the system: a worker goes on to serve other tasks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def split_buckets(bucket: np.ndarray, columns: list[np.ndarray]) -> Iterator[tuple[int, list[np.ndarray]]]:
    """The rows of each bucket, in their order."""
    if not len(bucket):
        return
    order = np.argsort(bucket.astype(np.uint32), kind="stable")
    ordered = bucket[order]
    cuts = np.flatnonzero(np.diff(ordered)) + 1
    columns = [c[order] for c in columns]
    for a, b in zip(np.r_[0, cuts], np.r_[cuts, len(ordered)], strict=True):
        yield int(ordered[a]), [c[a:b] for c in columns]


def packed(rows: list[tuple], names: str) -> pa.RecordBatch:
    """Rows (bucket, kind, arrays...) as a batch of binary columns."""
    arrays = [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int32())]
    arrays += [pa.array([r[i].tobytes() for r in rows], pa.binary()) for i in range(2, 2 + len(names.split()))]
    return pa.RecordBatch.from_arrays(arrays, names=["bucket", "kind", *names.split()])


def packed_schema(names: str) -> str:
    return "bucket int, kind int, " + ", ".join(f"{n} binary" for n in names.split())


def unpack(table: pa.Table, name: str, dtype) -> np.ndarray:
    parts = [np.frombuffer(x.as_buffer(), dtype) for chunk in table.column(name).chunks for x in chunk]
    return np.concatenate(parts) if parts else np.zeros(0, dtype)


def address(ids: np.ndarray, ths: np.ndarray) -> np.ndarray:
    """One number for an address of two."""
    return (mix(ids.view(U64)) ^ ths.view(U64)).view(np.int64)


def text_anchors(anchors: Callable) -> Callable:
    """For ``anchor_exchange``: anchors of the texts of keyed rows."""

    def found(s: pa.RecordBatch):
        return *anchors(*texts_of(s)), longs_of(s, "_id"), longs_of(s, "_th")

    return found


def sums_by(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of values[bounds[i]:bounds[i + 1]]."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return total[bounds[1:]] - total[bounds[:-1]]


def runs_cover(starts: np.ndarray, width: int, n: int) -> np.ndarray:
    """Which of n places are in [s, s + width) for some of the starts."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, np.minimum(starts + width, n), -1)
    return np.cumsum(edge[:-1]) > 0


def anchor_exchange(docs: DataFrame, anchors: Callable, distinct_rows: bool, buckets: int, piece: int = 4 << 20, name: str = "text", form: str = "rows") -> DataFrame:
    """Anchors whose key occurs again, as rows (_id, _th, idx). ``form``
    "counts": idx is how many an address has in a bucket; "packed": rows (target, ids,
    counts, idxs) of numbers by address, dealt to ``buckets`` targets by _id.

    ``anchors(slice)`` gives the keys of all anchors of a slice of rows (64-bit), the row of
    each, its number within the row, and the rows' two address columns (rows of one
    address count as one). ``distinct_rows``: a key counts once for each address, so it
    must occur in two; else twice anywhere.

    Each task first reduces its own rows: of the occurrences of a key in one gathered
    batch only one travels, so a key that a third of all rows hold arrives at its
    bucket once for each batch, not once for each row. Only 32 bits of a key travel
    beside its bucket: a false hit costs a later look, never a wrong result.
    """
    names = "key owner idx ids ths"

    def mapped(batches):
        for group in _gathered(slices_of(batches, piece, name), 8 << 20):
            yield from _anchor_rows(group, anchors, distinct_rows, buckets)
        hand_back()

    def reduced(table: pa.Table) -> pa.Table:
        found = _anchor_verdict(table, distinct_rows)
        return found if form == "rows" else _as_counts(found) if form == "counts" else _as_packed(found, buckets)

    rows = docs.mapInArrow(mapped, packed_schema(names))
    return rows.groupBy("bucket").applyInArrow(reduced, "target long, ids binary, counts binary, idxs binary" if form == "packed" else "_id long, _th long, idx int")


def _gathered(slices: Iterable[pa.RecordBatch], most: int) -> Iterator[list[pa.RecordBatch]]:
    group, size = [], 0
    for s in slices:
        group.append(s)
        size += s.nbytes
        if size >= most:
            yield group
            group, size = [], 0
    if group:
        yield group


def _anchor_rows(group, anchors, distinct_rows, buckets):
    keys, owners, numbers, ids, ths, seen = [], [], [], [], [], 0
    for s in group:
        key, owner, number, row_ids, row_ths = anchors(s)
        keys.append(key)
        owners.append((owner + seen).astype(np.uint32))
        numbers.append(number.astype(np.uint32))
        ids.append(row_ids)
        ths.append(row_ths)
        seen += s.num_rows
    key, owner, number = np.concatenate(keys), np.concatenate(owners), np.concatenate(numbers)
    ids, ths = np.concatenate(ids), np.concatenate(ths)
    if distinct_rows:
        _, first, inverse = np.unique(address(ids, ths), return_index=True, return_inverse=True)
        own = (first[inverse] == np.arange(len(ids)))[owner]
        key, owner, number = key[own], owner[own], number[own]
    if not len(key):
        return
    order = np.argsort(key, kind="stable")
    k, o = key[order], owner[order]
    new = np.r_[True, k[1:] != k[:-1]]
    begin = np.flatnonzero(new)
    end = np.r_[begin[1:], len(k)]
    again = (o[end - 1] != o[begin]) if distinct_rows else (end - begin > 1)
    group_of = np.cumsum(new) - 1
    known = np.zeros(len(key), bool)
    known[order] = again[group_of]
    sent = np.zeros(len(key), bool)
    sent[order] = new | ~again[group_of]
    bucket = (mix(key) >> U64(40)).astype(np.int64) % buckets
    out = []

    def add(bucket_no, kind, key, owner, number):
        # Entries stand by row: how many each row has says whose they are.
        used, count = np.unique(owner, return_counts=True)
        out.append((bucket_no, kind, key, count.astype(np.uint32), number, ids[used], ths[used]))

    short = (key & U64(0xFFFFFFFE)).astype(np.uint32) | known.astype(np.uint32)
    for b, (x, y, z) in split_buckets(bucket[sent], [short[sent], owner[sent], number[sent]]):
        add(b, 0, x, y, z)
    if known.any():
        add(int(ids[0]) % buckets, 1, short[known], owner[known], number[known])
    yield packed(out, "key owner idx ids ths")


def _anchor_verdict(table: pa.Table, distinct_rows: bool) -> pa.Table:
    keys, ids, ths, numbers, rows = [], [], [], [], []
    out = []
    for r in range(table.num_rows):
        get = lambda n, t: np.frombuffer(table.column(n)[r].as_buffer(), t)  # noqa: B023, E731
        row_ids, row_ths, number = get("ids", np.int64), get("ths", np.int64), get("idx", np.uint32)
        owner = np.repeat(np.arange(len(row_ids)), get("owner", np.uint32))
        if table.column("kind")[r].as_py():
            out.append((row_ids[owner], row_ths[owner], number))
            continue
        keys.append(get("key", np.uint32))
        ids.append(row_ids[owner])
        ths.append(row_ths[owner])
        numbers.append(number)
        rows.append(address(row_ids, row_ths)[owner])
    if keys:
        key, row = np.concatenate(keys), np.concatenate(rows)
        known, key = (key & np.uint32(1)).astype(bool), key >> np.uint32(1)
        order = np.argsort(key, kind="stable")
        k, o = key[order], row[order]
        new = np.r_[True, k[1:] != k[:-1]]
        begin = np.flatnonzero(new)
        end = np.r_[begin[1:], len(k)]
        low, high = np.minimum.reduceat(o, begin), np.maximum.reduceat(o, begin)
        any_known = np.logical_or.reduceat(known[order], begin)
        again = (((low != high) if distinct_rows else (end - begin > 1)) | any_known)[np.cumsum(new) - 1]
        hit = np.zeros(len(key), bool)
        hit[order] = again
        hit &= ~known
        out.append((np.concatenate(ids)[hit], np.concatenate(ths)[hit], np.concatenate(numbers)[hit]))
    join = lambda i, t: np.concatenate([x[i] for x in out]).astype(t) if out else np.zeros(0, t)
    return pa.table({"_id": join(0, np.int64), "_th": join(1, np.int64), "idx": join(2, np.int32)})


def _by_address(found: pa.Table):
    ids, ths, idx = (np.asarray(found.column(n)) for n in ("_id", "_th", "idx"))
    order = np.lexsort((idx, ths, ids))
    ids, ths, idx = ids[order], ths[order], idx[order]
    begin = np.flatnonzero(np.r_[True, (ids[1:] != ids[:-1]) | (ths[1:] != ths[:-1])][: len(ids)])
    return ids[begin], ths[begin], np.diff(np.r_[begin, len(ids)]), idx


def _as_counts(found: pa.Table) -> pa.Table:
    ids, ths, count, _ = _by_address(found)
    return pa.table({"_id": ids, "_th": ths, "idx": count.astype(np.int32)})


def _as_packed(found: pa.Table, targets: int) -> pa.Table:
    ids, _, count, idx = _by_address(found)
    lead = np.r_[0, np.cumsum(count)]
    rows = []
    for target, (which,) in split_buckets(ids % targets, [np.arange(len(ids))]):
        take = np.repeat(lead[which] - np.r_[0, np.cumsum(count[which])[:-1]], count[which]) + np.arange(count[which].sum())
        rows.append((target, ids[which].tobytes(), count[which].astype(np.int64).tobytes(), idx[take].astype(np.uint32).tobytes()))
    names = ("target", "ids", "counts", "idxs")
    kinds = (pa.int64(), pa.binary(), pa.binary(), pa.binary())
    return pa.table({n: pa.array([r[i] for r in rows], k) for i, (n, k) in enumerate(zip(names, kinds, strict=True))})
