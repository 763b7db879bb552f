"""Operator 7, suffix-array dedup: bytes inside strings of ``k`` (400) bytes that occur twice.

1. Every k-byte window is dealt out by its minimiser (the smallest hash of its 32-byte
   grams), so equal windows meet. Consecutive windows with one minimiser form a segment.
   Minimisers that occur once anywhere can hold no repeated window and go no further.
2. The segments of the others travel once for each distinct content and gathered batch.
   A bucket sorts the suffixes of its distinct segments in blocks of whole minimiser
   groups by two-stage sorting: only suffixes smaller than their successors are sorted
   directly, 8 bytes at a time until ``KEYS`` or fewer are alike so far and then by what is
   left of their k bytes; the rest are induced by scanning the buckets of first bytes.
   Neighbours in the suffix array with a common prefix of k bytes are the repeats; a
   segment that occurs twice as a whole repeats in all its windows (a group of such
   segments only needs no sorting).
3. Minimisers of ``HOT`` occurrences and more do not travel as segments: their windows
   meet by a 128-bit hash, reduced in each task first. That is exact and deals any hot
   passage out, so a group that is sorted never has more than ``HOT`` segments of 2k bytes.
   Up to ``LISTED`` such minimisers are sent to the tasks as a list; beyond, a join marks
   them.

Matches never cross rows. Defined results: null or empty text has no bytes; repeated rows
(also of one doc_id) count as other occurrences and get the same result; a null doc_id
stays null; windows are judged on the input; other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C

GRAM, BLOCK, HOT, LISTED, PIECE, KEYS = 32, 128 << 10, 4096, 100_000, 2 << 20, 1 << 14
_PIECES = "body lens keys known occ owner at ids ths hash1 hash2"


def segments_of(data: np.ndarray, offsets: np.ndarray, k: int):
    """Segments of a slice of texts: key, text, number within its text, first byte (in the
    slice) and number of windows."""
    gram = min(GRAM, k)
    grams = C.byte_gram_hashes(data, gram)
    low = C.window_minima(grams, k - gram + 1)
    size = np.diff(offsets)
    text = np.repeat(np.arange(len(size)), np.maximum(0, size - k + 1))
    lead = np.r_[0, np.cumsum(np.maximum(0, size - k + 1))]
    if not len(text):
        none = np.zeros(0, np.int64)
        return np.zeros(0, C.U64), none, none, none, none
    windows = np.arange(len(text)) - lead[text] + offsets[text]
    place = low[windows]
    begin = np.flatnonzero(np.r_[True, (place[1:] != place[:-1]) | (text[1:] != text[:-1])])
    owner = text[begin]
    first = np.searchsorted(owner, np.arange(len(offsets)))
    return grams[place[begin]], owner, np.arange(len(owner)) - first[owner], windows[begin], np.diff(np.r_[begin, len(text)])


def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """Suffix starts in the order of their first ``depth`` bytes, by two-stage sorting."""
    n = len(text)
    if not n:
        return np.zeros(0, np.int64)
    # smaller[i]: suffix i is smaller than suffix i + 1 (the end is smaller than all).
    change = np.r_[text[1:] != text[:-1], True]
    until = np.flatnonzero(change)
    ahead = until[np.searchsorted(until, np.arange(n))]
    following = np.r_[text, 0].astype(np.int64)
    smaller = (ahead < n - 1) & (following[np.minimum(ahead + 1, n)] > following[:n])
    direct = _directly(text, np.flatnonzero(smaller), depth)
    split = np.searchsorted(text[direct], np.arange(257))
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    waiting[int(text[n - 1])].append(np.array([n - 1]))  # induced by the end of the text
    out = []
    for c in np.unique(text).tolist():
        # The larger suffixes of this bucket: those induced so far, then, scan by scan,
        # those that the bucket itself induces.
        larger, fresh = list(waiting[c]), np.concatenate(waiting[c]) if waiting[c] else np.zeros(0, np.int64)
        while len(fresh):
            before = fresh[fresh > 0] - 1
            fresh = before[text[before] == c]
            if len(fresh):
                larger.append(fresh)
        whole = np.concatenate([*larger, direct[split[c] : split[c + 1]]])
        if not len(whole):
            continue
        out.append(whole)
        before = whole[whole > 0] - 1
        before = before[text[before] > c]
        target = text[before]
        order = np.argsort(target, kind="stable")
        cuts = np.flatnonzero(np.diff(target[order])) + 1
        for group in np.split(before[order], cuts):
            if len(group):
                waiting[int(text[group[0]])].append(group)
    return np.concatenate(out)


def _directly(text: np.ndarray, starts: np.ndarray, depth: int) -> np.ndarray:
    """Suffix starts in the order of their first ``depth`` bytes, sorted as strings. Only
    ``KEYS`` strings exist at a time."""
    raw, wide = text.tobytes(), _words(text)
    out, work = [np.zeros(0, np.int64)], [(starts, 0)]
    while work:
        group, off = work.pop()
        if len(group) <= KEYS or off >= depth:
            if off < depth:
                group = np.array(sorted(group.tolist(), key=lambda i: raw[i + off : i + depth]), np.int64)  # noqa: B023
            else:
                group = np.sort(group)[::-1]  # alike, but for one that the end cuts short
            out.append(group)
            continue
        word = wide[np.minimum(group + off, len(text))]
        if depth - off < 8:
            word &= np.uint64((1 << 64) - (1 << 8 * (8 - depth + off)))
        order = np.argsort(word, kind="stable")
        group, word = group[order], word[order]
        ends = np.r_[np.flatnonzero(word[1:] != word[:-1]) + 1, len(group)]
        # Neighbouring small groups are sorted together from here, large ones from the next word.
        parts, begin, last = [], 0, 0
        for end in ends.tolist():
            if end - begin > KEYS:
                if last > begin:
                    parts.append((group[begin:last], off))
                begin = last
                if end - begin > KEYS:
                    parts.append((group[begin:end], off + 8))
                    begin = end
            last = end
        if last > begin:
            parts.append((group[begin:last], off))
        work += reversed(parts)
    return np.concatenate(out)


def _words(text: np.ndarray) -> np.ndarray:
    """The 8 bytes from each place on as a number, the first byte highest (zeros past the end)."""
    filled = np.r_[text, np.zeros(8, np.uint8)]
    return np.lib.stride_tricks.sliding_window_view(filled, 8).copy().view(">u8").ravel().astype(np.uint64)


def common_prefixes(text: np.ndarray, at: np.ndarray, depth: int) -> np.ndarray:
    """Lengths of the common prefix of the suffixes at[i] and at[i + 1], at most ``depth``."""
    wide = _words(text)
    out = np.zeros(max(0, len(at) - 1), np.int64)
    live = np.arange(len(out))
    for off in range(0, depth, 8):
        differ = wide[np.minimum(at[live] + off, len(text))] ^ wide[np.minimum(at[live + 1] + off, len(text))]
        stop = differ != 0
        # Equal bytes before the first that differs.
        last = differ[stop]
        equal = np.zeros(len(last), np.int64)
        for i in range(1, 8):
            equal += last < np.uint64(1 << 8 * (8 - i))
        out[live[stop]] = off + equal
        live = live[~stop]
    out[live] = depth
    return np.minimum(out, depth)


def repeated_windows(segments: list[bytes], twice: np.ndarray, k: int) -> list[np.ndarray]:
    """For each distinct segment which of its windows occur again, in it, in another, or
    because the whole segment does (``twice``)."""
    text = np.frombuffer(b"".join(segments), np.uint8)
    size = np.array([len(s) for s in segments])
    lead = np.r_[0, np.cumsum(size)]
    fits = np.zeros(len(text), bool)
    for a, n in zip(lead[:-1].tolist(), size.tolist(), strict=True):
        fits[a : a + n - k + 1] = True
    order = suffix_array(text, k)
    order = order[fits[order]]
    same = common_prefixes(text, order, k) >= k
    hit = np.zeros(len(text), bool)
    hit[order[:-1][same]] = True
    hit[order[1:][same]] = True
    return [np.ones(n - k + 1, bool) if w else hit[a : a + n - k + 1] for a, n, w in zip(lead[:-1].tolist(), size.tolist(), twice.tolist(), strict=True)]


def removed_runs(docs: DataFrame, k: int = 400) -> tuple[DataFrame, DataFrame]:
    """Keyed rows, and for those with repeated windows their runs (_id, _th, runs: first
    byte and number of windows)."""
    rows = C.keyed(docs)
    buckets = C.buckets_for(docs)

    def anchors(data, offsets):
        return segments_of(data, offsets, k)[:3]

    found = C.written(C.anchor_exchange(rows, C.text_anchors(anchors), False, buckets, PIECE), "repeats")
    # Occurrences of a row's minimisers: a hot one is known by the rows it was found in.
    hits = found.groupBy("_id", "_th").agg(F.collect_set("idx").alias("hits"))
    near = rows.join(hits.hint("shuffle_hash"), ["_id", "_th"]).select("_id", "_th", "text", "hits")
    near, hot = _hot_marked(near, found, k)

    def segments(batches):
        for group in C._gathered(C.slices_of(batches, PIECE), 6 << 20):
            yield from _segment_rows(group, k, buckets, hot)

    def verdict(table: pa.Table) -> pa.Table:
        return _segment_verdict(table, k)

    pieces = near.mapInArrow(segments, C.packed_schema(_PIECES)).groupBy("bucket").applyInArrow(verdict, "_id long, _th long, at int, n int")
    return rows, pieces.groupBy("_id", "_th").agg(F.collect_set(F.struct("at", "n")).alias("runs"))


def _hits(s: pa.RecordBatch, name: str, owner: np.ndarray) -> np.ndarray:
    """The segments that a column of their numbers within their rows names."""
    hits = s.column(s.schema.get_field_index(name))
    lead = np.searchsorted(owner, np.arange(s.num_rows + 1))
    row = np.repeat(np.arange(s.num_rows), np.asarray(hits.value_lengths().fill_null(0)))
    return np.unique(lead[row] + np.asarray(hits.flatten(), dtype=np.int64))


def _hot_marked(near: DataFrame, found: DataFrame, k: int) -> tuple[DataFrame, np.ndarray]:
    """Rows with a column ``hot`` (numbers of segments whose minimiser is hot; null where the
    list tells), and the list of hot minimisers, empty if there are too many to list."""
    none = near.withColumn("hot", F.lit(None).cast("array<int>"))
    if found.limit(HOT).count() < HOT:
        return none, np.zeros(0, C.U64)

    def counted(batches):
        for s in C.slices_of(batches, PIECE):
            key, owner, *_ = segments_of(*C.texts_of(s), k)
            keys, n = np.unique(key[_hits(s, "hits", owner)].view(np.int64), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(n)], names=["key", "n"])

    hot = C.written(near.mapInArrow(counted, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).where(F.col("n") >= HOT).select("key"), "hot")
    listed = hot.limit(LISTED + 1).collect()
    if len(listed) <= LISTED:
        return none, np.sort(np.array([r[0] for r in listed], np.int64).view(C.U64))

    def named(batches):
        for s in C.slices_of(batches, PIECE):
            key, owner, number, *_ = segments_of(*C.texts_of(s), k)
            take = _hits(s, "hits", owner)
            row = owner[take]
            cols = (C.longs_of(s, "_id")[row], C.longs_of(s, "_th")[row], number[take].astype(np.int32), key[take].view(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["_id", "_th", "idx", "key"])

    marks = near.mapInArrow(named, "_id long, _th long, idx int, key long").join(hot, "key", "left_semi")
    marks = marks.groupBy("_id", "_th").agg(F.collect_set("idx").alias("hot"))
    return near.join(marks, ["_id", "_th"], "left"), np.zeros(0, C.U64)


def _segment_rows(group, k, buckets, hot):
    out = []
    bodies, keys, owners, ats, counts, ids, ths, seen = [], [], [], [], [], [], [], 0
    hashes, wide = [], []
    for s in group:
        data, offsets = C.texts_of(s)
        key, owner, number, window, count = segments_of(data, offsets, k)
        take = _hits(s, "hits", owner)
        is_hot = np.isin(key[take], hot) | np.isin(take, _hits(s, "hot", owner))
        key, owner, window, count = key[take], owner[take], window[take], count[take]
        if is_hot.any():
            n, who, first = count[is_hot], owner[is_hot], window[is_hot]
            at = np.repeat(first - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())
            one, two = C.byte_gram_hashes(data, k)[at], C.gram_hashes(C.mix(C._SYMBOL)[data], k)[at]
            wide.append((one, two, np.repeat(who, n) + seen, at - offsets[np.repeat(who, n)]))
        key, owner, window, count = key[~is_hot], owner[~is_hot], window[~is_hot], count[~is_hot]
        end = window + count + k - 1
        raw = data.tobytes()
        bodies += [raw[a:b] for a, b in zip(window.tolist(), end.tolist(), strict=True)]
        hashes.append(C.span_hashes(data, window, end))
        keys.append(key)
        owners.append(owner + seen)
        ats.append(window - offsets[owner])
        counts.append(count)
        ids.append(C.longs_of(s, "_id"))
        ths.append(C.longs_of(s, "_th"))
        seen += s.num_rows
    ids, ths = np.concatenate(ids), np.concatenate(ths)
    key, owner, at, count, h = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (keys, owners, ats, counts, hashes))
    none = {"body": b"", **{n: np.zeros(0, np.uint32) for n in ("lens", "known", "occ", "owner", "at")}, **{n: np.zeros(0, np.uint64) for n in ("keys", "hash1", "hash2")}, "ids": ids[:0], "ths": ths[:0]}

    def add(bucket, kind, **x):
        used, local = np.unique(x["owner"], return_inverse=True)
        row = none | x | {"owner": local.astype(np.uint32), "ids": ids[used], "ths": ths[used]}
        out.append((bucket, kind, *(np.frombuffer(row["body"], np.uint8) if n == "body" else row[n] for n in _PIECES.split())))

    if len(key):
        order = np.lexsort((count, h, key))
        a, b, c = key[order], h[order], count[order]
        begin = np.flatnonzero(np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1]) | (c[1:] != c[:-1])])
        occ = np.diff(np.r_[begin, len(key)])
        known = occ > 1
        head = order[begin]
        again = np.zeros(len(key), bool)
        again[order] = np.repeat(known, occ)
        bucket = (C.mix(key[head]) >> C.U64(40)).astype(np.int64) % buckets
        for no, (h_, k_) in C.split_buckets(bucket, [head, known]):
            mine = h_[~k_]
            order_ = np.concatenate([mine, h_[k_]])
            add(no, 0, body=b"".join([bodies[i] for i in order_.tolist()]), lens=(count[order_] + k - 1).astype(np.uint32), keys=key[order_], known=np.r_[np.zeros(len(mine)), np.ones(k_.sum())].astype(np.uint32), owner=owner[mine], at=at[mine].astype(np.uint32))
        if again.any():
            add(int(ids[0]) % buckets, 1, owner=owner[again], at=at[again].astype(np.uint32), lens=count[again].astype(np.uint32))
    if wide:
        one, two, owner, at = (np.concatenate([w[i] for w in wide]) for i in range(4))
        order = np.lexsort((two, one))
        a, b = one[order], two[order]
        begin = np.flatnonzero(np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
        occ = np.diff(np.r_[begin, len(one)])
        again = np.zeros(len(one), bool)
        again[order] = np.repeat(occ > 1, occ)
        head, known = order[begin], occ > 1
        if again.any():
            who, _, first, n = _runs(owner[again], owner[again], owner[again], at[again])
            add(int(ids[0]) % buckets, 1, owner=who, at=first.astype(np.uint32), lens=n.astype(np.uint32))
        for no, (h_, k_) in C.split_buckets((C.mix(one[head]) >> C.U64(40)).astype(np.int64) % buckets, [head, known]):
            mine = np.concatenate([h_[~k_], h_[k_]])
            add(no, 2, hash1=one[mine], hash2=two[mine], known=np.r_[np.zeros((~k_).sum()), np.ones(k_.sum())].astype(np.uint32), owner=owner[mine], at=at[mine].astype(np.uint32))
    if out:
        yield C.packed(out, _PIECES)


def _segment_verdict(table: pa.Table, k: int) -> pa.Table:
    out: list[tuple] = []
    body, lens, keys, known, who, at, ids, ths = [], [], [], [], [], [], [], []
    hot: list[tuple] = []
    for r in range(table.num_rows):
        get = lambda n, t: np.frombuffer(table.column(n)[r].as_buffer(), t)  # noqa: B023, E731
        kind, owner, row_ids, row_ths = table.column("kind")[r].as_py(), get("owner", np.uint32), get("ids", np.int64), get("ths", np.int64)
        if kind == 1:
            out.append((row_ids[owner], row_ths[owner], get("at", np.uint32), get("lens", np.uint32)))
        elif kind == 2:
            hot.append((get("hash1", np.uint64), get("hash2", np.uint64), get("known", np.uint32), row_ids[owner], row_ths[owner], get("at", np.uint32)))
        else:
            n = get("lens", np.uint32)
            raw, ends = table.column("body")[r].as_py(), np.cumsum(n).tolist()
            body += [raw[e - m : e] for e, m in zip(ends, n.tolist(), strict=True)]
            lens.append(n)
            keys.append(get("keys", np.uint64))
            flags = get("known", np.uint32)
            known.append(flags)
            # Segments with one occurrence come first and bring it along.
            mine = len(owner)
            who.append(np.r_[np.ones(mine, np.int64), np.zeros(len(n) - mine, np.int64)])
            at.append(np.r_[get("at", np.uint32).astype(np.int64), np.zeros(len(n) - mine, np.int64)])
            ids.append(np.r_[row_ids[owner], np.zeros(len(n) - mine, np.int64)])
            ths.append(np.r_[row_ths[owner], np.zeros(len(n) - mine, np.int64)])
    if body:
        key, flag, has, at, ids, ths = (np.concatenate(x) for x in (keys, known, who, at, ids, ths))
        place: dict[bytes, int] = {}
        which = np.array([place.setdefault(b, len(place)) for b in body])
        distinct = list(place)
        twice = (np.bincount(which) > 1) | (np.bincount(which, weights=flag) > 0)
        group = np.zeros(len(distinct), np.uint64)
        group[which] = key
        # A minimiser group whose segments all occur twice has nothing left to find out.
        _, inverse = np.unique(group, return_inverse=True)
        settled = (np.bincount(inverse, weights=~twice) == 0)[inverse]
        hits: list = [np.ones(len(s) - k + 1, bool) if done else None for s, done in zip(distinct, settled.tolist(), strict=True)]
        order = np.argsort(group, kind="stable")
        order = order[~settled[order]]
        for block in _blocks(order, group, distinct):
            for i, found in zip(block, repeated_windows([distinct[i] for i in block], twice[block], k), strict=True):
                hits[i] = found
        for j in np.flatnonzero(has):
            found = hits[which[j]]
            turn = np.flatnonzero(np.diff(np.r_[False, found, False]))
            if len(turn):
                a, b = turn[::2], turn[1::2]
                out.append((np.full(len(a), ids[j]), np.full(len(a), ths[j]), at[j] + a, b - a))
    if hot:
        one, two, flag, ids, ths, at = (np.concatenate([h[i] for h in hot]) for i in range(6))
        order = np.lexsort((two, one))
        a, b = one[order], two[order]
        begin = np.flatnonzero(np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
        occ = np.diff(np.r_[begin, len(one)])
        hit = np.zeros(len(one), bool)
        hit[order] = np.repeat(occ > 1, occ)
        hit &= flag == 0
        row = C.address(ids[hit], ths[hit])
        out.append(_runs(ids[hit], ths[hit], row, at[hit]))
    names = ("_id", "_th", "at", "n")
    kinds = pa.schema([("_id", pa.int64()), ("_th", pa.int64()), ("at", pa.int32()), ("n", pa.int32())])
    return pa.table({n: np.concatenate([x[i] for x in out]).astype(np.int64) if out else np.zeros(0, np.int64) for i, n in enumerate(names)}).cast(kinds)


def _runs(ids, ths, row, at):
    """Consecutive windows of a row as one run."""
    order = np.lexsort((at, row))
    ids, ths, row, at = ids[order], ths[order], row[order], at[order].astype(np.int64)
    begin = np.flatnonzero(np.r_[True, (row[1:] != row[:-1]) | (at[1:] != at[:-1] + 1)][: len(row)])
    return ids[begin], ths[begin], at[begin], np.diff(np.r_[begin, len(row)])


def _blocks(order: np.ndarray, group: np.ndarray, distinct: list[bytes]):
    """Runs of whole minimiser groups of about BLOCK bytes."""
    block, size = [], 0
    for n, i in enumerate(order.tolist()):
        if size >= BLOCK and group[i] != group[order[n - 1]]:
            yield np.array(block)
            block, size = [], 0
        block.append(i)
        size += len(distinct[i])
    if block:
        yield np.array(block)


def dedup_bytes(docs: DataFrame, k: int = 400, with_text: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256; with ``with_text`` also kept
    (binary: the bytes that stay)."""
    rows, runs = removed_runs(docs, k)
    joined = rows.join(runs.hint("shuffle_hash"), ["_id", "_th"], "left").select("_id", "text", "runs")

    def digest(batches):
        for s in C.slices_of(batches, 8 << 20):
            data, offsets = C.texts_of(s)
            raw = data.tobytes()
            found = s.column(s.schema.get_field_index("runs"))
            made = []
            for a, b, runs in zip(offsets[:-1].tolist(), offsets[1:].tolist(), found, strict=True):
                body, gone, spans = raw[a:b], 0, 0
                if runs.is_valid:
                    edge = np.zeros(b - a + 1, np.int32)
                    value = runs.values
                    first, n = np.asarray(value.field("at")), np.asarray(value.field("n"))
                    np.add.at(edge, first, 1)
                    np.add.at(edge, first + n + k - 1, -1)
                    out = np.cumsum(edge[:-1]) > 0
                    gone, spans = int(out.sum()), int((np.diff(np.r_[False, out]) & out).sum())
                    body = data[a:b][~out].tobytes()
                made.append((b - a, gone, spans, hashlib.sha256(body).hexdigest(), body))
            cols = list(zip(*made, strict=True))
            arrays = [s.column(0), *(pa.array(c, pa.int64()) for c in cols[:3]), pa.array(cols[3], pa.string())]
            names = ["_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            if with_text:
                arrays.append(pa.array(cols[4], pa.binary()))
                names.append("kept")
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    schema = "_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * with_text
    return joined.mapInArrow(digest, schema).withColumn("doc_id", C.doc_id_of(F.col("_id"))).select("doc_id", *schema.replace("_id long, ", "", 1).replace(" long", "").replace(" string", "").replace(" binary", "").split(", "))


def op7_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_bytes(C.shipped(spark).read.parquet(f"{sf_dir}/documents.parquet"))
