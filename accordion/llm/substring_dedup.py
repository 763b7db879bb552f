"""Operator 9, substring dedup: de Bruijn compaction of repeated token k-mers.

An edge of the graph is a window of ``k`` words (13); its nodes are the k-1 words at
either end. The graph has the edges that two or more ``doc_id`` hold; the source of an
edge is its smallest ``doc_id`` and the place there.

1. Edges are dealt out by their minimiser (the smallest of the word 5-grams inside), so a
   run of edges with one minimiser travels as one. Minimisers that occur in one row only
   hold no repeated edge and go no further (a packed exchange of 4 bytes a minimiser).
2. In a bucket the repeated edges, in the order of their sources, compact to pieces: two
   edges that follow one another in their source stay together where the node between
   has one edge in and one out. Every other occurrence is given as runs over pieces, with
   the coordinates of the source.
3. Runs meet in a Spark aggregation by row and, in a join with the rows, are glued to long
   spans: runs that go on where the last one ended, in the row and in the same source.
   Coordinates that do not agree begin another span. Spans become removed words.

``repeated_paths`` gives the graph itself: pieces compact through Spark joins to whole
nonbranching paths. Degrees count the pieces that begin and end at a node, a node with one
of either links the two, and pointer jumping gives each piece its path and place on it.
A side branch inside a piece that only shows in another bucket does not cut it; cycles
stay pieces. Removal does not wait for these joins: a removed word only needs to know
that a smaller id has its window, and the joins cost more than twice the rest (README).

Hot keys: each task first reduces its own rows, so an edge that a third of all rows hold
reaches its bucket once per gathered batch; the occurrences reduced away were compared
with their batch's source word by word (64 bits a word). Edges of different batches
compare by 128 bits of hash, not by their words. Defined results: null or empty text has
no words; a null ``doc_id`` counts as smaller than all others; rows that share a
``doc_id`` never remove words from each other; repeated rows have the same result; other
columns are not looked at.
"""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common as C

GRAM = 5
_PIECES = "nodes lens marks owner at ids ths"
#: Kind 0: a piece, with its name and end nodes. Others: a run, with its source's address
#: and how far ahead the source is in words.
_FOUND = "kind int, _id long, _th long, at int, n int, pid long, a long, b long, sid long, sth long, off int"


def super_edges(data: np.ndarray, offsets: np.ndarray, k: int):
    """The super-edges of a slice of texts: key, text, number within its text, first
    window (word number in the slice) and how many windows; then the word symbols."""
    starts, ends, first = C.words_of(data, offsets)
    symbols = C.span_hashes(data, starts, ends)
    grams = C.gram_hashes(symbols, min(GRAM, k))
    low = C.window_minima(grams, k - min(GRAM, k) + 1)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    windows = np.flatnonzero(text[: len(low)] == text[k - 1 : k - 1 + len(low)]) if len(low) else np.zeros(0, np.int64)
    if not len(windows):
        none = np.zeros(0, np.int64)
        return np.zeros(0, C.U64), none, none, none, none, symbols, first
    place, owner = low[windows], text[windows]
    new = np.r_[True, (place[1:] != place[:-1]) | (owner[1:] != owner[:-1])]
    begin = np.flatnonzero(new)
    count = np.diff(np.r_[begin, len(windows)])
    owner = owner[begin]
    lead = np.searchsorted(owner, np.arange(len(offsets)))
    return grams[place[begin]], owner, np.arange(len(owner)) - lead[owner], windows[begin], count, symbols, first


def _by_row(found: DataFrame) -> DataFrame:
    """For each row with repeated edges its runs (_id, _th, runs)."""
    return found.where("kind > 0").groupBy("_id", "_th").agg(F.collect_set(F.struct("at", "n", "sid", "sth", "off")).alias("runs"))


def _spans(docs: DataFrame, k: int, more: tuple, names: tuple) -> tuple[DataFrame, DataFrame]:
    """Keyed rows (with columns ``more``, called ``names``), and what the buckets found."""
    rows = C.keyed(docs, *more)
    buckets = C.buckets_for(docs)

    def anchors(data, offsets):
        return super_edges(data, offsets, k)[:3]

    hits = C.anchor_exchange(C.keyed(docs), C.text_anchors(anchors), True, buckets).groupBy("_id", "_th").agg(F.collect_set("idx").alias("hits"))
    near = rows.join(hits.hint("shuffle_hash"), ["_id", "_th"]).select("_id", "_th", "text", "hits", *names)

    def edges(batches):
        for group in C._gathered(C.slices_of(batches), 8 << 20):
            yield from _edge_rows(group, k, buckets)
            C.hand_back()

    def verdict(table: pa.Table) -> pa.Table:
        found = _edge_verdict(table)
        C.hand_back()
        return found

    return rows, near.mapInArrow(edges, C.packed_schema(_PIECES)).groupBy("bucket").applyInArrow(verdict, _FOUND)


def repeated_paths(docs: DataFrame, k: int = 13) -> DataFrame:
    """The nonbranching paths of the repeated edges, piece by piece: path, place (edges of
    the path before the piece), n (its edges), and its source doc_id and first word."""
    _, found = _spans(docs, k, (), ())
    pieces = C.written(found.where("kind = 0"), "pieces")
    places = compacted(pieces.select("pid", "n", "a", "b"))
    joined = pieces.join(places, "pid", "left")
    return joined.select(F.coalesce("path", "pid").alias("path"), F.coalesce("place", F.lit(0).cast("long")).alias("place"), "n", C.doc_id_of(F.col("_id")).alias("doc_id"), "at")


def compacted(pieces: DataFrame) -> DataFrame:
    """pid, path (the first piece's pid) and place (edges before it) of the pieces (pid, n,
    a, b: begin and end node) that have a predecessor on a nonbranching path."""
    begins = pieces.groupBy(F.col("a").alias("node")).agg(F.count(F.lit(1)).alias("out"), F.min("pid").alias("pid")).where("out = 1")
    ends = pieces.groupBy(F.col("b").alias("node")).agg(F.count(F.lit(1)).alias("in"), F.min(F.struct("pid", "n")).alias("before")).where("in = 1")
    links = begins.join(ends, "node").where("pid <> before.pid").select("pid", F.col("before.pid").alias("path"), F.col("before.n").cast("long").alias("place"))
    places, left = C.written(links, "paths"), None
    while True:
        # Each piece takes over what the piece it points to points to.
        up = places.select(F.col("pid").alias("path"), F.col("path").alias("far"), F.col("place").alias("more"))
        jumped = places.join(up, "path", "left").select("pid", F.coalesce("far", "path").alias("path"), (F.col("place") + F.coalesce("more", F.lit(0))).alias("place"), F.col("far").isNotNull().alias("open"))
        seen = Observation()
        new = C.written(jumped.observe(seen, F.count(F.when(F.col("open"), 1)).alias("open")), "paths")
        C.discard(places)
        places, before, left = new, left, seen.get["open"]
        # The open ones on paths get fewer each round; those on cycles stay open for good.
        if not left or left == before:
            return places.where("not open").drop("open")


def _edge_rows(group, k, buckets):
    """Packed edges of gathered rows. Kind 0: those of the batch's smallest id, with a mark
    where the batch reduced others away; kind 1: where these others stand."""
    cols: list[list[np.ndarray]] = [[] for _ in range(6)]
    ids, ths, words, seen, n_words = [], [], [], 0, 0
    for s in group:
        data, offsets = C.texts_of(s)
        key, owner, number, window, count, symbols, first = super_edges(data, offsets, k)
        hits = s.column(s.schema.get_field_index("hits"))
        hit_owner = np.repeat(np.arange(s.num_rows), np.asarray(hits.value_lengths().fill_null(0)))
        lead = np.searchsorted(owner, np.arange(s.num_rows + 1))
        take = np.unique(lead[hit_owner] + np.asarray(hits.flatten()))
        count = count[take]
        at = np.repeat(window[take] - np.r_[0, np.cumsum(count)[:-1]], count) + np.arange(count.sum())
        who = np.repeat(owner[take], count)
        nodes = C.gram_hashes(symbols, k - 1)
        for c, x in zip(cols, (nodes[at], nodes[at + 1], np.repeat(key[take], count), who + seen, at - first[who], at + n_words), strict=True):
            c.append(x.astype(np.int32) if x.dtype == np.int64 else x)  # places in the batch
        del nodes, at, who, take
        ids.append(C.longs_of(s, "_id"))
        ths.append(C.longs_of(s, "_th"))
        words.append(symbols)
        seen += s.num_rows
        n_words += len(symbols)
    left, right, key, owner, at, word = (np.concatenate(c) for c in cols)
    ids, ths, words = np.concatenate(ids), np.concatenate(ths), np.concatenate(words)
    del cols
    if not len(left):
        return
    number, source = _edges(left, right, ids[owner], ths[owner], at)
    own = source[number]
    later = ids[owner] > ids[owner[own]]
    # Word by word: what is reduced away says what its source says.
    for i in range(k):
        later[later] &= words[word[later] + i] == words[word[own[later]] + i]
    reduced = np.zeros(len(source), bool)
    reduced[number[later]] = True
    mark = reduced[number]
    del words, word, number
    out = []

    # Runs of edges that are sent: one node more than edges.
    sent = np.flatnonzero(~later)
    goes_on = (owner[sent[1:]] == owner[sent[:-1]]) & (at[sent[1:]] == at[sent[:-1]] + 1) & (key[sent[1:]] == key[sent[:-1]])
    first = np.flatnonzero(np.r_[True, ~goes_on][: len(sent)])
    lens = np.diff(np.r_[first, len(sent)])
    head = sent[first]
    bucket = (C.mix(key[head]) >> C.U64(40)).astype(np.int64) % buckets
    order = np.argsort(bucket, kind="stable")
    cuts = np.flatnonzero(np.diff(bucket[order])) + 1
    for runs in np.split(order, cuts) if len(order) else ():
        n = lens[runs]
        edge = np.repeat(head[runs] - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())
        nodes = np.empty(int((n + 1).sum()), np.uint64)
        end = np.cumsum(n + 1) - 1
        inner = np.ones(len(nodes), bool)
        inner[end] = False
        nodes[inner], nodes[end] = left[edge], right[head[runs] + n - 1]
        used, local = np.unique(owner[head[runs]], return_inverse=True)
        out.append((int(bucket[runs[0]]), 0, nodes, n.astype(np.uint32), np.packbits(mark[edge]), local.astype(np.uint32), at[head[runs]].astype(np.uint32), ids[used], ths[used]))
    if later.any():
        i, t, p, n, sid, sth, off = _runs(np.flatnonzero(later), ids, ths, owner, at, own)
        out.append((int(ids[0]) % buckets, 1, left[:0], n.astype(np.uint32), np.zeros(0, np.uint8), off.astype(np.int32), p.astype(np.uint32), np.r_[i, sid], np.r_[t, sth]))
    yield C.packed(out, _PIECES)


def _runs(which, ids, ths, owner, at, source, piece=None):
    """Of the occurrences ``which`` (in the order of their rows) the runs that go on in their
    row and in one source (and on one piece): row address, first word, edges, source
    address, and how many words the source is ahead."""
    row, place, there = owner[which], at[which].astype(np.int64), source[which]
    off, far = at[there].astype(np.int64) - place, owner[there]
    goes_on = (row[1:] == row[:-1]) & (place[1:] == place[:-1] + 1) & (far[1:] == far[:-1]) & (off[1:] == off[:-1])
    if piece is not None:
        goes_on &= piece[which[1:]] == piece[which[:-1]]
    first = np.flatnonzero(np.r_[True, ~goes_on][: len(row)])
    return ids[row[first]], ths[row[first]], place[first], np.diff(np.r_[first, len(row)]), ids[far[first]], ths[far[first]], off[first]


def _edges(left, right, ids, ths, at) -> tuple[np.ndarray, np.ndarray]:
    """The distinct edge of each occurrence, and of each edge the occurrence that is its
    source: the smallest id, hash of the text and place."""
    order = np.lexsort((at, ths, ids, right, left))
    a, b = left[order], right[order]
    new = np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])]
    number = np.empty(len(order), np.int64)
    number[order] = np.cumsum(new) - 1
    return number, order[new]


def _edge_verdict(table: pa.Table) -> pa.Table:
    """Of a bucket the pieces (kind 0), the occurrences as runs over them (kind 1), and what
    the batches found (kind 2)."""
    cols: list[list[np.ndarray]] = [[] for _ in range(5)]
    every_id, every_th, out, seen = [], [], [], 0
    none = lambda n: np.zeros(n, np.int64)
    for r in range(table.num_rows):
        get = lambda n, t: np.frombuffer(table.column(n)[r].as_buffer(), t)  # noqa: B023, E731
        lens, ids, ths, first = get("lens", np.uint32).astype(np.int64), get("ids", np.int64), get("ths", np.int64), get("at", np.uint32).astype(np.int64)
        if table.column("kind")[r].as_py():
            n = len(lens)
            out.append((none(n) + 2, ids[:n], ths[:n], first, lens, *[none(n)] * 3, ids[n:], ths[n:], get("owner", np.int32)))
            continue
        nodes, owner = get("nodes", np.uint64), get("owner", np.uint32).astype(np.int64)
        lead = np.r_[0, np.cumsum(lens)]
        inner = np.arange(lead[-1]) - np.repeat(lead[:-1], lens)
        spot = np.repeat(lead[:-1] + np.arange(len(lens)), lens) + inner
        marks = np.unpackbits(get("marks", np.uint8), count=int(lead[-1])).astype(bool)
        for c, x in zip(cols, (nodes[spot], nodes[spot + 1], np.repeat(owner + seen, lens), np.repeat(first, lens) + inner, marks), strict=True):
            c.append(x)
        every_id.append(ids)
        every_th.append(ths)
        seen += len(ids)
    if seen:
        left, right, owner, at, reduced = (np.concatenate(c) for c in cols)
        ids, ths = np.concatenate(every_id), np.concatenate(every_th)
        cols.clear()
        number, source = _edges(left, right, ids[owner], ths[owner], at)
        own = source[number]
        later = ids[owner] > ids[owner[own]]
        repeated = np.zeros(len(source), bool)
        repeated[number[later | reduced]] = True
        # Repeated edges in the order of their sources; where pieces begin.
        edge = np.flatnonzero(repeated)
        s = source[edge]
        order = np.lexsort((at[s], owner[s], ths[owner[s]], ids[owner[s]]))
        edge, s = edge[order], s[order]
        goes_on = (owner[s[1:]] == owner[s[:-1]]) & (at[s[1:]] == at[s[:-1]] + 1) & _alone(right[s])[:-1] & _alone(left[s])[1:]
        first = np.flatnonzero(np.r_[True, ~goes_on][: len(s)])
        length = np.diff(np.r_[first, len(s)])
        if len(s):
            head, last, n = s[first], s[first + length - 1], len(first)
            pid = (table.column("bucket")[0].as_py() << 32) + np.arange(n)
            out.append((none(n), ids[owner[head]], ths[owner[head]], at[head], length, pid, left[head].view(np.int64), right[last].view(np.int64), *[none(n)] * 3))
        # The later occurrences: runs that follow their piece.
        piece = none(len(source))
        piece[edge] = np.repeat(np.arange(len(first)), length)
        which = np.flatnonzero(later)
        which = which[np.lexsort((at[which], owner[which]))]
        i, t, p, n, sid, sth, off = _runs(which, ids, ths, owner, at, own, piece[number])
        out.append((none(len(i)) + 1, i, t, p, n, *[none(len(i))] * 3, sid, sth, off))
    names = ("kind", "_id", "_th", "at", "n", "pid", "a", "b", "sid", "sth", "off")
    kinds = pa.schema([(n, pa.int32() if n in ("kind", "at", "n", "off") else pa.int64()) for n in names])
    return pa.table({n: np.concatenate([x[i] for x in out]).astype(np.int64) if out else none(0) for i, n in enumerate(names)}).cast(kinds)


def _alone(nodes: np.ndarray) -> np.ndarray:
    """Which nodes are there once."""
    _, inverse, count = np.unique(nodes, return_inverse=True, return_counts=True)
    return count[inverse] == 1


def _spans_of(batch: pa.RecordBatch, k: int):
    """The long spans of a batch's rows: row, first word, words; runs that go on in their row
    and in one source are one span."""
    runs = batch.column(batch.schema.get_field_index("runs"))
    row = np.repeat(np.arange(batch.num_rows), np.asarray(runs.value_lengths().fill_null(0)))
    value = runs.flatten()
    at, n, sid, sth, off = (np.asarray(value.field(c), dtype=np.int64) for c in ("at", "n", "sid", "sth", "off"))
    order = np.lexsort((at, off, sth, sid, row))
    row, at, n, sid, sth, off = (x[order] for x in (row, at, n, sid, sth, off))
    goes_on = (row[1:] == row[:-1]) & (sid[1:] == sid[:-1]) & (sth[1:] == sth[:-1]) & (off[1:] == off[:-1]) & (at[1:] == at[:-1] + n[:-1])
    first = np.flatnonzero(np.r_[True, ~goes_on][: len(row)])
    last = np.r_[first[1:], len(row)] - 1
    return row[first], at[first], (at[last] + n[last] - at[first] + k - 1 if len(first) else at[first])


def dedup_words(docs: DataFrame, k: int = 13, with_text: bool = False, more: tuple = (), names: tuple = ()) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_removed, kept_sha256, n_paths (long
    spans of repeated words, which may overlap), longest_path (words of the longest), with
    ``with_text`` kept_text (kept words joined by one space), and the columns ``more``,
    called ``names``."""
    rows, found = _spans(docs, k, more, names)
    joined = rows.join(_by_row(found).hint("shuffle_hash"), ["_id", "_th"], "left").select("_id", "_th", "text", "runs", *names)
    schema = "_id long, _th long, n_words long, n_removed long, kept_sha256 string, n_paths long, longest_path long" + ", kept_text string" * with_text

    def digest(batches):
        for batch in C.slices_of(batches, 16 << 20):
            texts = batch.column(batch.schema.get_field_index("text")).cast(pa.large_binary())
            row, first, length = _spans_of(batch, k)
            lead = np.searchsorted(row, np.arange(batch.num_rows + 1))
            made = []
            for text, a, b in zip(texts, lead[:-1].tolist(), lead[1:].tolist(), strict=True):
                words = kept = text.as_py().split()
                if b > a:
                    edge = np.zeros(len(words) + 1, np.int64)
                    np.add.at(edge, first[a:b], 1)
                    np.add.at(edge, first[a:b] + length[a:b], -1)
                    kept = list(compress(words, np.cumsum(edge[:-1]) == 0))
                body = b" ".join(kept)
                made.append((len(words), len(words) - len(kept), hashlib.sha256(body).hexdigest(), b - a, int(length[a:b].max(initial=0)), body if with_text else b""))
            cols = list(zip(*made, strict=True))
            data = [batch.column(0), batch.column(1), *(pa.array(c, pa.int64()) for c in cols[:2]), pa.array(cols[2], pa.string()), *(pa.array(c, pa.int64()) for c in cols[3:5])]
            made_names = ["_id", "_th", "n_words", "n_removed", "kept_sha256", "n_paths", "longest_path"]
            if with_text:
                data.append(pa.array(cols[5], pa.binary()).cast(pa.string()))
                made_names.append("kept_text")
            yield pa.RecordBatch.from_arrays([*data, *(batch.column(batch.schema.get_field_index(n)) for n in names)], names=[*made_names, *names])
        C.hand_back()

    return joined.mapInArrow(digest, T.StructType([*T._parse_datatype_string(schema), *(joined.schema[n] for n in names)]))


def without_repeats(docs: DataFrame, k: int = 13) -> DataFrame:
    """The rows of docs with repeated words taken out: text (as it was where nothing
    repeats, else the kept words joined by one space) and n_chars follow."""
    more = tuple(F.col(f"`{c}`").alias(f"_c{i}") for i, c in enumerate(docs.columns))
    names = tuple(f"_c{i}" for i in range(len(docs.columns)))
    found = dedup_words(docs, k, with_text=True, more=more, names=names)
    text = F.when(F.col("n_removed") > 0, F.col("kept_text"))
    columns = {c: F.col(f"_c{i}") for i, c in enumerate(docs.columns)}
    columns["text"] = F.coalesce(text, columns["text"].cast("string"))
    if "n_chars" in columns:
        columns["n_chars"] = F.when(F.col("n_removed") > 0, F.length("kept_text")).otherwise(columns["n_chars"]).cast(docs.schema["n_chars"].dataType)
    return found.select(*[v.alias(c) for c, v in columns.items()])


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = C.shipped(spark).read.parquet(f"{sf_dir}/documents.parquet")
    return dedup_words(docs).select(C.doc_id_of(F.col("_id")).alias("doc_id"), "n_words", "n_removed", "kept_sha256")
