"""Operator 3, n-gram Jaccard join: documents whose 5-word shingle sets are alike.

A document's set holds the 64-bit hashes of its distinct shingles (A-Z lower-cased); two
sets link when 100 * intersection >= 75 * union. Sets are globally ordered by hash.

1. Equal sets are one class. A linked set has at least n/16 of its first n/4 + n/12 tokens
   among another class's first tokens (prefix filter), found by a packed exchange of
   4 bytes a token; other classes are alone and go no further.
2. For the candidates a second exchange marks all tokens that another candidate has. A
   token of one set alone never matches, so it only counts; a class with under three
   quarters of its tokens shared is alone. Classes with equal shared tokens are one
   profile: whether two of its members link is arithmetic on their sizes. A member that
   links with any links with the smallest, the head; the others do not link among
   themselves, and the smallest of them speaks for them: a set that it doesn't link with
   links with none, and with the overlap the rest is arithmetic again.
3. Prefix-tree join: heads that share a prefix token are first gathered in clusters (each
   with the leader that most of its prefix tokens name); clusters of over ``BLOCK`` sets
   are cut by size (a band spans 3 to 4, so links stay in a band or its neighbours), then
   by hash, into blocks that share some pivots. A block's sets are stored in a trie, its tokens
   in a global order; each set goes down the trie once: overlaps are carried from the
   shared path, and a subtree is pruned when the overlap so far and the remaining lengths
   can't reach the bound. Links become connected components.
4. Heads that share a prefix token and are still in different components meet likewise:
   one of the smaller cluster goes down the trie of each of the larger one's blocks that has
   a head with the token and of a size that can link; in a cluster of many blocks those
   outside its main component do so with its other blocks. So no link that joins
   components is lost, and no group of near copies becomes all its pairs.

Defined results: null or empty text has an empty set and is alone, as is its component;
a null doc_id counts as the smallest long; repeated rows are copies. Two different sets
are taken as one class, and two shared parts as one profile, only if 128 bits of hash
agree; classes are then named by numbers that no two share.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from . import common as C

SHINGLE = 5
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_TOKENS = "token owner sids pids ns sizes labels clusters members blocks mains"
BLOCK, PIVOTS, BANDS, ASKERS = 800, 8, 128, 3200
#: Tokens of a block, and of the sets that one task asks it for.
BLOCK_TOKENS, ASK_TOKENS = 1 << 20, 1 << 21
_WHERE = ["label", "cluster", "members", "block", "main"]


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct tokens of all texts in order of (text, token), and where each text's begin."""
    data = _LOWER[data]
    starts, ends, first = C.words_of(data, offsets)
    symbols = C.span_hashes(data, starts, ends)
    count = np.diff(first)
    n = np.maximum(0, count - k + 1)
    text = np.repeat(np.arange(len(count)), n)
    at = np.arange(len(text)) - np.r_[0, np.cumsum(n)[:-1]][text] + first[:-1][text] if len(text) else np.zeros(0, np.int64)
    token = C.gram_hashes(symbols, k)[at]
    # Texts of fewer words: the whole sequence is the one shingle.
    few = np.flatnonzero((count > 0) & (count < k))
    whole = np.zeros(len(few), C.U64)
    for j in range(1, k):
        some = count[few] == j
        if some.any():
            whole[some] = C.mix(C.gram_hashes(symbols, j)[first[:-1][few[some]]] + C.U64(j))
    text, token = np.r_[text, few], np.r_[token, whole]
    order = np.lexsort((token, text))
    text, token = text[order], token[order]
    new = np.r_[True, (text[1:] != text[:-1]) | (token[1:] != token[:-1])][: len(text)]
    return token[new], np.searchsorted(text[new], np.arange(len(offsets)))


def _set_hash(tokens: np.ndarray, lead: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits for each set: sums of two scrambles of its tokens."""
    out = []
    for salt in (C.U64(0x243F6A8885A308D3), C.U64(0x13198A2E03707344)):
        total = np.r_[C.U64(0), np.cumsum(C.mix(tokens ^ salt), dtype=np.uint64)]
        out.append(C.mix(total[lead[1:]] - total[lead[:-1]] + np.diff(lead).astype(np.uint64)).view(np.int64))
    return out[0], out[1]


def _first_tokens(s: pa.RecordBatch):
    tokens, lead = shingle_sets(*C.texts_of(s))
    n = np.diff(lead)
    take = np.minimum(n, n // 4 + -(-n // 12))
    owner = np.repeat(np.arange(len(n)), take)
    at = np.arange(len(owner)) - np.repeat(np.r_[0, np.cumsum(take)[:-1]], take) + lead[:-1][owner]
    first, _ = _set_hash(tokens, lead)
    return tokens[at], owner, np.zeros(len(owner), np.int64), first, np.zeros(len(first), np.int64)


def _all_tokens(s: pa.RecordBatch):
    tokens, lead = _lists(s, "tokens")
    owner = np.repeat(np.arange(s.num_rows), np.diff(lead))
    sid = C.longs_of(s, "sid")
    return tokens, owner, np.arange(len(owner)) - lead[:-1][owner], sid, np.zeros(len(sid), np.int64)


def _lists(s: pa.RecordBatch, name: str) -> tuple[np.ndarray, np.ndarray]:
    """64-bit numbers kept as binary, and where each row's begin."""
    column = s.column(s.schema.get_field_index(name)).cast(pa.large_binary())
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw.copy().view(np.uint64), (bounds - bounds[0]) // 8


def _batch(names: str, *arrays) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([a if isinstance(a, pa.Array) else pa.array(a) for a in arrays], names=names.split())


def _binary(tokens: np.ndarray, lead: np.ndarray) -> pa.Array:
    raw = tokens.tobytes()
    bounds = (lead * 8).tolist()
    return pa.array([raw[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)], pa.binary())


def document_sets(docs: DataFrame) -> DataFrame:
    """_id, _th, n, s1, s2: the size and the 128-bit hash of each row's set."""

    def made(batches):
        for s in C.slices_of(batches):
            tokens, lead = shingle_sets(*C.texts_of(s))
            yield _batch("_id _th n s1 s2", C.longs_of(s, "_id"), C.longs_of(s, "_th"), np.diff(lead), *_set_hash(tokens, lead))
        C.hand_back()

    return C.keyed(docs).mapInArrow(made, "_id long, _th long, n long, s1 long, s2 long")


def _candidates(docs: DataFrame, sets: DataFrame) -> DataFrame:
    """Classes that may link: s1, s2, n, tokens, and sid, a number that no other class has."""
    hits = C.anchor_exchange(C.keyed(docs), _first_tokens, True, C.buckets_for(docs, each=32 << 20), form="packed")
    counts = hits.groupBy("target").applyInArrow(_summed, "s1 long, c long")
    reps = sets.where("n > 0").groupBy("s1", "s2").agg(F.min(F.struct("_id", "_th")).alias("r"), F.first("n").alias("n"))
    reps = reps.join(counts, "s1").where("16 * c >= n").select("r._id", "r._th")

    def made(batches):
        for s in C.slices_of(batches):
            tokens, lead = shingle_sets(*C.texts_of(s))
            yield _batch("s1 s2 n tokens", *_set_hash(tokens, lead), np.diff(lead), _binary(tokens, lead))

    near = C.keyed(docs).join(reps.hint("shuffle_hash"), ["_id", "_th"]).select("_id", "_th", "text")
    if sets.groupBy("_id", "_th").count().where("count > 1").limit(1).count():  # repeated rows
        near = near.dropDuplicates(["_id", "_th"])
    return near.mapInArrow(made, "s1 long, s2 long, n long, tokens binary").withColumn("sid", F.monotonically_increasing_id())


def _summed(table: pa.Table) -> pa.Table:
    """How many hits each class has in all buckets."""
    get = lambda n: np.concatenate([np.frombuffer(x.as_buffer(), np.int64) for x in table.column(n)])
    ids, inverse = np.unique(get("ids"), return_inverse=True)
    return pa.table({"s1": ids, "c": np.bincount(inverse, weights=get("counts")).astype(np.int64)})


def _members(candidates: DataFrame, buckets: int) -> DataFrame:
    """sid, n, pid and pid2 (128 bits of hash of the shared tokens), ns, tokens (shared
    ones): candidates with enough shared tokens."""
    shared = C.anchor_exchange(candidates.select("sid", "tokens"), _all_tokens, True, buckets, name="tokens", form="packed")

    def made(left: pa.Table, right: pa.Table) -> pa.Table:
        get = lambda n, t: np.concatenate([np.frombuffer(x.as_buffer(), t) for x in right.column(n)] or [np.zeros(0, t)])
        ids, count, at = get("ids", np.int64), get("counts", np.int64), get("idxs", np.uint32)
        out = []
        for s in left.combine_chunks().to_batches():
            tokens, lead = _lists(s, "tokens")
            own = C.longs_of(s, "sid")
            order = np.argsort(own, kind="stable")
            row = order[np.minimum(np.searchsorted(own[order], ids), len(own) - 1)]
            row, known = np.repeat(row, count), np.repeat(own[row] == ids, count)
            mark = np.zeros(len(tokens), bool)
            mark[lead[row[known]] + at[known]] = True
            n, ns = np.diff(lead), C.sums_by(mark, lead)
            keep = 4 * ns >= 3 * n
            mark &= np.repeat(keep, n)
            shared_tokens, begin = tokens[mark], np.r_[0, np.cumsum(np.where(keep, ns, 0))]
            out.append(_batch("sid n pid pid2 ns tokens", own, n, *_set_hash(shared_tokens, begin), ns, _binary(shared_tokens, begin)).filter(pa.array(keep)))
        kinds = pa.schema([*((c, pa.int64()) for c in ("sid", "n", "pid", "pid2", "ns")), ("tokens", pa.binary())])
        return pa.Table.from_batches(out, kinds) if out else kinds.empty_table()

    dealt = candidates.select(F.pmod("sid", F.lit(buckets)).alias("target"), "sid", "tokens")
    return dealt.groupBy("target").cogroup(shared.groupBy("target")).applyInArrow(made, "sid long, n long, pid long, pid2 long, ns long, tokens binary")


def _prefixes(members: DataFrame) -> DataFrame:
    """The members with their prefix tokens only: of two that link, one's is among the other's."""

    def made(batches):
        for s in C.slices_of(batches, name="tokens"):
            tokens, lead = _lists(s, "tokens")
            n, ns = C.longs_of(s, "n"), np.diff(lead)
            take = np.maximum(0, np.minimum(ns, ns + (-3 * n) // 4 + 1))  # ns - ceil(.75 n) + 1
            begin = np.r_[0, np.cumsum(take)]
            at = np.arange(begin[-1]) - np.repeat(begin[:-1], take) + np.repeat(lead[:-1], take)
            yield _batch("sid pid n ns tokens", C.longs_of(s, "sid"), C.longs_of(s, "pid"), n, ns, _binary(tokens[at], begin))

    return members.select("sid", "pid", "n", "tokens").mapInArrow(made, "sid long, pid long, n long, ns long, tokens binary")


def _token_rows(batches, buckets):
    for s in C.slices_of(batches, name="tokens"):
        tokens, lead = _lists(s, "tokens")
        sid, pid, n, ns, *where = (C.longs_of(s, c) for c in ("sid", "pid", "n", "ns", *_WHERE))
        take = np.diff(lead)
        owner = np.repeat(np.arange(len(ns)), take)
        at = np.arange(len(owner)) - np.repeat(np.r_[0, np.cumsum(take)[:-1]], take) + lead[:-1][owner]
        token = tokens[at]
        rows = []
        for b, (t, o) in C.split_buckets((C.mix(token) >> C.U64(40)).astype(np.int64) % buckets, [token, owner]):
            used, count = np.unique(o, return_counts=True)
            rows.append((b, 0, t, count.astype(np.uint32), sid[used], pid[used], n[used], ns[used], *(x[used] for x in where)))
        if rows:
            yield C.packed(rows, _TOKENS)


def _groups(table: pa.Table):
    """Heads by prefix token: token groups of two heads and more, as arrays."""
    parts: list[list[np.ndarray]] = [[] for _ in range(10)]
    for r in range(table.num_rows):
        get = lambda n, t: np.frombuffer(table.column(n)[r].as_buffer(), t)  # noqa: B023, E731
        count = get("owner", np.uint32)
        for p, x in zip(parts, (get("token", np.uint64), *(np.repeat(get(n, np.int64), count) for n in ("sids", "pids", "ns", "sizes", "labels", "clusters", "members", "blocks", "mains"))), strict=True):
            p.append(x)
    cols = [np.concatenate(p) for p in parts]
    # Of a profile the head and the smallest member that does not link with it: they have
    # every prefix token that larger ones have.
    token, sid, pid, n, ns = cols[:5]
    order = np.lexsort((sid, n, pid, token))
    cols = [c[order] for c in cols]
    token, sid, pid, n, ns = cols[:5]
    new = np.r_[True, (token[1:] != token[:-1]) | (pid[1:] != pid[:-1])][: len(token)]
    head = np.flatnonzero(new)[np.cumsum(new) - 1] if len(token) else np.zeros(0, np.int64)
    apart = 7 * ns < 3 * (n + n[head])
    apart[new] = False
    first = apart & ~np.r_[False, apart[:-1]][: len(apart)]
    cols = [c[new | first] for c in cols]
    begin = np.flatnonzero(np.r_[True, cols[0][1:] != cols[0][:-1]])
    size = np.diff(np.r_[begin, len(cols[0])])
    many = np.repeat(size > 1, size)
    return [c[many] for c in cols]


def _leaders(table: pa.Table) -> pa.Table:
    """Votes (p, q): q leads a token group of p, as the one with the fewest tokens of its own."""
    token, sid, _, n, ns, *_ = _groups(table)
    order = np.lexsort((sid, (n - ns) / np.maximum(1, n), token))
    token, sid = token[order], sid[order]
    begin = np.flatnonzero(np.r_[True, token[1:] != token[:-1]][: len(token)])
    lead = np.repeat(sid[begin], np.diff(np.r_[begin, len(token)]))
    pairs, votes = np.unique(np.stack([sid, lead], 1), axis=0, return_counts=True) if len(sid) else (np.zeros((0, 2), np.int64), np.zeros(0, np.int64))
    return pa.table({"p": pairs[:, 0].copy(), "q": pairs[:, 1].copy(), "votes": votes.astype(np.int64)})


def _meetings(table: pa.Table) -> pa.Table:
    """(cluster, block, sid): a head that shares a token with a head of that block, of another
    component and of a size that can link. Of two clusters the heads of the smaller one ask;
    in one cluster those outside its main component do. One that speaks for others (main
    -1) meets the blocks of its own component too."""
    token, sid, _, n, _, label, cluster, members, block, main = _groups(table)
    out, held, most = [], 0, 1 << 19
    order = np.lexsort((n, block, cluster, -members, token))
    token, sid, n, label, cluster, block, main = (x[order] for x in (token, sid, n, label, cluster, block, main))
    begin = np.flatnonzero(np.r_[True, token[1:] != token[:-1]][: len(token)])
    for a, b in zip(begin.tolist(), np.r_[begin[1:], len(token)].tolist(), strict=True):
        if cluster[a] == cluster[b - 1] and block[a] == block[b - 1]:
            continue
        new = cluster[a + 1 : b] != cluster[a : b - 1]
        of = np.r_[0, np.cumsum(new)]  # clusters, the largest first
        first = np.flatnonzero(np.r_[True, new | (block[a + 1 : b] != block[a : b - 1])])  # their blocks
        ends = np.r_[first[1:], b - a]
        low, high = np.minimum.reduceat(label[a:b], first), np.maximum.reduceat(label[a:b], first)
        spoken = np.minimum.reduceat(main[a:b], first) < 0
        begins = np.searchsorted(of, of[first])  # where the block's cluster begins
        for k, (at, end) in enumerate(zip(first.tolist(), ends.tolist(), strict=True)):
            ask = np.arange(begins[k], b - a)
            ask = ask[(ask < at) | (ask >= end)]
            x = a + ask
            apart = (of[ask] != of[at]) | (main[x] != 1)
            if low[k] == high[k] and not spoken[k]:
                apart &= (label[x] != low[k]) | (main[x] < 0)
            x = x[apart]
            sizes = n[a + at : a + end]
            near = np.searchsorted(sizes, -(-3 * n[x] // 4)) < np.searchsorted(sizes, 4 * n[x] // 3, "right")
            x = x[near]
            if len(x):
                out.append(np.stack([np.full(len(x), cluster[a + at]), np.full(len(x), block[a + at]), sid[x]], 1))
                held += len(x) + 12  # an array of few rows weighs as much as twelve
        if held > most:
            out = [np.unique(np.concatenate(out), axis=0)]
            held = len(out[0])
            most = max(most, 2 * held)
    found = np.unique(np.concatenate(out), axis=0) if out else np.zeros((0, 3), np.int64)
    return pa.table({name: found[:, i].copy() for i, name in enumerate(("cluster", "block", "sid"))})


class Trie:
    """Sorted sets as a compressed prefix tree; a node is the run up to the next branching."""

    def __init__(self, sets: list[np.ndarray], sizes: np.ndarray):
        # The global order of tokens: the commonest first, so that like sets share paths.
        every = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
        self.known, inverse, count = np.unique(every, return_inverse=True, return_counts=True)
        self.rank = np.empty(len(self.known), np.int64)
        self.rank[np.lexsort((self.known, -count))] = np.arange(len(self.known))
        ranks = self.rank[inverse]
        cuts = np.cumsum([len(s) for s in sets])[:-1]
        paths = [np.sort(x) for x in np.split(ranks, cuts)] if sets else []
        self.order = sorted(range(len(sets)), key=lambda i: paths[i].astype(">u4").tobytes())
        parent, begin, end, depth, leaf = [-1], [0], [0], [0], []
        run: list[np.ndarray] = []
        stack, used, before = [(0, 0)], 0, np.zeros(0, np.int64)  # (node, its depth in tokens)
        for i in self.order:
            path = paths[i]
            m = min(len(before), len(path))
            differ = np.flatnonzero(before[:m] != path[:m])
            shared = int(differ[0]) if len(differ) else m
            while stack[-1][1] > shared:
                node, at = stack.pop()
                if stack[-1][1] < shared:
                    # The run is split where the paths part.
                    top, high = stack[-1]
                    parent.append(top)
                    begin.append(begin[node])
                    end.append(begin[node] + shared - high)
                    depth.append(shared)
                    begin[node], parent[node] = end[-1], len(parent) - 1
                    stack.append((len(parent) - 1, shared))
            if len(path) > shared:
                parent.append(stack[-1][0])
                begin.append(used)
                run.append(path[shared:])
                used += len(path) - shared
                end.append(used)
                depth.append(len(path))
                stack.append((len(parent) - 1, len(path)))
            leaf.append(stack[-1][0])
            before = path
        self.run = np.concatenate(run) if run else np.zeros(0, np.int64)
        self.parent, self.begin, self.end, self.depth = (np.array(x, np.int64) for x in (parent, begin, end, depth))
        self.leaf = np.empty(len(sets), np.int64)
        self.leaf[self.order] = leaf
        self.sizes = sizes
        # Levels from the root; what each subtree can still give, and its smallest set.
        level = np.zeros(len(parent), np.int64)
        self.levels = [np.array([0])]
        rest = np.ones(len(parent), bool)
        rest[0] = False
        while rest.any():
            mine = np.flatnonzero(rest & ~rest[self.parent])
            level[mine] = len(self.levels)
            self.levels.append(mine)
            rest[mine] = False
        self.deepest = self.depth.copy()
        self.least = np.full(len(parent), 1 << 40)
        np.minimum.at(self.least, self.leaf, sizes)
        for nodes in self.levels[:0:-1]:
            np.maximum.at(self.deepest, self.parent[nodes], self.deepest[nodes])
            np.minimum.at(self.least, self.parent[nodes], self.least[nodes])
        self.member = np.zeros(len(self.known) + 1, np.int8)
        self.last = np.where(self.end > self.begin, self.run[np.maximum(self.end - 1, 0)] if used else 0, -1)

    def links(self, tokens: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """The sets that link with a set of these tokens and size, and the overlaps. Only
        the runs of paths that can still reach their bound are looked at."""
        at = np.minimum(np.searchsorted(self.known, tokens), max(0, len(self.known) - 1))
        mine = np.sort(self.rank[at[self.known[at] == tokens]]) if len(self.known) else np.zeros(0, np.int64)
        self.member[mine] = 1
        overlap, alive = np.zeros(len(self.parent), np.int64), np.zeros(len(self.parent), bool)
        alive[0] = True
        for nodes in self.levels[1:]:
            nodes = nodes[alive[self.parent[nodes]]]
            up = self.parent[nodes]
            need = -(-3 * (n + self.least[nodes]) // 7)
            # What the rest of the path and the rest of the set's tokens can give at most.
            rest = np.minimum(self.deepest[nodes] - self.depth[up], len(mine) - np.searchsorted(mine, self.last[up], "right"))
            able = overlap[up] + rest >= need
            nodes, up, need = nodes[able], up[able], need[able]
            if not len(nodes):
                break
            length = self.end[nodes] - self.begin[nodes]
            lead = np.r_[0, np.cumsum(length)]
            spots = np.arange(lead[-1]) + np.repeat(self.begin[nodes] - lead[:-1], length)
            overlap[nodes] = overlap[up] + C.sums_by(self.member[self.run[spots]], lead)
            rest = np.minimum(self.deepest[nodes] - self.depth[nodes], len(mine) - np.searchsorted(mine, self.last[nodes], "right"))
            alive[nodes] = overlap[nodes] + rest >= need
        self.member[mine] = 0
        hit = np.flatnonzero(alive[self.leaf] & (7 * overlap[self.leaf] >= 3 * (n + self.sizes)))
        return hit, overlap[self.leaf[hit]]


def _block_links(table: pa.Table) -> pa.Table:
    """Links (u, v, overlap) inside a block: asking rows go down the trie of the stored ones.
    Links that join nothing new are left out, but for sets that speak for others."""
    sid, n, asks, stored, speaks = (np.asarray(table.column(c)) for c in ("sid", "n", "asks", "stored", "speaks"))
    sets = [np.frombuffer(x.as_buffer(), np.uint64) for chunk in table.column("tokens").chunks for x in chunk]
    inside = np.flatnonzero(stored)
    trie = Trie([sets[i] for i in inside], n[inside])
    group = np.arange(len(sid))

    def root(x):
        while group[x] != x:
            group[x] = group[group[x]]
            x = group[x]
        return x

    out = []
    for i in np.flatnonzero(asks):
        hit, overlap = trie.links(sets[i], int(n[i]))
        for j, shared in zip(inside[hit].tolist(), overlap.tolist(), strict=True):
            a, b = root(int(i)), root(j)
            if a != b or (speaks[i] or speaks[j]) and sid[i] != sid[j]:
                group[max(a, b)] = min(a, b)
                out.append((sid[i], sid[j], shared))
    return pa.table({name: pa.array([x[k] for x in out], pa.int64()) for k, name in enumerate(("u", "v", "overlap"))})


def _all_links(links: DataFrame, slim: DataFrame, speakers: DataFrame) -> DataFrame:
    """The links found, and those of the members that a speaker speaks for."""
    both = links.select("u", "v", "overlap").unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v"), "overlap"))
    spoken = both.join(speakers.select(F.col("sid").alias("u"), "pid", "pid2", "least"), "u").join(slim.select(F.col("sid").alias("v"), F.col("n").alias("size")), "v")
    members = slim.select("pid", "pid2", "sid", "n", "ns")
    more = spoken.join(members, ["pid", "pid2"]).where("7 * ns < 3 * (n + least) and 7 * overlap >= 3 * (n + size)")
    return links.select("u", "v").unionByName(more.select(F.col("sid").alias("u"), "v"))


def _placed(members: DataFrame, clusters: DataFrame) -> DataFrame:
    """sid, cluster, size, band, parts and block of clusters (sid, cluster). Clusters of over
    BLOCK sets or BLOCK_TOKENS tokens are cut in bands of sizes 3 to 4 and these in parts of
    about as much; others are one block."""
    rows = clusters.join(members.select("sid", "n"), "sid")
    size = rows.groupBy("cluster").agg(F.count(F.lit(1)).alias("size"), F.sum("n").alias("tokens"))
    rows = rows.join(size, "cluster")
    # A cluster of few but long sets is cut like one of many.
    rows = rows.withColumn("size", F.when(F.col("tokens") > BLOCK_TOKENS, F.greatest("size", F.lit(BLOCK + 1))).otherwise(F.col("size"))).drop("tokens")
    rows = rows.withColumn("band", F.when(F.col("size") > BLOCK, F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(4 / 3)))).otherwise(0).cast("long"))
    parts = rows.groupBy("cluster", "band").agg(F.ceil(F.greatest(F.count(F.lit(1)) / BLOCK, F.sum("n") / BLOCK_TOKENS)).cast("long").alias("parts"))
    rows = rows.drop("n").join(parts, ["cluster", "band"])
    return rows.withColumn("block", F.col("band") + BANDS * F.pmod(F.xxhash64("sid"), F.col("parts")))


def _in_clusters(heads: DataFrame, placed: DataFrame, speakers: DataFrame) -> DataFrame:
    """Links inside the blocks of clusters; neighbouring blocks have common pivots."""
    # Pivots are the sets of a band with the fewest tokens of their own, from a fixed share of
    # sids; they go to all blocks of their band and of the bands next to it.
    rank = F.struct(F.col("own"), F.col("sid"))
    small = heads.select("sid", ((F.col("n") - F.col("ns")) / F.col("n")).alias("own"))
    big = placed.where(F.col("size") > BLOCK)
    pivots = big.join(small, "sid").groupBy("cluster", "band", F.pmod(F.xxhash64("sid"), F.lit(PIVOTS)).alias("part")).agg(F.min(rank).alias("r")).select("cluster", F.col("r.sid").alias("sid"), F.explode(F.array(*[F.col("band") + i for i in (-1, 0, 1)])).alias("band"))
    blocks = big.select("cluster", "band", "block").distinct()
    rows = placed.where("size > 1").select("sid", "cluster", "block").unionByName(pivots.join(blocks, ["cluster", "band"]).select("sid", "cluster", "block")).distinct()
    rows = heads.join(_speaking(rows, speakers), "sid").select("cluster", "block", "sid", "n", "speaks", "tokens", F.lit(True).alias("asks"), F.lit(True).alias("stored"))
    return rows.groupBy("cluster", "block").applyInArrow(_block_links, "u long, v long, overlap long")


def _speaking(rows: DataFrame, speakers: DataFrame) -> DataFrame:
    marked = rows.join(speakers.select("sid", F.lit(True).alias("speaks")), "sid", "left")
    return marked.withColumn("speaks", F.coalesce("speaks", F.lit(False)))


def _across(heads: DataFrame, placed: DataFrame, asking: DataFrame, speakers: DataFrame) -> DataFrame:
    """Links between heads and the blocks (cluster, block, sid) that they are to meet. The
    askers of a block are dealt over parts of about ``ASKERS`` sets and ``ASK_TOKENS`` tokens,
    each with the block's sets."""
    sizes = asking.join(heads.select("sid", "n"), "sid")
    wanted = sizes.groupBy("cluster", "block").agg(F.ceil(F.greatest(F.count(F.lit(1)) / ASKERS, F.sum("n") / ASK_TOKENS)).cast("long").alias("turns"))
    stored = placed.join(wanted, ["cluster", "block"]).select("cluster", "block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("turns") - 1)).alias("part"), "sid", F.lit(False).alias("asks"), F.lit(True).alias("stored"))
    asks = asking.join(wanted, ["cluster", "block"]).select("cluster", "block", F.pmod(F.xxhash64("sid"), F.col("turns")).alias("part"), "sid", F.lit(True).alias("asks"), F.lit(False).alias("stored"))
    rows = heads.select("sid", "n", "tokens").join(_speaking(stored.unionByName(asks), speakers), "sid")
    return rows.groupBy("cluster", "block", "part").applyInArrow(_block_links, "u long, v long, overlap long")


def components(edges: DataFrame, rounds: int = 64) -> DataFrame:
    """Connected components of edges (u, v): node, label (the least node). Label
    propagation with pointer jumping; each round is a written table that replaces the last."""
    both = C.written(edges.where("u <> v").unionByName(edges.where("u <> v").select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct(), "edges")
    labels = C.written(both.groupBy(F.col("u").alias("node")).agg(F.least(F.first("u"), F.min("v")).alias("label")), "labels")
    for _ in range(rounds):
        near = both.join(labels.select(F.col("node").alias("v"), "label"), "v").groupBy(F.col("u").alias("node")).agg(F.min("label").alias("near"))
        low = labels.join(near, "node", "left").select("node", F.col("label").alias("was"), F.least("label", F.coalesce("near", "label")).alias("low"))
        jump = labels.select(F.col("node").alias("low"), F.col("label").alias("next"))
        new = low.join(jump, "low", "left").select("node", F.least("low", F.coalesce("next", "low")).alias("label"), "was")
        seen = Observation()
        new = C.written(new.observe(seen, F.count(F.when(F.col("was") != F.col("label"), 1)).alias("changed")).select("node", "label"), "labels")
        C.discard(labels)
        labels = new
        if not seen.get["changed"]:
            C.discard(both)
            return labels
    raise RuntimeError("components did not settle")


def _marked(known: DataFrame, placed: DataFrame, speakers: DataFrame) -> DataFrame:
    """sid, label, cluster, block, members and main of heads (sid, label): 1 in the main
    component of its cluster, 0 outside, -1 for one that speaks for others."""
    known = known.join(placed.select("sid", "cluster", "block", F.col("size").alias("members")), "sid")
    main = known.groupBy("cluster", "label").agg(F.count(F.lit(1)).alias("c")).groupBy("cluster").agg(F.max(F.struct("c", "label")).alias("m")).select("cluster", F.col("m.label").alias("main"))
    marked = _speaking(known.join(main, "cluster"), speakers)
    return marked.withColumn("main", F.when(F.col("speaks"), -1).otherwise((F.col("label") == F.col("main")).cast("int")).cast("long")).drop("speaks")


def link_components(docs: DataFrame) -> DataFrame:
    """One row per row of docs: _id, _th, n, component (the smallest _id reached)."""
    sets = C.written(document_sets(docs), "sets")
    candidates = C.written(_candidates(docs, sets), "candidates")
    buckets = C.buckets_for(candidates, "tokens", 8 << 20)
    members = C.written(_members(candidates, buckets), "members")
    names = C.written(candidates.select("s1", "s2", "sid"), "names")
    C.discard(candidates)
    prefixes = C.written(_prefixes(members), "prefixes")
    slim = members.select("sid", "n", "pid", "pid2", "ns")
    profiles = slim.groupBy("pid", "pid2").agg(F.min(F.struct("n", "sid")).alias("h"), F.count(F.lit(1)).alias("size")).select("pid", "pid2", F.col("h.n").alias("least"), F.col("h.sid").alias("head"), "size")
    profiles = C.written(profiles, "profiles")
    # Members of one profile link with its head, if at all.
    inside = slim.join(profiles, ["pid", "pid2"]).where("7 * ns >= 3 * (n + least) and sid <> head").select(F.col("sid").alias("u"), F.col("head").alias("v"))

    def token_groups(rows: DataFrame, reduce, schema: str) -> DataFrame:
        packed = rows.select("sid", "pid", "n", "ns", *_WHERE, "tokens").mapInArrow(lambda b: _token_rows(b, buckets), C.packed_schema(_TOKENS))
        return packed.groupBy("bucket").applyInArrow(reduce, schema)

    votes = token_groups(prefixes.withColumns({"label": F.col("sid"), "cluster": F.col("sid"), "members": F.lit(1).cast("long"), "block": F.lit(0).cast("long"), "main": F.lit(1).cast("long")}), _leaders, "p long, q long, votes long")
    best = votes.groupBy("p", "q").agg(F.sum("votes").alias("votes")).groupBy("p").agg(F.max(F.struct(F.when(F.col("p") != F.col("q"), F.col("votes")).otherwise(0).alias("votes"), "q")).alias("b")).select("p", F.col("b.q").alias("q"))
    joined = components(best.select(F.col("p").alias("u"), F.col("q").alias("v")))
    clusters = slim.select("sid").join(joined, F.col("sid") == F.col("node"), "left").select("sid", F.coalesce("label", "sid").alias("cluster"))
    placed = C.written(_placed(members, clusters), "placed")
    apart = slim.join(profiles, ["pid", "pid2"]).where("7 * ns < 3 * (n + least)").groupBy("pid", "pid2").agg(F.min(F.struct("n", "sid")).alias("r"), F.count(F.lit(1)).alias("c"), F.first("least").alias("least"))
    speakers = C.written(apart.where("c > 1").select(F.col("r.sid").alias("sid"), "pid", "pid2", "least"), "speakers")
    found = C.written(_in_clusters(members, placed, speakers), "found")
    edges = C.written(inside.unionByName(_all_links(found, slim, speakers)), "links")
    labels = components(edges)
    known = slim.select("sid").join(labels, F.col("sid") == F.col("node"), "left").select("sid", F.coalesce("label", "sid").alias("label"))
    known = C.written(_marked(known, placed, speakers), "labels")
    meetings = token_groups(prefixes.join(known, "sid"), _meetings, "cluster long, block long, sid long")
    asking = C.written(meetings.distinct(), "meetings")
    across = C.written(_across(members, placed, asking, speakers), "found")
    more = C.written(_all_links(across, slim, speakers), "links")
    if more.limit(1).count():
        C.discard(labels)
        labels = components(edges.unionByName(more))
    C.discard(members, prefixes, profiles, joined, placed, speakers, found, edges, known, asking, across, more)
    # The smallest id of each class, then of each component, then back to the rows.
    classes = sets.where("n > 0").groupBy("s1", "s2").agg(F.min("_id").alias("least"))
    labels = names.join(labels, F.col("sid") == F.col("node")).select("s1", "s2", "label")
    known = classes.join(labels, ["s1", "s2"], "left").select("s1", "s2", "least", "label")
    lowest = known.where("label is not null").groupBy("label").agg(F.min("least").alias("lowest"))
    of = known.join(lowest, "label", "left").select("s1", "s2", F.coalesce("lowest", "least").alias("component"))
    joined = sets.join(of, ["s1", "s2"], "left")
    return joined.select("_id", "_th", "n", F.when(F.col("n") == 0, F.col("_id")).otherwise(F.col("component")).alias("component"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of docs that are the smallest id of their component; rows of empty sets
    stay. Of repeated rows and rows that share that id one stays."""
    links = C.written(link_components(docs), "components")
    least = links.where("n > 0 and _id = component").groupBy("_id").agg(F.min("_th").alias("_th"))
    alone = links.where("n = 0").select("_id", "_th").distinct()
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.coalesce(F.col("doc_id").cast("long"), F.lit(C.NO_ID)).alias("_id"), F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("_th"))
    kept = rows.join(least.unionByName(alone).hint("shuffle_hash"), ["_id", "_th"], "left_semi")
    if links.where("n > 0").groupBy("_id", "_th").count().where("count > 1").limit(1).count():
        kept = kept.dropDuplicates(["_id", "_th"])
    return kept.select("_row.*")


def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = C.shipped(spark).read.parquet(f"{sf_dir}/documents.parquet")
    return link_components(docs).select(C.doc_id_of(F.col("_id")).alias("doc_id"), F.col("n").alias("n_shingles"), C.doc_id_of(F.col("component")).alias("component_id"))
