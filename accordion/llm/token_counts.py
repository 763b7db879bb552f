"""Operator 8, token counts that follow edits.

A text is split into pre-tokens by the tokenizer's pattern; each pre-token's token count is
a leaf value. Leaves are kept in groups, and a segment tree holds the sums of the groups.
An edit re-encodes from two pre-tokens before the changed place (a pre-token may grow, and
the pattern looks one character past white space) until a new boundary falls on an old one
past the change; from there the old leaves hold, as matching looks only ahead. Then the
sums on the changed groups' paths are updated.

``keep_trees`` makes a table with each document's leaves and tree; ``apply_edits`` takes
such a table and a table of edits and gives the table after them: only documents that
have edits are looked at, and of those only what the edits touch is encoded. The query
``op8_token_counts`` builds the trees and edits them in one pass (``count_tokens``), as a
table of all trees between would be written once and read once.

The vocabulary is a public byte-level BPE rank file, read on the driver (its path is a
parameter) and sent along (under a megabyte). Encoders remember pre-tokens of at most
``SHORT`` characters, a bounded number. Defined results: null or empty text has no tokens;
edits are clipped to the text; rows that share a doc_id all get its edits; a null doc_id
gets none; repeated rows are counted alike.
"""

from __future__ import annotations

import base64
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: The pre-token pattern that belongs to the vocabulary (fixed value).
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
GROUP, CACHE, SHORT = 64, 200_000, 64


class Encoder:
    """Token counts of pre-tokens, remembering the commonest (a bounded number)."""

    def __init__(self, ranks: bytes):
        import regex
        import tiktoken

        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
        self.whole = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=table, special_tokens={})
        self.pattern, self.known = regex.compile(PATTERN), {}

    def counts(self, pieces: list[str]) -> list[int]:
        known = self.known
        if len(known) > CACHE:
            known.clear()
        out = list(map(known.get, pieces))
        if None in out:
            for i, n in enumerate(out):
                if n is None:
                    n = known.get(pieces[i])
                    if n is None:
                        n = len(self.whole.encode_ordinary(pieces[i]))
                        if len(pieces[i]) <= SHORT:
                            known[pieces[i]] = n
                    out[i] = n
        return out


class SegmentTree:
    """Sums over a list of numbers; a power of two of leaves."""

    def __init__(self, values):
        n = len(values)
        self.size = 1 << max(0, (max(1, n) - 1).bit_length())
        self.node = np.zeros(2 * self.size, np.int64)
        self.node[self.size : self.size + n] = values
        level = self.size
        while level > 1:
            half = level // 2
            self.node[half:level] = self.node[level : 2 * level].reshape(-1, 2).sum(1)
            level = half

    @classmethod
    def of(cls, nodes: np.ndarray) -> SegmentTree:
        """The tree of these nodes."""
        tree = cls.__new__(cls)
        tree.node, tree.size = nodes.copy(), len(nodes) // 2
        return tree

    def set(self, at: int, value: int) -> None:
        at += self.size
        self.node[at] = value
        while at > 1:
            at //= 2
            self.node[at] = self.node[2 * at] + self.node[2 * at + 1]

    def total(self) -> int:
        return int(self.node[1])

    def find(self, amount: int) -> tuple[int, int]:
        """The leaf in which the running sum passes ``amount``, and the sum before it."""
        at, before = 1, 0
        while at < self.size:
            at *= 2
            if before + self.node[at] <= amount:
                before += int(self.node[at])
                at += 1
        return at - self.size, before


class TokenTree:
    """The token count of a text under edits."""

    def __init__(self, text: str, encoder: Encoder):
        self.text, self.encoder = text, encoder
        pieces = encoder.pattern.findall(text)
        self.encoded = len(pieces)
        self._group(np.fromiter(map(len, pieces), np.int64, len(pieces)), np.fromiter(encoder.counts(pieces), np.int64, len(pieces)))

    def _group(self, lengths: np.ndarray, counts: np.ndarray) -> None:
        cuts = range(0, max(1, len(lengths)), GROUP)
        self.lengths = [lengths[a : a + GROUP] for a in cuts]
        self.counts = [counts[a : a + GROUP] for a in cuts]
        self.chars = SegmentTree([int(x.sum()) for x in self.lengths])
        self.tokens = SegmentTree([int(x.sum()) for x in self.counts])

    @classmethod
    def stored(cls, text: str, row: dict, encoder: Encoder) -> TokenTree:
        """The tree that ``kept`` gave; nothing is encoded."""
        tree = cls.__new__(cls)
        tree.text, tree.encoder, tree.encoded = text, encoder, 0
        cuts = np.cumsum(np.frombuffer(row["groups"], np.uint32))[:-1]
        tree.lengths, tree.counts = (np.split(np.frombuffer(row[c], np.uint32).astype(np.int64), cuts) for c in ("lengths", "counts"))
        tree.chars, tree.tokens = (SegmentTree.of(np.frombuffer(row[c], np.int64)) for c in ("char_sums", "token_sums"))
        return tree

    def kept(self) -> dict:
        """Leaves in their groups, and the nodes of both trees."""
        flat = lambda x: np.concatenate(x).astype(np.uint32).tobytes()
        return {"lengths": flat(self.lengths), "counts": flat(self.counts), "groups": np.array([len(x) for x in self.lengths], np.uint32).tobytes(), "char_sums": self.chars.node.tobytes(), "token_sums": self.tokens.node.tobytes()}

    def total(self) -> int:
        return self.tokens.total()

    def replace(self, begin: int, end: int, new: str) -> int:
        """Puts ``new`` in place of the characters begin to end; how many pre-tokens were
        encoded anew."""
        begin = min(max(0, begin), len(self.text))
        end = min(max(begin, end), len(self.text))
        old_size, shift = len(self.text), len(new) - (end - begin)
        self.text = self.text[:begin] + new + self.text[end:]
        # The groups that hold the changed place, with room for two pre-tokens before it.
        first, lead = self.chars.find(max(0, begin - 1)) if old_size else (0, 0)
        first = min(first, len(self.lengths) - 1)
        lead = int(sum(int(x.sum()) for x in self.lengths[:first])) if first == len(self.lengths) - 1 else lead
        bounds = lead + np.r_[0, np.cumsum(self.lengths[first])]
        skip = max(0, int(np.searchsorted(bounds, begin, "left")) - 3)
        if skip == 0 and first:
            first -= 1
            lead -= int(self.lengths[first].sum())
            bounds = lead + np.r_[0, np.cumsum(np.concatenate(self.lengths[first : first + 2]))]
            skip = max(0, int(np.searchsorted(bounds, begin, "left")) - 3)
        start = int(bounds[skip])
        # Old boundaries past the change, group by group, until a new one meets them.
        last, reach = first, lead
        old: dict[int, tuple[int, int]] = {}

        def more() -> bool:
            nonlocal last, reach
            if last >= len(self.lengths):
                return False
            at = reach
            for i, n in enumerate(self.lengths[last].tolist()):
                if at >= end:
                    old[at + shift] = (last, i)
                at += n
            reach, last = at, last + 1
            return True

        while reach <= end and more():
            pass
        pieces, at, meet = [], start, None
        matches = self.encoder.pattern.finditer(self.text, start)
        while meet is None and at < len(self.text):
            found = list(islice(matches, 16))
            for m in found:
                if at >= begin + len(new) and at > start:
                    while at - shift >= reach and more():
                        pass
                    if at in old:
                        meet = old[at]
                        break
                pieces.append(m.group())
                at = m.end()
            if not found:
                break
        if meet is None:
            meet = (len(self.lengths), 0)
        kept, counted = self._before(first, skip)
        tail_len, tail_count = (self.lengths[meet[0]][meet[1] :], self.counts[meet[0]][meet[1] :]) if meet[0] < len(self.lengths) else (np.zeros(0, np.int64), np.zeros(0, np.int64))
        lengths = np.concatenate([kept, np.fromiter(map(len, pieces), np.int64, len(pieces)), tail_len])
        counts = np.concatenate([counted, np.fromiter(self.encoder.counts(pieces), np.int64, len(pieces)), tail_count])
        self._put(first, min(meet[0] + 1, len(self.lengths)), lengths, counts)
        self.encoded += len(pieces)
        return len(pieces)

    def _before(self, first: int, skip: int) -> tuple[np.ndarray, np.ndarray]:
        lengths, counts = np.concatenate(self.lengths[first : first + 2]), np.concatenate(self.counts[first : first + 2])
        return lengths[:skip], counts[:skip]

    def _put(self, a: int, b: int, lengths: np.ndarray, counts: np.ndarray) -> None:
        groups = b - a
        if groups and len(lengths) <= groups * 2 * GROUP:
            # As many groups as before: only their paths change.
            cuts = [len(lengths) * i // groups for i in range(groups + 1)]
            for i in range(groups):
                self.lengths[a + i], self.counts[a + i] = lengths[cuts[i] : cuts[i + 1]], counts[cuts[i] : cuts[i + 1]]
                self.chars.set(a + i, int(self.lengths[a + i].sum()))
                self.tokens.set(a + i, int(self.counts[a + i].sum()))
            return
        self._group(np.concatenate([*self.lengths[:a], lengths, *self.lengths[b:]]), np.concatenate([*self.counts[:a], counts, *self.counts[b:]]))


TREES = "doc_id long, text string, lengths binary, counts binary, groups binary, char_sums binary, token_sums binary, n_tokens long, n_reencoded long"
_KEPT = ("lengths", "counts", "groups", "char_sums", "token_sums")


def _ranks(vocabulary: str) -> bytes:
    with open(vocabulary, "rb") as f:
        return f.read()


def _tree_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.string(), *[pa.binary()] * 5, pa.int64(), pa.int64()]
    names = [c.split()[0] for c in TREES.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)


def keep_trees(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """A row of the schema TREES for each document; n_reencoded is 0."""
    ranks = _ranks(vocabulary)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))

    def made(batches):
        encoder = Encoder(ranks)
        for s in C.slices_of(batches, 2 << 20):
            out = []
            for doc, text in zip(s.column(0).to_pylist(), s.column(1).to_pylist(), strict=True):
                tree = TokenTree(text, encoder)
                out.append((doc, text, *tree.kept().values(), tree.total(), 0))
            yield _tree_batch(out)

    return rows.mapInArrow(made, TREES)


def apply_edits(trees: DataFrame, edits: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """The trees after edits (doc_id, ord, begin, end, new), each document's in the order of
    ord: the characters begin to end of the text as it is then give way to new. n_reencoded
    tells how many pre-tokens were encoded for them."""
    ranks = _ranks(vocabulary)
    one = F.struct(F.col("ord").cast("long").alias("ord"), F.col("begin").cast("long").alias("begin"), F.col("end").cast("long").alias("end"), F.coalesce("new", F.lit("")).alias("new"))
    listed = edits.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.sort_array(F.collect_list(one)).alias("edits"))

    def changed(batches):
        encoder = Encoder(ranks)
        for s in C.slices_of(batches, 2 << 20):
            rows = s.to_pylist()
            out = []
            for r in rows:
                again, total = 0, r["n_tokens"]
                if r["edits"]:
                    tree = TokenTree.stored(r["text"], r, encoder)
                    again = sum(tree.replace(e["begin"], e["end"], e["new"]) for e in r["edits"])
                    r["text"], total = tree.text, tree.total()
                    r |= tree.kept()
                out.append((r["doc_id"], r["text"], *(r[c] for c in _KEPT), total, again))
            yield _tree_batch(out)

    return trees.join(listed, "doc_id", "left").select(*[c.split()[0] for c in TREES.split(", ")], "edits").mapInArrow(changed, TREES)


def edits_of(text: str, source: str) -> list[tuple[int, int, str]]:
    """The edits of the registered query: the first line goes, the source is named in the
    middle, and a full stop is put at the end."""
    line = text.find("\n") + 1
    middle = (len(text) - line) // 2
    return [(0, line, ""), (middle, middle, f" ({source})\n"), (len(text) - line + len(source) + 4, 2**60, ".")]


def count_tokens(docs: DataFrame, vocabulary: str = VOCABULARY, edits=edits_of) -> DataFrame:
    """doc_id, n_tokens, n_pretokens, then after the edits n_tokens_after and
    n_reencoded (pre-tokens encoded anew)."""
    ranks = _ranks(vocabulary)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"))

    def counted(batches):
        encoder = Encoder(ranks)
        for s in C.slices_of(batches, 4 << 20):
            made = []
            for body, source in zip(s.column(1), s.column(2), strict=True):
                tree = TokenTree(body.as_py(), encoder)
                row = [tree.total(), tree.encoded]
                again = sum(tree.replace(*e) for e in edits(tree.text, source.as_py()))
                made.append((*row, tree.total(), again))
            cols = list(zip(*made, strict=True))
            yield pa.RecordBatch.from_arrays([s.column(0), *(pa.array(c, pa.int64()) for c in cols)], names=["doc_id", "n_tokens", "n_pretokens", "n_tokens_after", "n_reencoded"])

    return rows.mapInArrow(counted, "doc_id long, n_tokens long, n_pretokens long, n_tokens_after long, n_reencoded long")


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(C.shipped(spark).read.parquet(f"{sf_dir}/documents.parquet"))
