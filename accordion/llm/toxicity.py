"""Operator 4, toxicity: a bidirectional gated recurrent network with attention pooling.

A token is a run of letters of the lower-cased text. Its input is a hashed word vector
and the mean of hashed vectors of its character trigrams (with both ends marked). A
forward and a backward gated recurrent unit read windows of 48 tokens that start every
40 tokens, so neighbours overlap; attention pools a window's states into one logit and a
text scores as its highest window. All windows of whole texts are scored.

Training (numpy, back-propagation through time, Adam) is on a bounded sample: at most
``PER_CLASS`` labelled texts of either class, chosen by a hash of the id among rows whose
crc32(doc_id) mod 5 is not 0; together at most ``SAMPLE_CHARS`` characters a class. Of a
longer clean text a piece of ``PIECE`` characters at a hashed place trains, as any piece
of it is clean; a toxic one trains whole up to ``LONGEST`` characters, as its label may
hold anywhere. Inputs are the text only. A text's label trains its highest window (and
one other of a clean text). One executor task trains; the arrays (about 1.3 MB whatever
the input) come back as rows and reach the scoring tasks as a broadcast variable.

Defined results: a null or empty text and one without a token score sigmoid(EMPTY).
Repeated rows score alike. Without labels of both classes all texts score sigmoid(EMPTY).
Rows may have any other columns, of any name; they are passed through untouched.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common as C

WINDOW, STRIDE, HIDDEN, DIM, ATTEND = 48, 40, 8, 8, 8
WORDS, GRAMS = 1 << 15, 1 << 13
PER_CLASS, EPOCHS, EMPTY = 1200, 9, -4.0
PIECE, LONGEST, SAMPLE_CHARS = 12_000, 200_000, 8_000_000
#: Windows that go through the network at a time.
CHUNK = 2048

_LETTER = np.zeros(256, bool)
_LETTER[ord("a") : ord("z") + 1] = True
_LETTER[0x80:] = True


def tokens_of(data: np.ndarray, offsets: np.ndarray):
    """Starts and ends of tokens, and the first token of each text."""
    return C.words_of(data, offsets, _LETTER)


class Inputs:
    """The distinct tokens of a slice and where they stand."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        starts, ends, self.first = tokens_of(data, offsets)
        hashes = C.span_hashes(data, starts, ends)
        distinct, at, self.token = np.unique(hashes, return_index=True, return_inverse=True)
        self.word = (distinct % C.U64(WORDS)).astype(np.int64)
        s, e = starts[at], ends[at]
        size = e - s + 2
        self.lead = np.r_[0, np.cumsum(size)][:-1] if len(size) else np.zeros(0, np.int64)
        # Each token's bytes between two marks (0), then hashes of three in a row.
        chars = np.zeros(int(size.sum()) + 2, np.int64)
        if len(size):
            inner = np.arange(int((e - s).sum())) - np.repeat(np.r_[0, np.cumsum(e - s)][:-1], e - s)
            chars[np.repeat(self.lead + 1, e - s) + inner] = data[np.repeat(s, e - s) + inner].astype(np.int64) + 1
        key = chars[:-2] * 66_049 + chars[1:-1] * 257 + chars[2:]
        self.gram = (C.mix(key.astype(C.U64)) % C.U64(GRAMS)).astype(np.int64)
        self.size = size - 2  # trigrams inside the token: as many as bytes
        keep = np.ones(len(self.gram), bool)
        for back in (1, 2):
            keep[(self.lead + size - back)] = False
        self.gram = self.gram[keep]
        self.lead = np.r_[0, np.cumsum(self.size)]
        self.windows()

    def windows(self):
        """Window starts (token numbers), lengths and texts, the longest windows first."""
        count = np.diff(self.first)
        n = np.where(count > 0, 1 + np.maximum(0, -(-(count - WINDOW) // STRIDE)), 0)
        self.owner = np.repeat(np.arange(len(count)), n)
        step = np.arange(n.sum()) - np.repeat(np.r_[0, np.cumsum(n)][:-1], n)
        start = self.first[:-1][self.owner] + step * STRIDE
        length = np.minimum(WINDOW, self.first[1:][self.owner] - start)
        order = np.argsort(-length, kind="stable")
        self.start, self.length, self.owner = start[order], length[order], self.owner[order]

    def grid(self, pick=slice(None)):
        """Token numbers [step, window] and how many windows are that long, by step."""
        start, length = self.start[pick], self.length[pick]
        at = np.minimum(start + np.arange(WINDOW)[:, None], max(0, len(self.token) - 1))
        return self.token[at], [int(np.searchsorted(-length, -t, "left")) for t in range(WINDOW)]


def vectors(m: dict, x: Inputs) -> np.ndarray:
    chars = np.add.reduceat(m["gram"][x.gram], x.lead[:-1], axis=0) / x.size[:, None].astype(np.float32) if len(x.size) else np.zeros((0, DIM), np.float32)
    return np.concatenate([m["word"][x.word], chars], 1)


def sigmoid(x):
    return 0.5 * np.tanh(0.5 * x) + 0.5


def _gru(inputs, grid, active, U, c, backward, keep):
    """States [step, window, HIDDEN]; with keep, what back-propagation needs."""
    T, B, H = len(active), grid.shape[1], HIDDEN
    states = np.zeros((T, B, H), np.float32)
    h, saved = np.zeros((B, H), np.float32), []
    for t in range(T - 1, -1, -1) if backward else range(T):
        n = active[t]
        if not n:
            continue
        x, old = inputs[grid[t, :n]], h[:n]
        rec = old @ U
        gates = sigmoid(x[:, : 2 * H] + rec[:, : 2 * H])
        z, r = gates[:, :H], gates[:, H:]
        inner = rec[:, 2 * H :] + c
        new = np.tanh(x[:, 2 * H :] + r * inner)
        if keep:
            saved.append((t, n, old.copy(), z, r, inner, new))
        h[:n] = new + z * (old - new)
        states[t, :n] = h[:n]
    return states, saved


def forward(m: dict, vec: np.ndarray, grid: np.ndarray, active: list[int], keep: bool = False):
    T, B = len(active), grid.shape[1]
    both = [_gru(vec @ m[f"W{d}"] + m[f"b{d}"], grid, active, m[f"U{d}"], m[f"c{d}"], d == 1, keep) for d in (0, 1)]
    states = np.concatenate([both[0][0], both[1][0]], 2)
    hidden = np.tanh(states @ m["A"] + m["a"])
    score = hidden @ m["v"]
    for t in range(T):
        score[t, active[t] :] = -1e9
    weight = np.exp(score - score.max(0))
    weight /= weight.sum(0)
    pooled = (states * weight[:, :, None]).sum(0)
    logit = pooled @ m["w"] + m["o"][0]
    return logit, (both, states, hidden, weight, pooled)


def scores(m: dict | None, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A score for each text."""
    best = np.full(len(offsets) - 1, -np.inf)
    if m is not None:
        x = Inputs(data, offsets)
        if len(x.start):
            vec = vectors(m, x)
            for a in range(0, len(x.start), CHUNK):
                grid, active = x.grid(slice(a, a + CHUNK))
                logit, _ = forward(m, vec, grid, active)
                np.maximum.at(best, x.owner[a : a + CHUNK], logit.astype(np.float64))
    best[np.isneginf(best)] = EMPTY
    return 1 / (1 + np.exp(-np.clip(best, -40, 40)))


def _gradients(m, x, vec, grid, active, kept, slope):
    """Gradients of the loss, of which slope is the derivative by the logits."""
    both, states, hidden, weight, pooled = kept
    g = {"w": pooled.T @ slope, "o": np.array([slope.sum()], np.float32)}
    d_pool = slope[:, None] * m["w"]
    d_states = weight[:, :, None] * d_pool
    d_weight = (states * d_pool).sum(2)
    d_score = weight * (d_weight - (weight * d_weight).sum(0))
    d_hidden = d_score[:, :, None] * m["v"] * (1 - hidden**2)
    flat = lambda a: a.reshape(-1, a.shape[-1])
    g["v"] = d_score.ravel() @ flat(hidden)
    g["A"] = flat(states).T @ flat(d_hidden)
    g["a"] = d_hidden.sum((0, 1))
    d_states = d_states + d_hidden @ m["A"].T
    d_vec = np.zeros_like(vec)
    H = HIDDEN
    for d in (0, 1):
        U, c = m[f"U{d}"], m[f"c{d}"]
        gU, gc = np.zeros_like(U), np.zeros_like(c)
        dh, by_step = np.zeros((grid.shape[1], H), np.float32), np.zeros((*grid.shape, 3 * H), np.float32)
        for t, n, old, z, r, inner, new in reversed(both[d][1]):
            down = dh[:n] + d_states[t, :n, d * H : (d + 1) * H]
            d_new = down * (1 - z) * (1 - new**2)
            d_z = down * (old - new) * z * (1 - z)
            d_r = d_new * inner * r * (1 - r)
            d_rec = np.concatenate([d_z, d_r, d_new * r], 1)
            gU += old.T @ d_rec
            gc += (d_new * r).sum(0)
            by_step[t, :n] = np.concatenate([d_z, d_r, d_new], 1)
            dh[:n] = down * z + d_rec @ U.T
        g[f"U{d}"], g[f"c{d}"] = gU, gc
        gx = _sum_rows(grid.ravel(), by_step.reshape(-1, 3 * H), len(vec))
        g[f"W{d}"], g[f"b{d}"] = vec.T @ gx, gx.sum(0)
        d_vec += gx @ m[f"W{d}"].T
    g["word"] = _sum_rows(x.word, d_vec[:, :DIM], WORDS)
    g["gram"] = _sum_rows(x.gram, np.repeat(d_vec[:, DIM:] / np.maximum(1, x.size)[:, None], x.size, axis=0), GRAMS)
    return g


def _sum_rows(at: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """Sums of the rows that go to each of n places."""
    out = np.zeros((n, rows.shape[1]), np.float32)
    order = np.argsort(at, kind="stable")
    place = at[order]
    begin = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
    out[place[begin]] = np.add.reduceat(rows[order], begin, axis=0)
    return out


def _start(rng) -> dict:
    shape = {"word": (WORDS, DIM), "gram": (GRAMS, DIM), "A": (2 * HIDDEN, ATTEND), "v": (ATTEND,), "w": (2 * HIDDEN,)}
    for d in (0, 1):
        shape |= {f"W{d}": (2 * DIM, 3 * HIDDEN), f"U{d}": (HIDDEN, 3 * HIDDEN)}
    m = {k: (rng.standard_normal(s) * (0.05 if k in ("word", "gram") else 1 / np.sqrt(s[0]))).astype(np.float32) for k, s in shape.items()}
    for d in (0, 1):
        m |= {f"b{d}": np.zeros(3 * HIDDEN, np.float32), f"c{d}": np.zeros(HIDDEN, np.float32)}
    return m | {"a": np.zeros(ATTEND, np.float32), "o": np.zeros(1, np.float32)}


def train(texts: list[str], labels: list[int], seed: int = 7) -> dict | None:
    """The network's arrays; None without texts of both classes."""
    y = np.array(labels, np.float32)
    if not len(y) or y.min() == y.max():
        return None
    rng = np.random.default_rng(seed)
    # A clean word said again and again is still clean: such texts teach the units not to
    # mistake a state that runs to its limit for a sign.
    clean = [t for t, mark in zip(texts, labels, strict=True) if not mark and t.split()]
    said = [rng.choice(clean[i % len(clean)].split()[:400]) for i in range(len(clean) // 4)] if clean else []
    texts = [*texts, *(f"{w} " * int(rng.integers(3, 90)) for w in said)]
    y = np.r_[y, np.zeros(len(said), np.float32)]
    raw = [t.lower().encode() for t in texts]
    x = Inputs(np.frombuffer(b"".join(raw), np.uint8), np.r_[0, np.cumsum([len(r) for r in raw])].astype(np.int64))
    m = _start(rng)
    # Word vectors start with the log odds of a word's bucket as their first place.
    text_of = np.repeat(np.arange(len(y)), np.diff(x.first))
    seen = np.unique(text_of * WORDS + x.word[x.token])
    toxic = np.bincount(seen % WORDS, weights=y[seen // WORDS], minlength=WORDS)
    clean = np.bincount(seen % WORDS, minlength=WORDS) - toxic
    odds = np.log((toxic + 1) / (y.sum() + 2)) - np.log((clean + 1) / (len(y) - y.sum() + 2))
    m["word"][:, 0] = np.clip(odds, -3, 5) / 3
    token_odds = odds[x.word]
    grid, active = x.grid()
    level = np.where(np.arange(WINDOW)[:, None] < x.length, token_odds[grid], -9).max(0) if len(x.start) else np.zeros(0)
    moments = {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in m.items()}
    step, batch = 0, 128 if len(y) >= 1000 else 32
    # A small sample gets more epochs, so that there are about as many steps.
    epochs = EPOCHS * min(4, max(1, 3000 // max(1, len(y))))
    for epoch in range(epochs):
        if epoch in (epochs * 2 // 9, epochs * 4 // 9, epochs * 7 // 9):
            vec = vectors(m, x)
            level = np.concatenate([forward(m, vec, *x.grid(slice(a, a + CHUNK)))[0] for a in range(0, len(x.start), CHUNK)])
        order = np.lexsort((level, x.owner))
        last = order[np.r_[x.owner[order][1:] != x.owner[order][:-1], True]]
        extra = rng.permutation(len(x.start))[: len(last)]
        extra = extra[y[x.owner[extra]] == 0]
        chosen = rng.permutation(np.unique(np.r_[last, extra]))
        for a in range(0, len(chosen), batch):
            pick = np.sort(chosen[a : a + batch])  # the longest first, as grid() needs
            grid, active = x.grid(pick)
            # Only the tokens of this batch.
            used, local = np.unique(grid, return_inverse=True)
            part = _Part(x, used)
            vec = vectors(m, part)
            logit, kept = forward(m, vec, local.reshape(grid.shape), active, True)
            slope = ((sigmoid(logit) - y[x.owner[pick]]) / len(pick)).astype(np.float32)
            step += 1
            for k, g in _gradients(m, part, vec, local.reshape(grid.shape), active, kept, slope).items():
                first, second = moments[k]
                first += 0.1 * (g - first)
                second += 0.01 * (g * g - second)
                rate = 0.01 * np.sqrt(1 - 0.99**step) / (1 - 0.9**step)
                m[k] -= (rate * first / (np.sqrt(second) + 1e-6)).astype(np.float32)
    return m


class _Part:
    """Some of the distinct tokens."""

    def __init__(self, x: Inputs, used: np.ndarray):
        self.word, self.size = x.word[used], x.size[used]
        inner = np.arange(int(self.size.sum())) - np.repeat(np.r_[0, np.cumsum(self.size)][:-1], self.size)
        self.gram = x.gram[np.repeat(x.lead[used], self.size) + inner]
        self.lead = np.r_[0, np.cumsum(self.size)]


def held_out(column) -> F.Column:
    return F.crc32(column.cast("long").cast("string")) % 5 == 0


def sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The bounded sample: mark, ord, text."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id"))).select(F.col("doc_id").cast("long").alias("_id"), F.col("toxic").cast("int").alias("mark"))
    text = F.col("text").cast("string")
    spot = F.lit(1) + F.pmod(F.xxhash64("_id"), F.greatest(F.lit(1), F.length("text") - PIECE + 1)).cast("int")
    rows = docs.select(F.col("doc_id").cast("long").alias("_id"), F.coalesce(text, F.lit("")).alias("text"))
    parts = []
    for mark in (1, 0):
        # Twice as many ids as wanted, for some have no row or too long a text; both bounds are fixed.
        ids = known.where(F.col("mark") == mark).distinct().orderBy(F.xxhash64("_id"), "_id").limit(2 * PER_CLASS)
        found = rows.join(F.broadcast(ids), "_id")
        found = found.where(F.length("text") <= LONGEST) if mark else found.withColumn("text", F.substring("text", spot, F.lit(PIECE)))
        found = found.withColumn("ord", F.xxhash64("_id")).orderBy("ord", "_id", "text").limit(PER_CLASS)
        so_far = Window.partitionBy("mark").orderBy("ord", "_id", "text").rowsBetween(Window.unboundedPreceding, 0)  # at most PER_CLASS rows
        parts.append(found.withColumn("chars", F.sum(F.length("text")).over(so_far)).where(F.col("chars") <= SAMPLE_CHARS).select("mark", "ord", "text"))
    return parts[0].unionByName(parts[1])


def fit(docs: DataFrame, labels: DataFrame) -> dict | None:
    """Trains on the bounded sample, in one task of an executor."""

    def trained(table: pa.Table) -> pa.Table:
        rows = sorted(zip(table.column("mark").to_pylist(), table.column("ord").to_pylist(), table.column("text").to_pylist(), strict=True), key=lambda r: (-r[0], r[1], r[2]))
        model = train([r[2] for r in rows], [r[0] for r in rows]) or {}
        C.hand_back()
        return pa.table({"name": pa.array(list(model), pa.string()), "shape": pa.array([list(a.shape) for a in model.values()], pa.list_(pa.int32())), "data": pa.array([a.tobytes() for a in model.values()], pa.binary())})

    rows = sample(docs, labels).groupBy(F.lit(0).alias("one")).applyInArrow(trained, "name string, shape array<int>, data binary").collect()
    return {r["name"]: np.frombuffer(r["data"], np.float32).reshape(r["shape"]).copy() for r in rows} or None


def score_documents(docs: DataFrame, model: dict | None, name: str = "score", keep: bool = False) -> DataFrame:
    """The rows of docs with a score (a column ``name`` that docs must not have); without
    the text unless ``keep``. Columns stand in the order of docs."""
    text_at = docs.columns.index("text")
    kept = [i for i, n in enumerate(docs.columns) if keep or n != "text"]
    # Plain names inside, for columns may be called anything.
    rows = docs.toDF(*[f"_c{i}" for i in range(len(docs.columns))])
    rows = rows.withColumn(f"_c{text_at}", F.col(f"_c{text_at}").cast("string"))
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def scored(batches):
        own = sent.value
        for s in C.slices_of(batches, 2 << 20, f"_c{text_at}"):
            text = pc.utf8_lower(s.column(text_at).cast(pa.large_string()))
            data, offsets = C.texts_of(pa.RecordBatch.from_arrays([text], names=["text"]))
            yield pa.RecordBatch.from_arrays([*(s.column(i) for i in kept), pa.array(scores(own, data, offsets))], names=[*(f"_c{i}" for i in kept), "_s"])
        C.hand_back()

    out = rows.mapInArrow(scored, T.StructType([*(rows.schema[i] for i in kept), T.StructField("_s", T.DoubleType())]))
    return out.toDF(*[docs.columns[i] for i in kept], name)


def clean_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of docs that are not predicted toxic, with the columns of docs."""
    name = "_score"
    while name in docs.columns:
        name += "_"
    scored = score_documents(docs, fit(docs, labels), name, keep=True)
    return scored.where(F.col(name) < 0.5).drop(name)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    C.shipped(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score_documents(docs, model).select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
