"""Operator 2, mixing sources to target weights by temperature.

A source's token share is raised to an exponent in [0, 1] and normalised. The exponent is
bisected: the smallest at which the mix has at most the target entropy and no source is
repeated more than the limit. The token budget defaults to the one at which the source
repeated least appears once, so no text is left out. Weights become whole texts: a
source's texts are dealt into blocks by a hash, each pass over a source is a permutation
of its blocks (order of a hash with the pass), whole passes come first, and the last one
takes blocks until the budget, then texts of one block.

The totals by source reach the driver up to ``LISTED`` sources; for more, each step of the
bisection is an aggregate on the cluster. Blocks hold about ``block_tokens`` tokens, so a
hot source only has more blocks, and the running sum over its blocks goes by ``RANGES``
ranges of their order first, then inside a range, so no task sorts all blocks of a source.
Defined results: a null source is the source ''; null text has no tokens and is kept once
a pass; rows that share a doc_id and a source share a block and are taken together; an
empty table gives an empty one; other columns pass untouched.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import written

LISTED, STEPS, RANGES = 100_000, 60, 4096
#: Parameters of the registered query.
ENTROPY, REPEATS, BLOCK_TOKENS = 0.97, 1.5, 20_000
#: Block tables up to this size are broadcast; larger ones are joined by shuffle.
BROADCAST_ROWS = 200_000


def n_words(text):
    return F.size(F.array_remove(F.split(F.coalesce(text.cast("string"), F.lit("")), r"[\x20\x09-\x0D]+"), "")).cast("long")


def hashed(*parts):
    """A number below 2^32 that SQL engines agree on: the first 8 hex digits of an md5."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 8), 16, 10).cast("long")


def mix_weights(totals: dict[str, int], entropy: float, repeats: float, budget: float | None = None) -> tuple[float, dict[str, float], float]:
    """The exponent, weights by source, and the budget in tokens. ``entropy`` is a share of
    the most that so many sources can have."""
    known = {s: t for s, t in totals.items() if t > 0}
    if not known:
        return 1.0, {}, 0.0
    total, top = sum(known.values()), max(known.values())
    shares = {s: t / total for s, t in known.items()}

    def sums(a: float):
        raw = [p**a for p in shares.values()]
        return math.fsum(raw), math.fsum(r * math.log(r) for r in raw if r), max(r / t for r, t in zip(raw, known.values(), strict=True))

    a, z, b = bisect(sums, len(known), total, top, entropy, repeats, budget)
    return a, {s: p**a / z for s, p in shares.items()}, b


def bisect(sums, n: int, total: int, top: int, entropy: float, repeats: float, budget: float | None) -> tuple[float, float, float]:
    """The exponent, the sum of the powers, and the budget. ``sums(a)`` gives over all sources
    the sum of r, the sum of r ln r, and the most of r / tokens, r being a share to the
    power a."""

    def at(a: float):
        z, weighed, most = sums(a)
        b = z * total * (top / total) ** (1 - a) if budget is None else budget
        # Weights are r / z, so their entropy is ln z - (sum of r ln r) / z.
        return z, b, math.log(z) - weighed / z <= entropy * math.log(n) and most / z * b <= repeats

    low, high = 0.0, 1.0
    for _ in range(STEPS):
        mid = (low + high) / 2
        if at(mid)[2]:
            high = mid
        else:
            low = mid
    z, b, _ = at(high)
    return high, z, b


def goals_of(rows: DataFrame, entropy: float, repeats: float, block_tokens: int, budget: float | None) -> DataFrame:
    """src, weight, n_blocks, passes and left of each source."""
    totals = written(rows.groupBy("src").agg(F.sum("n_tokens").alias("t")), "totals")
    known = totals.where("t > 0")
    facts = known.agg(F.count(F.lit(1)).alias("n"), F.sum("t").alias("total"), F.max("t").alias("top")).first()
    a, z, b = 1.0, 1.0, 0.0
    if facts["n"] and facts["n"] <= LISTED:
        listed = {r["src"]: r["t"] for r in known.collect()}
        a, _, b = mix_weights(listed, entropy, repeats, budget)
        z = math.fsum((t / facts["total"]) ** a for t in listed.values())
    elif facts["n"]:

        def sums(x: float):
            r = F.pow(F.col("t") / F.lit(facts["total"]), F.lit(x))
            return tuple(known.agg(F.sum(r), F.sum(F.when(r > 0, r * F.log(r))), F.max(r / F.col("t"))).first())

        a, z, b = bisect(sums, facts["n"], facts["total"], facts["top"], entropy, repeats, budget)
    weight = F.when(F.col("t") > 0, F.pow(F.col("t") / F.lit(facts["total"]), F.lit(a)) / F.lit(z)).otherwise(0.0)
    goal = F.floor(F.col("weight") * F.lit(float(b)) + 1e-6)
    least = F.lit(1 if budget is None else 0).cast("long")
    out = totals.withColumn("weight", weight).withColumn("goal", goal)
    out = out.withColumn("passes", F.when(F.col("t") > 0, F.greatest(F.floor(F.col("goal") / F.col("t")), least)).otherwise(F.lit(1).cast("long")))
    return out.select("src", "weight", F.greatest(F.lit(1).cast("long"), F.ceil(F.col("t") / block_tokens)).alias("n_blocks"), "passes", F.greatest(F.lit(0).cast("long"), F.col("goal") - F.col("passes") * F.col("t")).alias("left"))


def plan(rows: DataFrame, entropy: float, repeats: float, block_tokens: int, budget: float | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """From rows (doc_id, src, n_tokens): the goals of the sources, the rows with their
    blocks, and the blocks of the last pass (taken whole, or the one that is cut)."""
    goals = written(goals_of(rows, entropy, repeats, block_tokens, budget), "goals")
    dealt = rows.join(_small(goals), "src").withColumn("block", F.pmod(hashed(F.col("doc_id").cast("string"), F.lit("block")), F.col("n_blocks")))
    blocks = dealt.groupBy("src", "block").agg(F.sum("n_tokens").alias("t"), F.first("left").alias("left"), F.first("passes").alias("passes"))
    blocks = blocks.withColumn("turn", hashed("src", F.col("block").cast("string"), F.col("passes").cast("string")))
    blocks = written(blocks.withColumn("range", F.floor(F.col("turn") * RANGES / F.lit(2**32)).cast("int")), "blocks")
    # Running sums: before a range, then inside it.
    ranges = blocks.groupBy("src", "range").agg(F.sum("t").alias("t"))
    so_far = F.sum("t").over(Window.partitionBy("src").orderBy("range").rowsBetween(Window.unboundedPreceding, -1))  # at most RANGES rows a source
    ranges = ranges.select("src", "range", F.coalesce(so_far, F.lit(0)).alias("before"))
    order = Window.partitionBy("src", "range").orderBy("turn", "block")
    blocks = blocks.withColumn("inside", F.sum("t").over(order.rowsBetween(Window.unboundedPreceding, 0))).join(ranges, ["src", "range"])
    blocks = blocks.withColumn("until", F.col("before") + F.col("inside"))
    blocks = blocks.select("src", "block", (F.col("until") <= F.col("left")).alias("whole"), ((F.col("until") > F.col("left")) & (F.col("until") - F.col("t") < F.col("left"))).alias("cut"), (F.col("left") - F.col("until") + F.col("t")).alias("rest"))
    return goals, dealt, written(blocks.where("whole or cut"), "taken")


def _small(df: DataFrame) -> DataFrame:
    """Broadcast if proven small."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def copies_of(rows: DataFrame, entropy: float = ENTROPY, repeats: float = REPEATS, block_tokens: int = BLOCK_TOKENS, budget: float | None = None, onto: DataFrame | None = None) -> DataFrame:
    """Rows (doc_id, src, n_tokens), or ``onto`` (doc_id, src and any others), with weight,
    block and copies: how often the mix has the text."""
    goals, dealt, blocks = plan(rows, entropy, repeats, block_tokens, budget)
    inside = Window.partitionBy("src", "block").orderBy(hashed(F.col("doc_id").cast("string"), F.col("passes").cast("string")), "doc_id")
    cut = dealt.join(_small(blocks.where("cut").select("src", "block", "rest")), ["src", "block"])
    # Rows of one doc_id are taken together, so a block's running sum has a row for each.
    cut = cut.groupBy("src", "block", "doc_id").agg(F.sum("n_tokens").alias("n"), F.first("passes").alias("passes"), F.first("rest").alias("rest"))
    taken = cut.withColumn("until", F.sum("n").over(inside.rowsBetween(Window.unboundedPreceding, 0))).where("until <= rest")
    taken = written(taken.select(F.col("src").alias("_s"), F.col("block").alias("_b"), F.col("doc_id").alias("_d"), F.lit(1).alias("_part")), "parts")
    out = (rows if onto is None else onto).join(_small(goals), "src").withColumn("block", F.pmod(hashed(F.col("doc_id").cast("string"), F.lit("block")), F.col("n_blocks")))
    out = out.join(_small(blocks.where("whole").select("src", "block", F.lit(1).alias("_whole"))), ["src", "block"], "left")
    out = out.join(_small(taken), (F.col("src") == F.col("_s")) & (F.col("block") == F.col("_b")) & F.col("doc_id").eqNullSafe(F.col("_d")), "left")
    return out.withColumn("copies", F.col("passes") + F.coalesce("_whole", F.lit(0)) + F.coalesce("_part", F.lit(0))).drop("_whole", "_part", "_d", "_s", "_b", "n_blocks", "passes", "left")


def token_rows(docs: DataFrame, *more: str) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("src"), n_words(F.col("text")).alias("n_tokens"), *more)


def mixed(docs: DataFrame, entropy: float = ENTROPY, repeats: float = REPEATS, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """The rows of docs, each as often as the mix has it."""
    inner = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    inner = inner.select("_row", F.col("_row.doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("_row.source").cast("string"), F.lit("")).alias("src"))
    counts = copies_of(written(token_rows(docs), "tokens"), entropy, repeats, block_tokens, onto=inner)
    return counts.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).select("_row.*")


def op2_mixing_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = written(token_rows(spark.read.parquet(f"{sf_dir}/documents.parquet")), "tokens")
    return copies_of(rows).select("doc_id", F.col("src").alias("source"), "n_tokens", F.round("weight", 6).alias("weight"), "block", "copies")


def oracle(entropy: float = ENTROPY, repeats: float = REPEATS, block_tokens: int = BLOCK_TOKENS) -> str:
    """The same rows as DuckDB SQL; the bisection is a recursive query."""
    h = lambda x: f"cast('0x' || substr(md5({x}), 1, 8) as bigint)"
    fits = f"""-sum(w * ln(w)) <= {entropy} * ln(count(*)) and max(w * b / t) <= {repeats}"""
    weigh = "pow(p, {a}) / sum(pow(p, {a})) over (partition by {k}) as w, sum(pow(p, {a})) over (partition by {k}) * total * pow(top, 1 - {a}) as b"
    return f"""
with recursive d as (select doc_id, coalesce(source, '') as src,
    cast(len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')) as bigint) as n_tokens from documents),
t as (select src, sum(n_tokens) as t from d group by src),
p as (select src, t, t / sum(t) over () as p, sum(t) over () as total, max(t) over () / sum(t) over () as top from t where t > 0),
bis as (select 0 as k, cast(0 as double) as lo, cast(1 as double) as hi
    union all
    select k + 1, case when ok then lo else (lo + hi) / 2 end, case when ok then (lo + hi) / 2 else hi end
    from (select k, lo, hi, {fits} as ok from (select *, {weigh.format(a="((lo + hi) / 2)", k="k")} from bis, p where k < {STEPS}) group by k, lo, hi)),
a as (select hi as a from bis where k = {STEPS}),
w as (select src, {weigh.format(a="a", k="1")} from p, a),
g as (select t.src, t, coalesce(w, 0) as weight, greatest(1, cast(ceil(t / {block_tokens}) as bigint)) as n_blocks, cast(floor(coalesce(w * b, 0) + 1e-6) as bigint) as goal
    from t left join w on t.src = w.src),
q as (select *, case when t > 0 then greatest(cast(floor(goal / t) as bigint), 1) else 1 end as passes from g),
r as (select *, greatest(0, goal - passes * t) as lft from q),
e as (select d.*, weight, passes, lft, {h("cast(doc_id as varchar) || ':block'")} % n_blocks as block from d join r on d.src = r.src),
b as (select src, block, sum(n_tokens) as t, any_value(lft) as lft, any_value(passes) as passes from e group by src, block),
c as (select *, sum(t) over (partition by src order by {h("src || ':' || cast(block as varchar) || ':' || cast(passes as varchar)")}, block rows unbounded preceding) as until from b),
x as (select e.*, c.until, c.t, c.until <= e.lft as whole, c.until > e.lft and c.until - c.t < e.lft as cut from e join c on e.src = c.src and e.block = c.block),
z as (select src, block, doc_id, any_value(passes) as passes, sum(n_tokens) as n from x where cut group by src, block, doc_id),
u as (select src, block, doc_id, sum(n) over (partition by src, block order by {h("cast(doc_id as varchar) || ':' || cast(passes as varchar)")}, doc_id rows unbounded preceding) as upto from z),
y as (select x.*, upto from x left join u on x.src = u.src and x.block = u.block and x.doc_id is not distinct from u.doc_id)
select doc_id, src as source, n_tokens, round(weight, 6) as weight, cast(block as bigint) as block,
    cast(passes + case when whole then 1 when cut and upto <= lft - until + t then 1 else 0 end as bigint) as copies from y"""
