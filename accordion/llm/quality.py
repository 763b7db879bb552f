"""Operator 1, quality rules: weak supervision instead of all-must-pass filtering.

Each rule votes +1 (fit), -1 (unfit) or abstains (0). Expectation-maximisation over the
counts of vote patterns estimates the share of fit texts and each rule's accuracy; a text
is kept where the posterior probability of being fit is at least one half and the base
conditions hold. Everything is DataFrame functions: the patterns are at most 3^rules
rows, so the fold that runs the rounds handles a table of proven size, and the pattern
table may be broadcast.

Defined results: null text has no words, lines or symbols; such texts fail the base
conditions. A posterior of exactly one half keeps the text. A null doc_id stays null.
Repeated rows are judged alike. Columns other than doc_id and text are not
looked at. Windows of a text are compared by 64-bit hashes within the text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C

WINDOW = 8
#: Name, condition of a vote against, condition of a vote for (over the features below).
RULES = [
    ("symbols", "n_symbols > 0.3 * n_words", "false"),
    ("dup_lines", "n_dup_lines > 0.3 * n_lines", "false"),
    ("repeats", "n_repeat_words > 0.15 * n_words", "false"),
    ("upper_case", "n_upper > 0.5 * word_chars", "false"),
    ("word_length", "word_chars < 2 * n_words or word_chars > 14 * n_words", "false"),
    ("variety", "n_words >= 50 and n_distinct < 0.2 * n_words", "false"),
    ("exclaims", "n_exclaims > 0.3 * n_words", "false"),
    ("plain", "n_symbols + n_exclaims > 0.2 * n_words or n_upper > 0.4 * word_chars", "n_symbols + n_exclaims <= 0.05 * n_words and n_upper <= 0.2 * word_chars"),
]
BASE_FAILED = "(n_words < 20 or 100 * n_repeat_words > 30 * n_words)"
ROUNDS, START, LOW, HIGH = 25, 0.8, 0.55, 0.99


def features(docs: DataFrame) -> DataFrame:
    """doc_id and the numbers the rules look at."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("t"))
    gone = lambda chars: (F.length("t") - F.length(F.translate("t", chars, ""))).cast("long")
    rows = rows.withColumn("w", F.array_remove(F.split("t", r"[\x20\x09-\x0D]+"), ""))
    rows = rows.withColumn("lines", F.filter(F.split("t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    rows = rows.select(
        "doc_id",
        F.size("w").cast("long").alias("n_words"),
        F.length(F.translate("t", " \t\n\u000b\f\r", "")).cast("long").alias("word_chars"),
        gone("#*$%&|<>").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size("lines").cast("long").alias("n_lines"),
        gone("ABCDEFGHIJKLMNOPQRSTUVWXYZ").alias("n_upper"),
        gone("!").alias("n_exclaims"),
        F.transform("w", lambda x: F.xxhash64(x)).alias("h"),
    )
    starts = F.sequence(F.lit(1), F.size("h") - (WINDOW - 1))
    rows = rows.withColumn("wins", F.when(F.size("h") > WINDOW, F.transform(starts, lambda i: F.xxhash64(F.slice("h", i, WINDOW)))).otherwise(F.array().cast("array<bigint>")))
    rows = rows.withColumn("n_distinct", F.size(F.array_distinct("h")).cast("long")).drop("h")
    # Only texts with a repeated window go further: windows with their places are sorted,
    # those equal to a neighbour are repeats, and the union of their words is counted.
    again = F.size(F.array_distinct("wins")) < F.size("wins")
    rows = rows.withColumn("ordered", F.when(again, F.sort_array(F.transform("wins", lambda x, i: F.struct(x.alias("x"), i.alias("i"))))))
    near = lambda j: F.get(F.col("ordered"), j)["x"]
    rows = rows.withColumn("hits", F.when(F.col("ordered").isNotNull(), F.sort_array(F.transform(F.filter("ordered", lambda x, j: (x["x"] == F.coalesce(near(j - 1), F.bitwise_not(x["x"]))) | (x["x"] == F.coalesce(near(j + 1), F.bitwise_not(x["x"])))), lambda x: x["i"]))))
    gaps = F.transform("hits", lambda p, j: F.least(F.lit(WINDOW), F.coalesce(F.get(F.col("hits"), j + 1) - p, F.lit(WINDOW))).cast("long"))
    return rows.withColumn("n_repeat_words", F.coalesce(F.aggregate(gaps, F.lit(0).cast("long"), lambda a, x: a + x), F.lit(0).cast("long"))).drop("wins", "ordered", "hits")


def vote(against: str, favour: str):
    """-1, 1 or 0. A text without words gives no vote for."""
    return F.expr(f"case when n_words > 0 and ({against}) then -1 when n_words > 0 and ({favour}) then 1 else 0 end")


def posteriors(patterns: DataFrame, n_rules: int) -> DataFrame:
    """votes, posterior, and the estimated share and accuracies, of patterns (votes, n)."""
    one = patterns.agg(F.sort_array(F.collect_list(F.struct("votes", F.col("n").cast("double").alias("n")))).alias("rows"))
    clamp = lambda x, low=LOW: F.greatest(F.lit(low), F.least(F.lit(HIGH), x))

    def posterior(p, votes):
        odds = F.log(p["share"] / (1 - p["share"]))
        for r in range(n_rules):
            a = F.get(p["accuracy"], F.lit(r))
            odds = odds + F.get(votes, F.lit(r)) * F.log(a / (1 - a))
        return 1 / (1 + F.exp(-odds))

    def step(p, _):
        scored = F.transform("rows", lambda x: F.struct(x["votes"].alias("votes"), x["n"].alias("n"), posterior(p, x["votes"]).alias("y")))
        # One fold gives all sums: rows, fit rows, and for each rule its votes and right votes.
        zero = F.struct(F.lit(0.0).alias("n"), F.lit(0.0).alias("y"), F.array(*[F.lit(0.0)] * n_rules).alias("v"), F.array(*[F.lit(0.0)] * n_rules).alias("r"))

        def add(a, x):
            votes = [F.get(x["votes"], F.lit(r)) for r in range(n_rules)]
            voted = [F.get(a["v"], F.lit(r)) + x["n"] * F.abs(v) for r, v in enumerate(votes)]
            right = [F.get(a["r"], F.lit(r)) + x["n"] * F.when(v == 1, x["y"]).when(v == -1, 1 - x["y"]).otherwise(0.0) for r, v in enumerate(votes)]
            return F.struct((a["n"] + x["n"]).alias("n"), (a["y"] + x["n"] * x["y"]).alias("y"), F.array(*voted).alias("v"), F.array(*right).alias("r"))

        def finish(a):
            accuracy = [F.when(F.get(a["v"], F.lit(r)) > 0, clamp(F.get(a["r"], F.lit(r)) / F.get(a["v"], F.lit(r)))).otherwise(F.lit(START)) for r in range(n_rules)]
            return F.struct(F.when(a["n"] > 0, clamp(a["y"] / a["n"], 1 - HIGH)).otherwise(F.lit(START)).alias("share"), F.array(*accuracy).alias("accuracy"))

        return F.aggregate(scored, zero, add, finish)

    start = F.struct(F.lit(START).alias("share"), F.array(*[F.lit(START)] * n_rules).alias("accuracy"))
    fitted = one.withColumn("p", F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, step))
    return fitted.select("p", F.explode("rows").alias("x")).select(F.col("x.votes").alias("votes"), posterior(F.col("p"), F.col("x.votes")).alias("posterior"), F.col("p.share").alias("share"), F.col("p.accuracy").alias("accuracy"))


def judge(docs: DataFrame, rules=RULES) -> DataFrame:
    """doc_id, features, base_failed, posterior, kept."""
    found = C.written(features(docs).withColumn("votes", F.array(*[vote(a, b) for _, a, b in rules])), "features")
    table = posteriors(found.groupBy("votes").agg(F.count(F.lit(1)).alias("n")), len(rules)).select("votes", "posterior")
    joined = found.join(F.broadcast(table), "votes")  # at most 3 ** len(rules) rows
    return joined.withColumn("base_failed", F.expr(BASE_FAILED)).withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= 0.5))


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(spark.read.parquet(f"{sf_dir}/documents.parquet")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", F.round("posterior", 6).alias("posterior")
    )


def oracle() -> str:
    """The same rows as DuckDB SQL: the rounds are a recursive query over the patterns."""
    n = range(len(RULES))
    case = ", ".join(f"case when n_words > 0 and ({a}) then -1 when n_words > 0 and ({b}) then 1 else 0 end as v{r}" for r, (_, a, b) in enumerate(RULES))
    odds = "ln(share / (1 - share))" + "".join(f" + v{r} * ln(a{r} / (1 - a{r}))" for r in n)
    clamp = lambda x, low=LOW: f"greatest({low}, least({HIGH}, {x}))"
    sums = ", ".join(
        f"case when sum(n * abs(v{r})) > 0 then {clamp(f'sum(n * case when v{r} = 1 then y when v{r} = -1 then 1 - y else 0 end) / sum(n * abs(v{r}))')} else cast({START} as double) end as a{r}" for r in n
    )
    names = ", ".join(f"a{r}" for r in n)
    votes = ", ".join(f"v{r}" for r in n)
    space = "[\\x20\\x09-\\x0D]"
    return f"""
with recursive t as (select doc_id, coalesce(text, '') as t from documents),
s as (select doc_id, t, list_filter(regexp_split_to_array(t, '{space}+'), lambda x: x <> '') as w,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) as l from t),
g as (select doc_id, unnest(list_transform(range(1, len(w) - {WINDOW - 2}), lambda i: {{'i': i, 'x': array_to_string(w[i:i + {WINDOW - 1}], ' ')}})) as g
    from s where len(w) >= {WINDOW}),
h as (select doc_id, g.i as i, count(*) over (partition by doc_id, g.x) as c from g),
r as (select doc_id, i, lead(i) over (partition by doc_id order by i) as j from h where c > 1),
rep as (select doc_id, sum(least({WINDOW}, coalesce(j - i, {WINDOW}))) as n from r group by doc_id),
f as (select s.doc_id, cast(len(w) as bigint) as n_words, cast(length(array_to_string(w, '')) as bigint) as word_chars,
    cast(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
    cast(len(l) - len(list_distinct(l)) as bigint) as n_dup_lines, cast(len(l) as bigint) as n_lines,
    cast(length(regexp_replace(t, '[^A-Z]', '', 'g')) as bigint) as n_upper, cast(length(regexp_replace(t, '[^!]', '', 'g')) as bigint) as n_exclaims,
    cast(len(list_distinct(w)) as bigint) as n_distinct, cast(coalesce(rep.n, 0) as bigint) as n_repeat_words
    from s left join rep on s.doc_id = rep.doc_id),
v as (select *, {case} from f),
pats as (select {votes}, cast(count(*) as double) as n from v group by all),
em as (select 0 as k, cast({START} as double) as share, {", ".join(f"cast({START} as double) as a{r}" for r in n)}
    union all
    select k + 1, {clamp("sum(n * y) / sum(n)", round(1 - HIGH, 10))}, {sums}
    from (select *, 1 / (1 + exp(-({odds}))) as y from em, pats where k < {ROUNDS}) group by k),
last as (select share, {names} from em where k = {ROUNDS})
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, {BASE_FAILED} as base_failed,
    not {BASE_FAILED} and 1 / (1 + exp(-({odds}))) >= 0.5 as kept, round(1 / (1 + exp(-({odds}))), 6) as posterior
from v, last"""
