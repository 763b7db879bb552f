"""Which of the values that sources assert for a field is right, and how sure that is."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from accordion.functions.numbers import exact_round
from accordion.plans.policy import Policy

KEYS = ["provider_id", "field"]


def weighted(assertions: DataFrame, policy: Policy) -> DataFrame:
    """Assertions with a value, with weight, freshness and strength (their product)."""
    out = assertions.where(F.col("value").isNotNull())
    out = out.withColumn("weight", policy.weight_of(F.col("field"), F.col("source_class"))).withColumn("freshness", policy.freshness_of(F.col("data_as_of")))
    return out.withColumn("strength", F.col("weight") * F.col("freshness"))


def assess(assertions: DataFrame, current: DataFrame, policy: Policy) -> DataFrame:
    """One row per record and field that some source asserts.

    assertions: provider_id, field, value, raw_value, source_label, source_class,
    data_as_of, _src_ord. current: provider_id, field, cur, raw_cur, _field_ord.

    All windows and aggregates keep (provider_id, field) in front, so one exchange on
    these keys serves them all; a record's few values are then compared inside its row.
    """
    rows = weighted(assertions, policy).repartition(*KEYS)
    discount = lambda *keys: F.when(F.row_number().over(Window.partitionBy(*KEYS, *keys).orderBy(F.desc("strength"), "_src_ord")) == 1, 1.0).otherwise(1 - policy.rho)
    rows = rows.withColumn("in_all", F.col("strength") * discount("source_class")).withColumn("in_value", F.col("strength") * discount("value", "source_class"))
    clamped = F.greatest(F.least(F.col("in_value"), F.lit(0.999)), F.lit(0.0))
    values = rows.groupBy(*KEYS, "value").agg(
        F.sum("in_value").alias("eff"),
        F.sum("in_all").alias("part"),
        (1 - F.product(1 - clamped)).alias("noisy_or"),
        F.sort_array(F.collect_set("source_class")).alias("classes"),
        F.min("_src_ord").alias("ord"),
        F.min_by("raw_value", "_src_ord").alias("raw"),
        F.sort_array(F.collect_list(F.struct((-F.col("strength")).alias("s"), F.col("_src_ord").alias("o"), F.col("source_label").alias("label")))).alias("labels"),
    )
    entry = F.struct((-F.col("eff")).alias("neg"), "ord", "value", "eff", "part", "noisy_or", "classes", "raw", "labels")
    fields = values.groupBy(*KEYS).agg(F.sort_array(F.collect_list(entry)).alias("v"))
    fields = fields.withColumn("denom", F.aggregate("v", F.lit(0.0), lambda a, x: a + x["part"])).where("denom > 0")
    best, others = F.col("v")[0], F.slice("v", 2, F.greatest(F.size("v") - 1, F.lit(0)))
    out = fields.join(current, KEYS, "left").withColumn("best", best).withColumn("others", others)
    out = out.withColumn("against", F.get(F.filter("v", lambda x: x["value"] != F.col("cur")), F.lit(0)))
    alt = F.coalesce(F.get("others", F.lit(0))["eff"], F.lit(0.0))
    foreign = F.array_except(F.flatten(F.transform("others", lambda x: x["classes"])), F.col("best.classes"))
    changed = ~F.col("best.value").eqNullSafe(F.col("cur"))
    dissent = F.coalesce(F.col("against.eff") / F.col("denom") >= policy.conflict_share, F.lit(False))

    def in_order(labels):
        # Labels by their greatest strength, equals by where the label was first seen.
        own = lambda n, part: F.array_min(F.transform(F.filter(labels, lambda x: x["label"] == n), lambda x: x[part]))
        names = F.array_distinct(F.transform(labels, lambda x: x["label"]))
        ranked = F.sort_array(F.transform(names, lambda n: F.struct(own(n, "s").alias("s"), own(n, "o").alias("o"), n.alias("label"))))
        return F.transform(ranked, lambda x: x["label"])

    return out.select(
        *KEYS,
        policy.risk_of(F.col("field")).alias("risk_class"),
        F.col("cur").alias("current_value"),
        F.col("best.value").alias("proposed_value"),
        changed.alias("changed"),
        exact_round(F.col("best.noisy_or") * (F.col("best.eff") / F.col("denom")), 4).alias("confidence"),
        ((F.size(foreign) > 0) & (alt / F.col("denom") >= policy.conflict_share)).alias("conflict"),
        F.size("best.classes").cast("long").alias("corroborating_classes"),
        dissent.alias("dissent"),
        F.when(dissent, F.col("against.value")).alias("dissent_value"),
        in_order(F.col("best.labels")).alias("supporting_sources"),
        in_order(F.flatten(F.transform("others", lambda x: x["labels"]))).alias("competing_sources"),
        F.col("raw_cur").alias("raw_current"),
        F.when(changed, F.col("best.raw")).otherwise(F.col("raw_cur")).alias("raw_proposed"),
        F.least(F.col("best.ord"), F.coalesce(F.array_min(F.transform("others", lambda x: x["ord"])), F.col("best.ord"))).alias("_field_ord"),
    )
