"""What to do with a record, given the assessments of its fields."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accordion.functions import normalize
from accordion.functions.numbers import exact_round
from accordion.plans.policy import RISK_LEVELS, Policy, lookup


def quoted(c: Column) -> Column:
    return F.concat(F.lit("'"), c, F.lit("'"))


def two(c: Column) -> Column:
    return F.format_string("%.2f", exact_round(c, 2))


def decide(assessments: DataFrame, policy: Policy, records: DataFrame | None = None) -> DataFrame:
    """One row per record: recommendation columns and ``changes``.

    One aggregation on the record; the rules are a ladder over its fields, kept in harvest
    order (``_field_ord``). ``records`` (provider_id, npi) adds those without assessments.
    """
    one = F.struct("_field_ord", "field", "risk_class", "current_value", "confidence", "conflict", "corroborating_classes", "changed", "dissent", "dissent_value", "supporting_sources", "competing_sources", "raw_current", "raw_proposed")
    rows = assessments.groupBy("provider_id").agg(F.sort_array(F.collect_list(one)).alias("a"))
    if records is not None:
        rows = records.select("provider_id", "npi").join(rows, "provider_id", "left").withColumn("a", F.coalesce("a", F.array().cast(rows.schema["a"].dataType)))
    else:
        rows = rows.withColumn("npi", F.lit(None).cast("string"))
    rows = rows.withColumn("ch", F.filter("a", lambda x: x["changed"])).withColumn("dh", F.filter("a", lambda x: x["dissent"] & (x["risk_class"] == "high")))
    mean = lambda c: F.aggregate(c, F.lit(0.0), lambda s, x: s + x["confidence"]) / F.size(c)
    any_change = F.size("ch") > 0
    overall = exact_round(F.when(any_change, mean(F.col("ch"))).when(F.size("a") > 0, mean(F.col("a"))).otherwise(1.0), 2)
    level = F.array_max(F.transform("ch", lambda x: lookup(RISK_LEVELS, x["risk_class"])))
    threshold = lookup({RISK_LEVELS[r]: t for r, t in policy.thresholds.items()}, level)
    low = F.array_min(F.transform("ch", lambda x: x["confidence"]))
    enough = F.forall("ch", lambda x: x["corroborating_classes"] >= lookup(policy.min_classes, x["risk_class"]))
    rows = rows.withColumns({"overall_confidence": overall, "threshold": threshold, "low": low, "enough": enough})
    rows = rows.withColumns({
        "clash": F.get(F.filter("ch", lambda x: x["conflict"]), F.lit(0)),
        "held": F.array_join(F.array_sort(F.array_distinct(F.transform(F.filter("ch", lambda x: x["field"].isin(*policy.never_auto)), lambda x: x["field"]))), ", "),
        "d": F.get("dh", F.lit(0)),
    })
    names = F.array_join(F.transform("ch", lambda x: x["field"]), ", ")
    side = lambda c, other: F.when(F.size(c) > 0, F.array_join(c, ", ")).otherwise(F.lit(other))
    stale = F.concat(F.lit("A reliable source reports "), F.col("d.field"), F.lit("="), quoted(F.col("d.dissent_value")), F.lit(" while the record still shows "), quoted(F.col("d.current_value")))
    short = F.when(F.col("enough"), F.lit("")).otherwise(F.lit("; insufficient independent corroboration"))
    # The wording of reasons is part of the results that are compared.
    ladder = [
        (~any_change & F.col("d").isNotNull(), "human_review", F.concat(stale, F.lit("; flagged for verification (high-risk field never silently left stale)."))),
        (~any_change, "no_change", F.lit("All checked fields match authoritative sources; record confirmed accurate.")),
        (F.exists("ch", lambda x: x["field"] == "npi"), "human_review", F.lit("NPI differs from the record — this indicates a data-entry error or a merged duplicate, not a field update. Routed to repair/dedup.")),
        (F.col("clash").isNotNull(), "human_review", F.concat(side(F.col("clash.supporting_sources"), "newer sources"), F.lit(" and "), side(F.col("clash.competing_sources"), "the existing record"), F.lit(" disagree on "), F.col("clash.field"), F.lit("; manual verification recommended."))),
        (F.col("held") != "", "human_review", F.concat(F.lit("High-risk field(s) changed ("), F.col("held"), F.lit("); never updated silently - routed to human confirmation."))),
        (F.col("d").isNotNull(), "human_review", F.concat(stale, F.lit("; routed to human review before any update."))),
        ((F.col("low") >= F.col("threshold")) & F.col("enough"), "auto_update", F.concat(F.lit("Updated "), names, F.lit(" confirmed by independent reliable sources (min confidence "), two(F.col("low")), F.lit(" >= "), two(F.col("threshold")), F.lit(")."))),
        (F.col("low") >= policy.tau_low, "human_review", F.concat(F.lit("Change detected but below the auto-update bar (min confidence "), two(F.col("low")), F.lit(" < "), two(F.col("threshold")), short, F.lit("); routed to human review."))),
    ]
    weak = F.concat(F.lit("Evidence too weak (min confidence "), two(F.col("low")), F.lit(f" < {policy.tau_low:.2f}); holding the record unchanged and re-queuing."))

    def pick(column: int, last: Column) -> Column:
        first, *rest = ladder
        as_column = lambda x: x if isinstance(x, Column) else F.lit(x)
        return reduce(lambda c, r: c.when(r[0], as_column(r[column])), rest, F.when(first[0], as_column(first[column]))).otherwise(last)

    change = lambda x: F.struct(x["field"].alias("field"), x["raw_current"].alias("old_value"), x["raw_proposed"].alias("new_value"), exact_round(x["confidence"], 2).alias("confidence_score"), x["supporting_sources"].alias("supporting_sources"))
    return rows.select(
        "provider_id",
        "npi",
        any_change.alias("change_detected"),
        F.transform("ch", change).alias("changes"),
        "overall_confidence",
        pick(1, F.lit("discard")).alias("recommended_action"),
        pick(2, weak).alias("reason"),
    )


def signals(recommendations: DataFrame, records: DataFrame) -> DataFrame:
    """provider_id, signals: the life events behind a record's changes."""
    rows = recommendations.join(records.select("provider_id", "provider_name", "practice_name"), "provider_id")
    of = lambda f: F.get(F.filter("changes", lambda x: x["field"] == f), F.lit(0))
    firm = F.col("provider_name").isNull() & F.col("practice_name").isNotNull()
    rows = rows.withColumns({f: of(f) for f in ("address", "active", "npi")} | {"rebrand": of("practice_name")})
    old, new = (normalize.address(F.col(f"address.{c}"))["canonical"] for c in ("old_value", "new_value"))
    arrow = lambda c: F.concat(F.coalesce(F.col(f"{c}.old_value"), F.lit("None")), F.lit(" -> "), F.coalesce(F.col(f"{c}.new_value"), F.lit("None")))
    found = F.array(
        F.when(old != new, F.concat(F.when(firm, "practice relocation").otherwise("provider movement"), F.lit(": "), arrow("address"))),
        F.when(normalize.active(F.col("active.new_value")) == "inactive", F.when(firm, "practice closure").otherwise("provider inactive/retired")),
        F.when(F.col("rebrand").isNotNull(), F.concat(F.lit("practice rebrand: "), arrow("rebrand"))),
        F.when(F.col("npi").isNotNull(), "NPI mismatch -> dedup/repair ticket"),
    )
    return rows.select("provider_id", F.array_compact(found).alias("signals"))


def effective_address(recommendations: DataFrame, records: DataFrame) -> DataFrame:
    """provider_id, address: the proposed one if there is one."""
    new = F.get(F.filter("changes", lambda x: (x["field"] == "address") & (x["new_value"] != "")), F.lit(0))["new_value"]
    return records.select("provider_id", "address").join(recommendations.select("provider_id", new.alias("new")), "provider_id", "left").select("provider_id", F.coalesce("new", "address").alias("address"))
