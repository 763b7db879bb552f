"""How right the engine is, by replaying labelled changes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accordion.functions import normalize


def judged(recommendations: DataFrame, truth: DataFrame) -> DataFrame:
    """Each detected change with whether it is right. truth: provider_id, field, value."""
    found = recommendations.select("provider_id", (F.col("recommended_action") == "auto_update").alias("auto"), F.explode("changes").alias("c"))
    found = found.select("provider_id", "auto", F.col("c.field").alias("field"), F.col("c.new_value").alias("new_value"), F.col("c.confidence_score").alias("confidence"))
    rows = found.join(truth.select("provider_id", "field", F.col("value").alias("expected")), ["provider_id", "field"], "left")
    right = F.col("expected").isNotNull() & normalize.of_field(F.col("field"), F.col("new_value")).eqNullSafe(normalize.of_field(F.col("field"), F.col("expected")))
    return rows.withColumn("right", right)


def report(recommendations: DataFrame, truth: DataFrame, expected: DataFrame) -> DataFrame:
    """One row of counters and ratios. expected: provider_id, expected_action."""
    results = recommendations.select("provider_id", "recommended_action")
    changes = judged(recommendations, truth).agg(F.count("*").alias("detected_changes"), F.count_if("right").alias("correct_detections"), F.count_if("auto").alias("auto_updates"), F.count_if(F.col("auto") & F.col("right")).alias("correct_auto_updates"))
    real = truth.join(results, "provider_id", "left_semi").agg(F.count("*").alias("true_changes"))
    routing = results.join(expected, "provider_id", "left").agg(F.count("*").alias("records"), F.count("expected_action").alias("routing_total"), F.count_if(F.col("recommended_action") == F.col("expected_action")).alias("routing_correct"))
    one = changes.join(real).join(routing)  # three tables of one row
    ratio = lambda a, b: F.when(F.col(b) == 0, 1.0).otherwise(F.col(a) / F.col(b))
    return one.withColumns({"recall": ratio("correct_detections", "true_changes"), "detection_precision": ratio("correct_detections", "detected_changes"), "auto_update_precision": ratio("correct_auto_updates", "auto_updates"), "routing_accuracy": ratio("routing_correct", "routing_total")})


def calibration(samples: DataFrame, n_bins: int = 5) -> DataFrame:
    """Reliability bins of samples (confidence, right); empty bins too."""
    at = F.least(F.floor(F.col("confidence") * n_bins), F.lit(n_bins - 1)).cast("long")
    bins = samples.groupBy(at.alias("id")).agg(F.count("*").alias("n"), F.avg("confidence").alias("mean_confidence"), F.avg(F.col("right").cast("double")).alias("accuracy"))
    return samples.sparkSession.range(n_bins).join(bins, "id", "left").select((F.col("id") / n_bins).alias("lo"), ((F.col("id") + 1) / n_bins).alias("hi"), F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("mean_confidence", F.lit(0.0)).alias("mean_confidence"), F.coalesce("accuracy", F.lit(0.0)).alias("accuracy"))


def brier(samples: DataFrame) -> DataFrame:
    return samples.agg(F.round(F.coalesce(F.avg(F.pow(F.col("confidence") - F.col("right").cast("double"), F.lit(2))), F.lit(0.0)), 4).alias("brier"))


def calibration_error(bins: DataFrame) -> DataFrame:
    return bins.agg(F.round(F.coalesce(F.sum(F.col("n") * F.abs(F.col("mean_confidence") - F.col("accuracy"))) / F.nullif(F.sum("n"), F.lit(0)), F.lit(0.0)), 4).alias("ece"))


def build_cases(before: DataFrame, after: DataFrame) -> DataFrame:
    """What changed between two snapshots (npi, address, phone, status), and the action
    that is right for it."""
    new = after.select("npi", *[F.col(c).alias(f"new_{c}") for c in ("address", "phone", "status")])
    rows = before.join(new, "npi")
    moved = lambda c: F.when((F.coalesce(F.col(c), F.lit("")) != F.coalesce(F.col(f"new_{c}"), F.lit(""))) & (F.col(f"new_{c}") != ""), F.col(f"new_{c}"))
    closed = F.when((F.col("status") == "A") & (F.col("new_status") == "I"), "Inactive")
    rows = rows.select("npi", moved("address").alias("address"), moved("phone").alias("phone"), closed.alias("active"))
    action = F.when(F.col("active").isNotNull(), "human_review").when(F.coalesce("address", "phone").isNotNull(), "auto_update").otherwise("no_change")
    return rows.withColumn("expected_action", action)
