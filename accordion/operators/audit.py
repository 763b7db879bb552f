"""The append-only trail: events, sinks, the review queue and reviewer decisions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from accordion.plans.policy import RISK_LEVELS, lookup

VERSION = "1.0.0"


def evidence(assertions: DataFrame, assessments: DataFrame) -> DataFrame:
    """provider_id, field, sources: the assertions of the proposed value, in harvest order."""
    keys = ["provider_id", "field"]
    one = F.struct("_src_ord", "source_name", "source_label", "source_class", "url", F.coalesce("raw_value", "value").alias("asserted_value"), F.round("weight", 4).alias("weight"), F.round("freshness", 4).alias("freshness"), "snapshot_hash")
    chosen = assertions.join(assessments.where("changed").select(*keys, "proposed_value"), keys).where("value = proposed_value")
    return chosen.groupBy(*keys).agg(F.sort_array(F.collect_list(one)).alias("sources"))


def events(recommendations: DataFrame, assessments: DataFrame, sources: DataFrame | None = None, coordinates: DataFrame | None = None, at=None) -> DataFrame:
    """One event for each change, or one summary event for a record without any."""
    keys = ["provider_id", "field"]
    head = ["provider_id", "npi", F.col("recommended_action").alias("decision"), "overall_confidence", "reason"]
    rows = recommendations.select(*head, F.explode_outer("changes").alias("c"))
    rows = rows.select("provider_id", "npi", F.col("c.field").alias("field"), F.col("c.old_value").alias("old_value"), F.col("c.new_value").alias("new_value"), "decision", F.col("c.confidence_score").alias("field_confidence"), "overall_confidence", "reason")
    rows = rows.join(assessments.select(*keys, "risk_class", "conflict"), keys, "left").withColumn("conflict", F.coalesce("conflict", F.lit(False)))
    if sources is not None:
        rows = rows.join(sources, keys, "left")
    if coordinates is not None:
        rows = rows.join(coordinates.select("provider_id", "lat", "lon"), "provider_id", "left")
        rows = rows.withColumns({"latitude": F.when(F.col("field") == "address", F.col("lat")), "longitude": F.when(F.col("field") == "address", F.col("lon"))}).drop("lat", "lon")
    stamp = F.current_timestamp() if at is None else F.lit(at).cast("timestamp")
    return rows.withColumns({"event_id": F.uuid() if at is None else F.sha2(F.concat_ws("|", "provider_id", F.coalesce("field", F.lit("")), stamp.cast("string")), 256), "actor": F.lit("pipeline"), "pipeline_version": F.lit(VERSION), "timestamp": stamp})


def append(rows: DataFrame, path: str) -> None:
    """Adds JSON lines to the trail."""
    rows.write.mode("append").json(path)


def reviewed(spark: SparkSession, provider_id: str, decision: str, fields: list[str], note: str = "", reviewer: str = "", at=None) -> DataFrame:
    """A reviewer's decision as a row for ``append``."""
    rows = spark.createDataFrame([(provider_id, decision, list(fields), note, reviewer)], "provider_id string, decision string, fields array<string>, note string, reviewer string")
    return rows.withColumn("timestamp", F.current_timestamp() if at is None else F.lit(at).cast("timestamp"))


def review_queue(trail: DataFrame, decided: DataFrame | None = None) -> DataFrame:
    """One row per record that waits for a reviewer, the gravest and conflicted first."""
    rows = trail.where("decision = 'human_review'")
    if decided is not None:
        rows = rows.join(decided.select("provider_id").distinct(), "provider_id", "left_anti")
    gravity = F.coalesce(2 - lookup(RISK_LEVELS, F.col("risk_class")), F.lit(3))
    queue = rows.groupBy("provider_id").agg(F.min(gravity).alias("risk_rank"), F.bool_or("conflict").alias("conflict"), F.count("field").alias("n_fields"), F.max("overall_confidence").alias("overall_confidence"))
    return queue.orderBy("risk_rank", F.desc("conflict"), "provider_id")


def review_counts(trail: DataFrame, decided: DataFrame) -> DataFrame:
    """queue, reviewed and pending in one row."""
    queue = trail.where("decision = 'human_review'").select("provider_id").distinct()
    marked = queue.join(decided.select("provider_id").distinct().withColumn("d", F.lit(1)), "provider_id", "left")
    return marked.agg(F.count("*").alias("queue"), F.count("d").alias("reviewed"), (F.count("*") - F.count("d")).alias("pending"))


def confidence_band(c):
    return F.when(c >= 0.85, "high").when(c >= 0.60, "medium").otherwise("low")
