"""Which records to verify again first."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accordion.functions.numbers import exact_round

WINDOW_DAYS, FULL_WINDOWS, NEVER_DAYS = 90, 24.0, 10**6
STALE, VOLATILE, HARD, IMPORTANT = 0.50, 0.20, 0.20, 0.10


def risk(records: DataFrame, as_of: date, hard_signals: DataFrame | None = None, importance: DataFrame | None = None) -> DataFrame:
    """provider_id, score, staleness_days, reasons of records (provider_id, phone,
    last_verified_date). Signals and importance (provider_id, value) default to 0 and 0.5."""
    rows = records
    for name, table in (("hard", hard_signals), ("weight", importance)):
        rows = rows.withColumn(name, F.lit(None).cast("double")) if table is None else rows.join(table.select("provider_id", F.col("value").alias(name)), "provider_id", "left")
    never = F.col("last_verified_date").isNull()
    days = F.when(never, NEVER_DAYS).otherwise(F.greatest(F.date_diff(F.lit(as_of), "last_verified_date"), F.lit(0)))
    stale = F.when(never, 1.0).otherwise(F.least(days / WINDOW_DAYS / FULL_WINDOWS, F.lit(1.0)))
    hard, weight = F.coalesce("hard", F.lit(0.0)), F.coalesce("weight", F.lit(0.5))
    unit = lambda c: F.least(F.greatest(c, F.lit(0.0)), F.lit(1.0))
    has_phone = F.col("phone").isNotNull() & (F.col("phone") != "")
    score = STALE * stale + VOLATILE * F.when(has_phone, 0.6).otherwise(0.3) + HARD * unit(hard) + IMPORTANT * unit(weight)
    # The wording of reasons.
    late = F.concat(days.cast("string"), F.lit(f"d since last verify (> {WINDOW_DAYS}d window)"))
    reasons = F.array_compact(F.array(F.when(never, "never verified").when(days > WINDOW_DAYS, late), F.when(hard > 0, "hard signal (deactivation / diff / bounce-back)")))
    return rows.select("provider_id", exact_round(F.least(score, F.lit(1.0)), 4).alias("score"), days.alias("staleness_days"), reasons.alias("reasons"))


def verify_queue(scored: DataFrame, order: Column | str = "provider_id", top: int | None = None) -> DataFrame:
    """Most urgent first; with ``top`` only those (a top-k plan, no full sort)."""
    out = scored.orderBy(F.desc("score"), order)
    return out if top is None else out.limit(top)
