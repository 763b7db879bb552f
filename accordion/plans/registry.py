"""Every query of the engine by name, and the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from accordion.plans import record_queries, scoring_queries


def _all() -> dict:
    return {**scoring_queries.QUERIES, **record_queries.QUERIES}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring_queries.assess(spark, sf_dir)


def queries() -> dict:
    return {name: run for name, (run, _) in _all().items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in _all().items() if sql}
