"""Tables kept between steps, where every executor can read them."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame


def written(df: DataFrame) -> DataFrame:
    """A written copy in the folder that all executors share, which cuts the lineage: a
    lost executor costs one step. Where no folder is set one is made, but only if the
    executors are threads of this process (tests)."""
    spark = df.sparkSession
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        at = tempfile.mkdtemp(prefix="accordion-")
        spark.conf.set("spark.checkpoint.dir", at)
    path = f"{at.rstrip('/')}/kept-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
