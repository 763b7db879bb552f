"""Which registry entry a directory record is."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from accordion.functions import normalize

ACCEPT, DOUBT, CLOSE = 0.6, 0.5, 0.05
USABLE = ("validated", "bad_checkdigit", "resolved_by_search")


def agreement():
    """How well a record (r) and a registry entry (p) agree by name, 0 to 1. Expects
    r_name, p_name (structs of ``normalize.name``), r_practice, p_org (canonical)."""
    a, b = F.col("r_name.canonical"), F.col("p_name.canonical")
    family = F.coalesce(F.upper("r_name.family") == F.upper(F.coalesce("p_name.family", F.lit(""))), F.lit(False))
    firm = F.contains("r_practice", "p_org") | F.contains("p_org", "r_practice")
    return F.when(a.isNotNull() & b.isNotNull(), F.when(a == b, 1.0).when(family, 0.6).otherwise(0.0)).when(firm, 0.8).otherwise(0.0)


def prepared(directory: DataFrame, registry: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Names and keys are made once a row, before any join."""
    records = directory.withColumn("r_npi", F.when(~normalize.blank(F.col("npi")), F.trim("npi")))
    records = records.withColumns({"r_name": normalize.name(F.col("provider_name")), "r_practice": normalize.practice_name(F.col("practice_name"))})
    records = records.withColumn("search", F.when(F.col("r_name.family").isNotNull(), normalize.search_key(F.lit(""), F.col("r_name.family"), F.col("r_name.given"))).when(~normalize.blank(F.col("practice_name")), normalize.search_key(F.col("practice_name"), F.lit(""), F.lit(""))))
    person = F.concat_ws(" ", "first_name", "last_name")
    entries = registry.withColumns({"p_npi": F.col("npi"), "p_name": normalize.name(F.when(F.col("organization_name").isNull(), person)), "p_org": normalize.practice_name(F.col("organization_name"))}).drop("npi")
    entries = entries.withColumn("search", F.when(F.col("organization_name").isNotNull(), normalize.search_key(F.col("organization_name"), F.lit(""), F.lit(""))).otherwise(normalize.search_key(F.lit(""), F.col("last_name"), F.col("first_name"))))
    first = Window.partitionBy("p_npi").orderBy("_ord")
    return records, entries.withColumn("_n", F.row_number().over(first)).where("_n = 1").drop("_n").withColumnRenamed("_ord", "p_ord")


def resolve(directory: DataFrame, registry: DataFrame, candidates: int = 20) -> DataFrame:
    """directory: provider_id, provider_name, npi, practice_name. registry: npi,
    first_name, last_name, organization_name, display_name, _ord. Returns provider_id,
    status, npi, agreement, note, usable. Records with an identifier are looked up by it,
    the others searched for by name; a close runner-up makes a search undecided."""
    records, entries = prepared(directory, registry)
    known = records.where("r_npi is not null").join(entries.drop("search"), F.col("r_npi") == F.col("p_npi"), "left").withColumn("s", agreement())
    # The wording of notes is part of the results that are compared.
    note = lambda *x: F.concat(F.lit("NPI "), F.col("r_npi"), *[F.lit(y) if isinstance(y, str) else y for y in x])
    valid = normalize.valid_npi(F.col("r_npi"))
    cases = [
        (F.col("p_npi").isNull(), "unresolved", note(" not found in NPPES.")),
        (F.col("s") < DOUBT, "mismatch", note(" resolves to a different entity ('", F.coalesce("display_name", F.lit("")), "'); routing to repair, not update.")),
        (~valid, "bad_checkdigit", note(" fails its check digit; proceeding but flagged for repair.")),
    ]
    status, text = F.lit("validated"), note(" validated and matched.")
    for test, value, words in reversed(cases):
        status, text = F.when(test, value).otherwise(status), F.when(test, words).otherwise(text)
    by_id = known.select("provider_id", status.alias("status"), F.col("r_npi").alias("npi"), F.when(F.col("p_npi").isNull(), 0.0).otherwise(F.col("s")).alias("agreement"), text.alias("note"))

    # A search sees the first entries of its key; these are cut out before the join.
    arrival = Window.partitionBy("search").orderBy("p_ord", "p_npi")
    found = entries.withColumn("_a", F.row_number().over(arrival)).where(F.col("_a") <= candidates).drop("_a")
    cold = records.where("r_npi is null").join(found, "search", "left").withColumn("s", F.when(F.col("p_npi").isNotNull(), agreement()))
    rank = Window.partitionBy("provider_id").orderBy(F.desc_nulls_last("s"), "p_ord", "p_npi")
    top = cold.withColumns({"_k": F.row_number().over(rank), "next": F.lead("s").over(rank)}).where("_k = 1")
    good = F.coalesce(F.col("s") >= ACCEPT, F.lit(False))
    close = F.coalesce(F.col("next") >= F.col("s") - CLOSE, F.lit(False))
    by_search = top.select(
        "provider_id",
        F.when(good & ~close, "resolved_by_search").otherwise("unresolved").alias("status"),
        F.when(good & ~close, F.col("p_npi")).alias("npi"),
        F.when(good, F.col("s")).otherwise(0.0).alias("agreement"),
        F.when(good & close, "Multiple equally plausible NPPES matches; routing to human review.")
        .when(good, F.concat(F.lit("NPI "), F.col("p_npi"), F.lit(" recovered by name/org search (agreement "), F.format_string("%.2f", F.col("s")), F.lit(").")))
        .otherwise("No confident NPPES match; record quarantined for human review.")
        .alias("note"),
    )
    return by_id.unionByName(by_search).withColumn("usable", F.col("status").isin(*USABLE))
