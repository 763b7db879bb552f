"""Which candidate web site is a record's own."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from accordion.functions import normalize
from accordion.functions.numbers import exact_round

# Sites that list anyone, and the points of each kind of evidence.
AGGREGATORS = [
    "healthgrades.com", "www.healthgrades.com", "webmd.com", "doctor.webmd.com", "zocdoc.com", "www.zocdoc.com",
    "yelp.com", "www.yelp.com", "npiprofile.com", "npidb.org", "npiregistry.cms.hhs.gov", "data.cms.gov",
]
POINTS = {"aggregator_penalty": -0.35, "own_domain": 0.05, "practice_name": 0.20, "provider_roster": 0.20, "npi_on_page": 0.15, "phone_match": 0.18, "address_match": 0.20, "page_text_match": 0.07}
VERIFIED, PROBABLE = 0.72, 0.55


def targets(records: DataFrame) -> DataFrame:
    """The sets a candidate is held against. records: provider_id, and arrays practices,
    names, npis, phones, addresses, mentions as given (any may hold nulls)."""
    made = lambda c, f: F.array_distinct(F.array_compact(F.transform(c, f)))
    return records.select(
        "provider_id",
        made("practices", normalize.practice_name).alias("t_practices"),
        made("names", lambda x: normalize.name(x)["canonical"]).alias("t_names"),
        made("npis", normalize.none_if_empty).alias("t_npis"),
        made("phones", normalize.phone).alias("t_phones"),
        made("addresses", lambda x: normalize.address(x)["canonical"]).alias("t_addresses"),
        made("mentions", normalize.clean_text).alias("t_mentions"),
    )


def score(candidates: DataFrame, held: DataFrame, aggregators: list[str] = AGGREGATORS) -> DataFrame:
    """candidates: provider_id, url, pos, practice_name, provider_names (array), npis
    (array), phone, address, page_text. Adds evidence, score and status."""
    rows = candidates.where("url <> ''").join(held, "provider_id").withColumn("domain", normalize.domain(F.col("url")))
    has = lambda c, x: F.coalesce(F.array_contains(c, x), F.lit(False))
    text = normalize.clean_text(F.col("page_text"))
    tests: dict[str, Column] = {
        "aggregator_penalty": F.col("domain").isin(aggregators),
        "own_domain": (F.col("domain") != "") & ~F.col("domain").isin(aggregators),
        "practice_name": has("t_practices", normalize.practice_name(F.col("practice_name"))),
        "provider_roster": F.coalesce(F.arrays_overlap("t_names", F.transform("provider_names", lambda x: normalize.name(x)["canonical"])), F.lit(False)),
        "npi_on_page": F.coalesce(F.arrays_overlap("t_npis", "npis"), F.lit(False)),
        "phone_match": has("t_phones", normalize.phone(F.col("phone"))),
        "address_match": has("t_addresses", normalize.address(F.col("address"))["canonical"]),
        "page_text_match": F.coalesce(F.exists("t_mentions", lambda m: F.contains(text, m)), F.lit(False)),
    }
    found = F.array_compact(F.array(*[F.when(t, F.struct(F.lit(k).alias("label"), F.lit(POINTS[k]).alias("points"))) for k, t in tests.items()]))
    rows = rows.withColumn("evidence", found)
    total = F.aggregate("evidence", F.lit(0.0), lambda a, e: a + e["points"])
    rows = rows.withColumn("score", exact_round(F.least(F.greatest(total, F.lit(0.0)), F.lit(1.0)), 4))
    status = F.when(F.col("score") >= VERIFIED, "verified_official_site").when(F.col("score") >= PROBABLE, "probable_site").otherwise("ambiguous_or_rejected")
    return rows.withColumn("status", status).drop(*[f"t_{t}" for t in ("practices", "names", "npis", "phones", "addresses", "mentions")])


def best_site(scored: DataFrame) -> DataFrame:
    """Each record's best candidate; the first of equals."""
    order = Window.partitionBy("provider_id").orderBy(F.desc("score"), "pos")
    return scored.withColumn("_k", F.row_number().over(order)).where("_k = 1").drop("_k")


def to_assertions(best: DataFrame) -> DataFrame:
    """What verified and probable sites assert, as long rows."""
    usable = best.where(F.col("status").isin("verified_official_site", "probable_site"))
    fields = ["address", "phone", "practice_name"]
    pairs = F.explode(F.filter(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("raw_value")) for f in fields]), lambda x: F.coalesce(x["raw_value"] != "", F.lit(False))))
    rows = usable.select("provider_id", "url", pairs.alias("x")).select("provider_id", "url", "x.field", "x.raw_value")
    return rows.select("provider_id", "field", normalize.of_field(F.col("field"), F.col("raw_value")).alias("value"), "raw_value", F.lit("practice_web_discovered").alias("source_name"), F.lit("Discovered Practice Website").alias("source_label"), F.lit("practice_web").alias("source_class"), "url")
