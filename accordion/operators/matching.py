"""Duplicate records: blocking, pair scores, connected components, clusters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accordion.functions import normalize, similarity
from accordion.functions.numbers import exact_round
from accordion.plans.store import written

THRESHOLD = 0.82
CARRIED = ("provider_id", "npi", "name_g", "place_g", "phone")


def block_keys(records: DataFrame) -> DataFrame:
    """records (provider_id, npi, provider_name, address, phone) with canonical columns
    and one row per block key: the identifier, and sound of the family name with ZIP."""
    made = records.withColumns({"n": normalize.name(F.col("provider_name")), "a": normalize.address(F.col("address")), "p": normalize.phone(F.col("phone"))})
    made = made.select("provider_id", normalize.none_if_empty(F.col("npi")).alias("npi"), F.col("n.canonical").alias("name"), F.col("n.family").alias("family"), F.col("a.canonical").alias("place"), F.col("a.zip5").alias("zip5"), F.col("p").alias("phone"))
    # Trigram sets once a record, not once a pair.
    grams = lambda c: F.when(F.col(c) != "", similarity.trigrams(F.col(c)))
    made = made.withColumns({"name_g": grams("name"), "place_g": grams("place")})
    by_npi = F.concat(F.lit("npi:"), F.col("npi"))
    # Without a name a pair scores 0.45 at most unless the identifiers are equal, and
    # those meet in their own block; so nameless records need no sound block.
    by_sound = F.when(F.col("name").isNotNull(), F.concat(F.lit("sx:"), similarity.soundex(F.col("family")), F.lit(":"), F.coalesce("zip5", F.lit("?????"))))
    return made.withColumn("block", F.explode(F.array_compact(F.array(by_npi, by_sound))))


def candidate_pairs(blocked: DataFrame) -> DataFrame:
    """Each unordered pair of records that share a block, once. Pairs are made and
    deduplicated as identifiers; names, places and phones join them afterwards."""
    ids = [blocked.select("block", F.col("provider_id").alias(f"provider_id_{s}")) for s in "ab"]
    pairs = ids[0].join(ids[1], "block").where("provider_id_a < provider_id_b").select("provider_id_a", "provider_id_b").distinct()
    about = blocked.select(*CARRIED).dropDuplicates(["provider_id"])
    for s in "ab":
        pairs = pairs.join(about.select(*[F.col(c).alias(f"{c}_{s}") for c in CARRIED]), f"provider_id_{s}")
    return pairs


def scored_pairs(pairs: DataFrame, coordinates: DataFrame | None = None) -> DataFrame:
    """provider_id_a, provider_id_b, score, reason. coordinates: provider_id, lat, lon."""
    for s in "ab" if coordinates is not None else "":
        pairs = pairs.join(coordinates.select(F.col("provider_id").alias(f"provider_id_{s}"), F.col("lat").alias(f"lat_{s}"), F.col("lon").alias(f"lon_{s}")), f"provider_id_{s}", "left")
    geo = F.lit(None).cast("double") if coordinates is None else similarity.site_similarity(similarity.haversine_km(F.col("lat_a"), F.col("lon_a"), F.col("lat_b"), F.col("lon_b")))
    same = F.coalesce(F.col("npi_a") == F.col("npi_b"), F.lit(False))
    rows = pairs.withColumns({
        "same": same,
        "geo": geo,
        "name_sim": similarity.set_similarity(F.col("name_g_a"), F.col("name_g_b")),
        "place_sim": similarity.set_similarity(F.col("place_g_a"), F.col("place_g_b")),
        "phone_sim": F.when(F.col("phone_a") == F.col("phone_b"), 1.0).otherwise(0.0),
    })
    score = exact_round(0.55 * F.col("name_sim") + 0.30 * F.coalesce("geo", "place_sim") + 0.15 * F.col("phone_sim"), 4)
    two = lambda c: F.format_string("%.2f", exact_round(c, 2))
    reason = F.concat(F.lit("name="), two(F.col("name_sim")), F.when(F.col("geo").isNotNull(), F.concat(F.lit(", geo="), two(F.col("geo")))).otherwise(F.concat(F.lit(", address="), two(F.col("place_sim")))), F.lit(", phone="), two(F.col("phone_sim")))
    return rows.select("provider_id_a", "provider_id_b", F.when(F.col("same"), 1.0).otherwise(score).alias("score"), F.when(F.col("same"), F.concat(F.lit("identical NPI "), F.col("npi_a"))).otherwise(reason).alias("reason"))


def connected_components(edges: DataFrame, rounds: int = 50) -> DataFrame:
    """node, component (the least node) of edges (a, b): label propagation with pointer
    jumping. Each round is written to ``spark.checkpoint.dir``, which cuts the lineage;
    a loop that does not settle fails loudly."""
    both = written(edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v"))).distinct())
    labels = written(both.groupBy(F.col("u").alias("node")).agg(F.least(F.first("u"), F.min("v")).alias("component")))
    for _ in range(rounds):
        near = both.join(labels.select(F.col("node").alias("v"), "component"), "v").groupBy(F.col("u").alias("node")).agg(F.min("component").alias("near"))
        low = labels.join(near, "node").select("node", F.col("component").alias("was"), F.least("component", "near").alias("low"))
        new = written(low.join(labels.select(F.col("node").alias("low"), F.col("component").alias("next")), "low").select("node", "was", F.least("low", "next").alias("component")))
        labels = new.select("node", "component")
        if not new.where("was <> component").limit(1).count():
            return labels
    raise RuntimeError("connected components did not settle")


def clusters(records: DataFrame, coordinates: DataFrame | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """cluster_id (least member), provider_ids, npi, match_score, reason."""
    accepted = written(scored_pairs(candidate_pairs(block_keys(records)), coordinates).where(F.col("score") >= threshold))
    labels = connected_components(accepted.select(F.col("provider_id_a").alias("a"), F.col("provider_id_b").alias("b")))
    members = labels.join(records.select(F.col("provider_id").alias("node"), normalize.none_if_empty(F.col("npi")).alias("npi")), "node")
    ids = members.groupBy("component").agg(F.sort_array(F.collect_list("node")).alias("provider_ids"), F.min_by("npi", F.when(F.col("npi").isNotNull(), F.col("node"))).alias("npi"))
    why = accepted.join(labels, F.col("provider_id_a") == F.col("node")).groupBy("component").agg(F.max("score").alias("match_score"), F.array_join(F.sort_array(F.collect_set("reason")), "; ").alias("reason"))
    return ids.join(why, "component").withColumnRenamed("component", "cluster_id")
