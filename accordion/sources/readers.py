"""Readers: JSON and CSV inputs under declared schemas, as long assertion rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from accordion.functions import normalize

RECORD = "provider_id string, provider_name string, npi string, specialty string, practice_name string, address string, phone string, website string, active boolean, last_verified_date date"
REGISTRY = (
    "result_count int, results array<struct<number:string, enumeration_type:string, "
    "basic:struct<first_name:string, last_name:string, credential:string, organization_name:string, status:string, last_updated:string>, "
    "taxonomies:array<struct<code:string, `desc`:string, `primary`:boolean, state:string>>, "
    "addresses:array<struct<address_purpose:string, address_1:string, city:string, state:string, postal_code:string, telephone_number:string>>>>"
)
WEB = "provider_id string, sources array<struct<source_name:string, source_label:string, source_class:string, url:string, fields:string>>"


EVENT = (
    "provider_id string, npi string, field string, old_value string, new_value string, decision string, field_confidence double, overall_confidence double, reason string, risk_class string, conflict boolean, "
    "sources array<struct<source_name:string, source_label:string, source_class:string, url:string, asserted_value:string, weight:double, freshness:double, snapshot_hash:string>>, "
    "latitude double, longitude double, event_id string, actor string, pipeline_version string, timestamp timestamp"
)
DECISION = "provider_id string, decision string, fields array<string>, note string, reviewer string, timestamp timestamp"


def _in_file_order() -> list:
    """Columns that order rows as their files have them: by file, place of the split, and
    place in it."""
    return [F.col("_metadata.file_path").alias("_f"), F.col("_metadata.file_block_start").alias("_b"), F.monotonically_increasing_id().alias("_o")]


def directory(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Records of JSON files that hold a list, or an object with ``records`` (such a file is
    one row of one task); with ``lines`` of files with a record a line, of any size. Lines
    are numbered within their split, so ``_ord`` only tells apart, it does not count."""
    if lines:
        return spark.read.schema(RECORD).json(path).withColumn("_ord", F.monotonically_increasing_id())
    raw = spark.read.text(path, wholetext=True).withColumn("v", F.parse_json("value"))
    inner = F.coalesce(F.try_variant_get("v", "$.records", "variant"), F.col("v"))
    listed = F.from_json(F.to_json(inner), f"array<struct<{_fields(RECORD)}>>")
    return raw.select(F.posexplode(listed).alias("_ord", "r")).select("r.*", F.col("_ord").cast("long"))


def _fields(schema: str) -> str:
    return ", ".join(":".join(x.split()) for x in schema.split(", "))


def registry(spark: SparkSession, path: str) -> DataFrame:
    """All results of the files of the provider registry, flat: the primary taxonomy (else
    the first) and the practice address (else the first); ``_ord`` is the place in the
    file. A look-up by identifier and the harvest take the first of each npi."""
    raw = spark.read.schema(REGISTRY).option("multiLine", True).json(path).select(F.posexplode("results").alias("_ord", "r"))
    return flat_registry(raw)


def flat_registry(raw: DataFrame) -> DataFrame:
    pick = lambda c, test: F.coalesce(F.get(F.filter(c, test), F.lit(0)), F.get(c, F.lit(0)))
    rows = raw.withColumns({"t": pick("r.taxonomies", lambda x: x["primary"]), "a": pick("r.addresses", lambda x: x["address_purpose"] == "LOCATION")})
    return rows.select(
        F.col("r.number").alias("npi"), F.col("r.enumeration_type").endswith("2").alias("is_organization"),
        "r.basic.first_name", "r.basic.last_name", "r.basic.credential", "r.basic.organization_name", "r.basic.status",
        normalize.source_date(F.col("r.basic.last_updated")).alias("data_as_of"),
        F.col("t.code").alias("taxonomy_code"), F.col("t.desc").alias("taxonomy_desc"),
        "a.address_1", "a.city", "a.state", "a.postal_code", F.col("a.telephone_number").alias("telephone"),
        F.coalesce("r.basic.organization_name", F.concat_ws(", ", F.concat_ws(" ", "r.basic.first_name", "r.basic.last_name"), "r.basic.credential")).alias("display_name"),
        F.col("_ord").cast("long"),
    )


def _long(rows: DataFrame, key: str, pairs: list, *more: str) -> DataFrame:
    """(field, canonical value, value as given) columns to rows; those without a value go."""
    made = F.array(*[F.struct(F.lit(f).alias("field"), v.alias("value"), r.alias("raw_value")) for f, v, r in pairs])
    known = F.filter(made, lambda x: x["value"].isNotNull())
    return rows.select(key, *more, F.posexplode(known).alias("_pos", "x")).select(key, "x.*", *more, "_pos")


def registry_assertions(rows: DataFrame) -> DataFrame:
    """npi, field, value, raw_value, data_as_of and the source columns."""
    firm, person = F.col("is_organization"), ~F.col("is_organization")
    full = F.concat_ws(" ", "first_name", "last_name")
    place = normalize.address_of_parts(F.col("address_1"), F.col("city"), F.col("state"), F.col("postal_code"))["canonical"]
    shown = F.concat_ws(", ", "address_1", "city", F.concat_ws(" ", "state", normalize.zip_display(F.col("postal_code"))))
    pairs = [
        ("practice_name", F.when(firm, normalize.practice_name(F.col("organization_name"))), F.col("organization_name")),
        ("provider_name", F.when(person, normalize.name(full)["canonical"]), F.col("display_name")),
        ("specialty", F.when(person, F.upper("taxonomy_code")), F.coalesce("taxonomy_desc", "taxonomy_code")),
        ("active", F.when(person, normalize.active(F.col("status"))), normalize.status_label(F.col("status"))),
        ("address", place, shown),
        ("phone", normalize.phone(F.col("telephone")), F.col("telephone")),
    ]
    return _sourced(_long(rows, "npi", pairs, "data_as_of"), "nppes", "NPPES", "gov_self_reported")


def _sourced(rows: DataFrame, name: str, label: str, source_class: str) -> DataFrame:
    return rows.withColumns({"source_name": F.lit(name), "source_label": F.lit(label), "source_class": F.lit(source_class)})


#: Column names under which claims files have each value (fixed values), the first known counts.
CLAIMS = {
    "npi": ["NPI", "npi"],
    "practice_name": ["Facility Name", "facility_name", "org_nm"],
    "address_1": ["adr_ln_1", "Address Line 1", "adr_ln1"],
    "city": ["City/Town", "citytown", "City", "cty"],
    "state": ["State", "st", "State/Province"],
    "postal_code": ["ZIP Code", "zip_cd", "Zip Code"],
    "phone": ["Telephone Number", "phn_numbr", "Phone Number"],
    "last_updated": ["Last Updated", "last_updated", "data_as_of"],
}


def claims(rows: DataFrame) -> DataFrame:
    """Rows of a claims file by any of the known column names; the first row per npi."""
    have = {c.lower(): c for c in rows.columns}
    pick = lambda names: normalize.first_known(*[F.col(f"`{have[n.lower()]}`") for n in names if n.lower() in have] or [F.lit(None).cast("string")])
    out = rows.select(*[pick(names).alias(k) for k, names in CLAIMS.items()], F.col("_ord"))
    first = Window.partitionBy("npi").orderBy("_ord")
    return out.withColumn("_k", F.row_number().over(first)).where("_k = 1").drop("_k").withColumn("data_as_of", normalize.source_date(F.col("last_updated")))


def claims_assertions(rows: DataFrame) -> DataFrame:
    place = normalize.address_of_parts(F.col("address_1"), F.col("city"), F.col("state"), F.col("postal_code"))["canonical"]
    shown = F.concat_ws(", ", "address_1", "city", F.concat_ws(" ", "state", normalize.zip_display(F.col("postal_code"))))
    pairs = [("address", place, shown), ("phone", normalize.phone(F.col("phone")), F.col("phone")), ("practice_name", normalize.practice_name(F.col("practice_name")), F.col("practice_name"))]
    return _sourced(_long(rows, "npi", pairs, "data_as_of"), "cms", "CMS", "gov_claims")


def web_assertions(pages: DataFrame) -> DataFrame:
    """Extractions (schema WEB; ``fields`` is JSON, a value or an object with a value)."""
    rows = pages.select("provider_id", F.posexplode("sources").alias("_s", "s"))
    fields = F.from_json("s.fields", "map<string,string>")
    rows = rows.select("provider_id", "_s", "s.source_name", "s.source_label", "s.source_class", "s.url", F.explode(fields).alias("field", "raw"))
    inner = F.get_json_object("raw", "$.value")
    rows = rows.withColumn("raw_value", F.when(F.col("raw").startswith("{"), inner).otherwise(F.col("raw"))).drop("raw")
    # Fields without a canonical form of their own on the web are compared as given.
    plain = F.col("field").isin("phone", "address", "practice_name", "active", "website")
    value = F.when(plain, normalize.of_field(F.col("field"), F.col("raw_value"))).otherwise(F.col("raw_value"))
    rows = rows.withColumns({"value": value, "data_as_of": F.lit(None).cast("date"), "source_label": F.coalesce("source_label", "source_name"), "_pos": F.col("_s")})
    return rows.where("value is not null").drop("_s")


def specialties(spark: SparkSession, path: str | None = None) -> DataFrame:
    """code, specialty: the seed, with the rows of a CSV (code, specialty) over it."""
    seed = spark.createDataFrame([(c, s, 0, i) for i, (c, s) in enumerate(normalize.SPECIALTY_SEED.items())], "code string, specialty string, rank int, ord long")
    if path:
        rows = spark.read.option("header", True).schema("code string, specialty string").csv(path)
        seed = seed.unionByName(rows.select(F.upper(F.trim("code")).alias("code"), F.trim("specialty").alias("specialty"), F.lit(1).alias("rank"), F.monotonically_increasing_id().alias("ord")).where("code <> '' and specialty <> ''"))
    return merged_specialties(seed)


def merged_specialties(rows: DataFrame) -> DataFrame:
    """One row per code: of the highest rank, then the last."""
    return rows.groupBy("code").agg(F.max_by("specialty", F.struct("rank", "ord")).alias("specialty"))


def snapshot(spark: SparkSession, path: str, limit: int | None = None) -> DataFrame:
    """A bulk registry CSV as npi, entity, address, phone, status, first, last, org; the
    last row of an npi counts, files being read in the order of their names. With
    ``limit`` only that many first rows are read; rows without an npi go."""
    rows = spark.read.option("header", True).csv(path)
    rows = rows.select("*", *_in_file_order())
    if limit is not None:
        rows = rows.orderBy("_f", "_b", "_o").limit(limit)
    col = lambda n: F.col(f"`{n}`")
    at = lambda n: col(f"Provider Business Practice Location Address {n}")
    address = F.concat_ws(", ", col("Provider First Line Business Practice Location Address"), at("City Name"), F.concat_ws(" ", at("State Name"), normalize.zip5(at("Postal Code"))))
    rows = rows.where(~normalize.blank(col("NPI"))).select(
        col("NPI").alias("npi"), col("Entity Type Code").alias("entity"), address.alias("address"), at("Telephone Number").alias("phone"),
        F.when(normalize.blank(col("NPI Deactivation Date")), "A").otherwise("I").alias("status"), col("Provider First Name").alias("first"), col("Provider Last Name (Legal Name)").alias("last"),
        col("Provider Organization Name (Legal Business Name)").alias("org"), F.struct("_f", "_b", "_o").alias("_at"),
    )
    return rows.groupBy("npi").agg(F.max_by(F.struct(*[c for c in rows.columns if c not in ("npi", "_at")]), "_at").alias("r")).select("npi", "r.*")


def cases(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """A file of labelled cases {directory: [...], truth: {id: {changes: {field: value},
    expected_action}}}: directory (empty if there is none), truth (provider_id, field,
    value) and expected (provider_id, expected_action)."""
    raw = spark.read.text(path, wholetext=True).withColumn("v", F.parse_json("value"))
    listed = F.from_json(F.to_json(F.try_variant_get("v", "$.directory", "variant")), f"array<struct<{_fields(RECORD)}>>")
    records = raw.select(F.posexplode(listed).alias("_ord", "r")).select("r.*", F.col("_ord").cast("long"))
    each = F.from_json(F.to_json(F.try_variant_get("v", "$.truth", "variant")), "map<string, struct<changes:map<string,string>, expected_action:string>>")
    truth = raw.select(F.explode(each).alias("provider_id", "t"))
    return {"directory": records, "truth": truth.select("provider_id", F.explode("t.changes").alias("field", "value")), "expected": truth.select("provider_id", F.col("t.expected_action").alias("expected_action"))}


def trail(spark: SparkSession, path: str) -> DataFrame:
    """The events of an audit trail of JSON lines."""
    return spark.read.schema(EVENT).json(path)


def decisions(spark: SparkSession, path: str) -> DataFrame:
    """What reviewers decided, of JSON lines."""
    return spark.read.schema(DECISION).json(path)


def geocoded(records: DataFrame, answers: DataFrame | None = None) -> DataFrame:
    """provider_id, matched, canonical, lat, lon of records (provider_id, address). answers:
    a geocoder's (address, matched_address, lat, lon). Without them an address stands for
    itself and has no coordinates; an address that they don't have is not matched."""
    rows = records.select("provider_id", "address")
    own, known = normalize.address(F.col("address"))["canonical"], ~normalize.blank(F.col("address"))
    if answers is None:
        none = F.lit(None).cast("double")
        return rows.select("provider_id", F.coalesce(known, F.lit(False)).alias("matched"), F.when(known, own).alias("canonical"), none.alias("lat"), none.alias("lon"))
    first = answers.groupBy("address").agg(F.min(F.struct("matched_address", "lat", "lon")).alias("g"))
    rows = rows.join(first, "address", "left")
    return rows.select("provider_id", F.col("g").isNotNull().alias("matched"), F.coalesce(normalize.address(F.col("g.matched_address"))["canonical"], F.when(known, own)).alias("canonical"), "g.lat", "g.lon")


def fresh_cache(cache: DataFrame, now, ttl_seconds: int) -> DataFrame:
    """The newest entry of each key (key, payload, fetched_at) that is still valid."""
    newest = Window.partitionBy("key").orderBy(F.desc("fetched_at"))
    fresh = F.col("fetched_at") > F.lit(now).cast("timestamp") - F.make_dt_interval(secs=F.lit(ttl_seconds))
    return cache.withColumn("_k", F.row_number().over(newest)).where("_k = 1").drop("_k").where(fresh)


def web_files(spark: SparkSession, path: str) -> DataFrame:
    """Extraction files of the schema WEB, whatever their fields hold."""
    raw = spark.read.text(path, wholetext=True).withColumn("v", F.parse_json("value"))
    sources = F.from_json(F.to_json(F.try_variant_get("v", "$.sources", "variant")), "array<struct<source_name:string, source_label:string, source_class:string, url:string, fields:string>>")
    return raw.select(F.try_variant_get("v", "$.provider_id", "string").alias("provider_id"), sources.alias("sources"))


def candidate_files(spark: SparkSession, path: str) -> DataFrame:
    """Candidate sites of JSON files {provider_id, candidates: [{url, fields}]}; names and
    identifiers may be one or a list."""
    raw = spark.read.text(path, wholetext=True).withColumn("v", F.parse_json("value"))
    each = F.from_json(F.to_json(F.try_variant_get("v", "$.candidates", "variant")), "array<struct<url:string, fields:map<string,string>>>")
    rows = raw.select(F.try_variant_get("v", "$.provider_id", "string").alias("provider_id"), F.posexplode(each).alias("pos", "c"))
    get = lambda k: F.try_element_at("c.fields", F.lit(k))

    def listed(*keys: str):
        c = F.coalesce(*map(get, keys))
        return F.coalesce(F.when(c.startswith("["), F.from_json(c, "array<string>")), F.when(c.isNotNull(), F.array(c)), F.array().cast("array<string>"))

    return rows.select("provider_id", F.coalesce("c.url", F.lit("")).alias("url"), "pos", get("practice_name").alias("practice_name"), listed("provider_names", "provider_name").alias("provider_names"), listed("npi", "npis").alias("npis"), get("phone").alias("phone"), get("address").alias("address"), get("page_text").alias("page_text"))
