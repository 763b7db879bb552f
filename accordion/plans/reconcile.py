"""The whole reconciliation of a directory as joins and aggregates over whole tables."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accordion.functions import normalize
from accordion.functions.numbers import exact_round
from accordion.operators import audit, decide, discovery, resolve, scoring
from accordion.plans.policy import Policy
from accordion.plans.store import written
from accordion.sources import readers

ASSERTED = ["provider_id", "field", "value", "raw_value", "source_name", "source_label", "source_class", "url", "data_as_of", "snapshot_hash", "_src_ord"]


@dataclass(frozen=True)
class Inputs:
    """Any DataFrames of these schemas; None where there is no such source."""

    directory: DataFrame
    registry: DataFrame
    claims: DataFrame
    web: DataFrame
    candidates: DataFrame | None = None
    specialties: DataFrame | None = None


@dataclass(frozen=True)
class Result:
    resolved: DataFrame
    assertions: DataFrame
    assessments: DataFrame
    recommendations: DataFrame
    signals: DataFrame
    events: DataFrame


def current_values(records: DataFrame, specialties: DataFrame | None = None) -> DataFrame:
    """provider_id, field, cur (canonical), raw_cur, _field_ord: records as long rows."""
    if specialties is not None:
        first = specialties.groupBy(F.lower("specialty").alias("label")).agg(F.min("code").alias("code"))
        records = records.join(first, F.lower(F.trim(records["specialty"])) == F.col("label"), "left")
    else:
        records = records.withColumn("code", F.lit(None).cast("string"))
    state = F.when(F.col("active").isNotNull(), F.when(F.col("active"), "Active").otherwise("Inactive"))
    given = {"provider_name": "provider_name", "specialty": "specialty", "address": "address", "phone": "phone", "active": None, "practice_name": "practice_name", "website": "website"}
    one = lambda i, f, c: F.struct(F.lit(i).alias("_field_ord"), F.lit(f).alias("field"), (state if c is None else F.col(c)).alias("raw_cur"))
    rows = records.select("provider_id", "code", F.explode(F.array(*[one(i, f, c) for i, (f, c) in enumerate(given.items())])).alias("x")).select("provider_id", "code", "x.*")
    return rows.select("provider_id", "field", F.when(F.col("field") == "specialty", F.col("code")).otherwise(normalize.of_field(F.col("field"), F.col("raw_cur"))).alias("cur"), "raw_cur", "_field_ord")


def one_each(rows: DataFrame) -> DataFrame:
    """The first row (by ``_ord``) of each npi; a source that says a thing twice is still
    one source."""
    order = F.struct("_ord", F.to_json(F.struct(*[c for c in rows.columns if c != "_ord"]))) if "_ord" in rows.columns else F.to_json(F.struct(*rows.columns))
    return rows.groupBy("npi").agg(F.min_by(F.struct(*rows.columns), order).alias("r")).select("r.*")


def harvest(records: DataFrame, inputs: Inputs) -> DataFrame:
    """All that the sources assert, in the order registry, claims, web. Sites are looked
    for only where no extraction of the record's site is at hand."""
    own = records.select("provider_id", "npi")
    shape = lambda rows, base: rows.withColumn("_src_ord", F.lit(base) + F.col("_pos")).withColumns({c: F.lit(None).cast("string") for c in ("url", "snapshot_hash") if c not in rows.columns}).select(*ASSERTED)
    rows = shape(own.join(readers.registry_assertions(inputs.registry), "npi"), 0)
    rows = rows.unionByName(shape(own.join(readers.claims_assertions(inputs.claims), "npi"), 1000))
    found = readers.web_assertions(inputs.web).join(own.select("provider_id"), "provider_id", "left_semi")
    rows = rows.unionByName(shape(found, 2000))
    if inputs.candidates is not None:
        unseen = records.join(inputs.web.select("provider_id"), "provider_id", "left_anti")
        sites = discovery.best_site(discovery.score(inputs.candidates, discovery.targets(clues(unseen, inputs))))
        more = discovery.to_assertions(sites).withColumns({"data_as_of": F.lit(None).cast("date"), "_pos": F.lit(0)})
        rows = rows.unionByName(shape(more, 3000))
    return rows


def clues(records: DataFrame, inputs: Inputs) -> DataFrame:
    """What a site may be held against: the record's own, the registry's and the claims'."""
    shown = F.concat_ws(", ", "address_1", "city", F.concat_ws(" ", "state", normalize.zip_display(F.col("postal_code"))))
    reg = inputs.registry.select("npi", F.when(F.col("is_organization"), F.col("organization_name")).alias("g_org"), F.when(~F.col("is_organization"), F.concat_ws(" ", "first_name", "last_name")).alias("g_name"), F.col("telephone").alias("g_phone"), shown.alias("g_address"), F.lit(True).alias("known"))
    cla = inputs.claims.select("npi", F.col("practice_name").alias("c_org"), F.col("phone").alias("c_phone"), shown.alias("c_address"))
    rows = records.join(reg, "npi", "left").join(cla, "npi", "left")
    return rows.select(
        "provider_id", F.array("practice_name", "c_org", "g_org").alias("practices"), F.array("provider_name", "g_name").alias("names"), F.array("npi").alias("npis"),
        F.array("phone", "g_phone", "c_phone").alias("phones"), F.array("address", "g_address", "c_address").alias("addresses"), F.array("provider_name", "practice_name").alias("mentions"),
    )


def reconcile(inputs: Inputs, policy: Policy, at=None) -> Result:
    # Each step's table is kept: later steps read it more than once.
    inputs = replace(inputs, registry=written(one_each(inputs.registry)), claims=written(one_each(inputs.claims)))
    resolved = written(resolve.resolve(inputs.directory, inputs.registry))
    records = inputs.directory.withColumnRenamed("npi", "given_npi").join(resolved.select("provider_id", "status", F.col("npi").alias("found"), "agreement", "note", "usable"), "provider_id")
    records = records.withColumn("npi", F.coalesce("found", "given_npi"))
    good = records.where("usable")
    assertions = written(harvest(good, inputs))
    assessments = written(scoring.assess(assertions, current_values(good, inputs.specialties), policy))
    decided = written(decide.decide(assessments, policy, good))
    notes = good.select("provider_id", F.when(F.col("status").isin("resolved_by_search", "bad_checkdigit"), F.concat("note", F.lit(" "))).alias("before"))
    decided = decided.join(notes, "provider_id").withColumn("reason", F.concat(F.coalesce("before", F.lit("")), F.col("reason"))).drop("before")
    held = records.where("not usable").select(
        "provider_id", F.col("given_npi").alias("npi"), F.lit(False).alias("change_detected"), F.array().cast(decided.schema["changes"].dataType).alias("changes"),
        exact_round(F.col("agreement"), 4).alias("overall_confidence"), F.lit("human_review").alias("recommended_action"), F.col("note").alias("reason"),
    )
    recommendations = decided.unionByName(held)
    sources = audit.evidence(scoring.weighted(assertions, policy), assessments)
    return Result(resolved, assertions, assessments, recommendations, decide.signals(decided, good), audit.events(recommendations, assessments, sources, at=at))
