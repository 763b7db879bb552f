"""The engine on small records worked out by hand."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from accordion.functions import normalize, numbers, similarity
from accordion.operators import audit, backtest, decide, discovery, matching, resolve, scoring, triage
from accordion.plans.policy import Policy
from accordion.sources import readers, synth
from accordion.streaming import incremental

AS_OF = date(2026, 6, 13)
POLICY = Policy(as_of=AS_OF)
ASSERTED = "provider_id string, field string, value string, raw_value string, source_label string, source_class string, data_as_of date, _src_ord int"
HELD = "provider_id string, field string, cur string, raw_cur string, _field_ord int"


def one(spark, expression, **values):
    row = spark.createDataFrame([tuple(values.values())], list(values)) if values else spark.range(1)
    return row.select(expression.alias("x")).first()["x"]


def assessed(spark, rows, held):
    a = spark.createDataFrame([("r", f, v, v and f"raw {v}", s, c, d, i) for i, (f, v, s, c, d) in enumerate(rows)], ASSERTED)
    return scoring.assess(a, spark.createDataFrame([("r", f, v, v, i) for i, (f, v) in enumerate(held)], HELD), POLICY)


def test_two_independent_sources_agree(spark):
    rows = [("address", "NEW", "A", "gov_self_reported", None), ("address", "NEW", "B", "practice_web", None)]
    got = assessed(spark, rows, [("address", "OLD")]).first()
    assert got["changed"] and not got["conflict"] and got["corroborating_classes"] == 2
    assert got["confidence"] == round(1 - (1 - 0.66) * (1 - 0.68), 4)
    assert got["supporting_sources"] == ["B", "A"] and got["raw_proposed"] == "raw NEW"


def test_one_class_counts_half_again(spark):
    rows = [("phone", "N", "A", "practice_web", None), ("phone", "N", "B", "practice_web", None)]
    got = assessed(spark, rows, [("phone", "N")]).first()
    assert got["confidence"] == round(1 - (1 - 0.66) * (1 - 0.33), 4) and not got["changed"] and got["corroborating_classes"] == 1


def test_conflict_and_dissent(spark):
    rows = [("active", "active", "A", "gov_self_reported", None), ("active", "inactive", "B", "regulatory_board", None)]
    got = assessed(spark, rows, [("active", "active")]).first()
    assert got["conflict"] and got["dissent"] and got["dissent_value"] == "inactive" and not got["changed"]
    decided = decide.decide(assessed(spark, rows, [("active", "active")]), POLICY).first()
    assert decided["recommended_action"] == "human_review" and "active='inactive'" in decided["reason"]


def test_same_class_values_never_conflict_and_shares_exceed_one(spark):
    rows = [("phone", "X", "A", "practice_web", None), ("phone", "Y", "B", "practice_web", None)]
    got = assessed(spark, rows, []).first()
    assert not got["conflict"] and got["proposed_value"] == "X" and got["confidence"] == round(0.66 * 0.66 / 0.99, 4)


def test_no_values_no_row_and_old_sources_fade(spark):
    assert assessed(spark, [("phone", None, "A", "practice_web", None)], []).count() == 0
    fade = one(spark, POLICY.freshness_of(F.lit(date(2024, 12, 20)).cast("date")))
    assert abs(fade - 0.5) < 1e-9 and one(spark, POLICY.freshness_of(F.lit(date(1990, 1, 1)))) == 0.3


@pytest.mark.parametrize(
    "rows, held, action",
    [
        ([("phone", "N", "A", "gov_self_reported", None), ("phone", "N", "B", "practice_web", None)], "O", "auto_update"),
        ([("phone", "N", "A", "gov_self_reported", None)], "O", "human_review"),
        ([("website", "N", "A", "gov_self_reported", None)], "O", "discard"),
        ([("phone", "N", "A", "gov_self_reported", None)], "N", "no_change"),
        ([("npi", "N", "A", "gov_self_reported", None), ("npi", "N", "B", "gov_claims", None)], "O", "human_review"),
        ([("provider_name", "N", "A", "gov_self_reported", None), ("provider_name", "N", "B", "gov_claims", None)], "O", "human_review"),
    ],
)
def test_ladder(spark, rows, held, action):
    assert decide.decide(assessed(spark, rows, [(rows[0][0], held)]), POLICY).first()["recommended_action"] == action


def test_records_without_assessments_are_confirmed(spark):
    a = assessed(spark, [("phone", "N", "A", "practice_web", None)], [])
    got = decide.decide(a.where("false"), POLICY, spark.createDataFrame([("z", None)], "provider_id string, npi string")).first()
    assert (got["recommended_action"], got["overall_confidence"]) == ("no_change", 1.0)


@pytest.mark.parametrize("value, digits, wanted", [(0.995, 2, 0.99), (0.285, 2, 0.28), (2.675, 2, 2.67), (0.125, 2, 0.12), (0.375, 2, 0.38), (0.58265, 4, round(0.58265, 4))])
def test_exact_round(spark, value, digits, wanted):
    assert one(spark, numbers.exact_round(F.lit(value), digits)) == wanted


@pytest.mark.parametrize("raw, wanted", [("(239) 555-0100", "+12395550100"), ("1-239-555-0100 ext. 12", "+12395550100"), ("555-12", None), ("", None), (None, None)])
def test_phone(spark, raw, wanted):
    assert one(spark, normalize.phone(F.lit(raw).cast("string"))) == wanted


def test_address(spark):
    a = one(spark, normalize.address(F.lit("100 North Main Street Suite 4, Naples, FL 34102-1234")))
    assert (a["canonical"], a["suite"]) == ("100 N MAIN ST, NAPLES, FL 34102", "STE 4")
    assert one(spark, normalize.address(F.lit("somewhere")))["canonical"] == "SOMEWHERE"
    assert one(spark, normalize.address(F.lit("  ")))["canonical"] is None
    assert one(spark, normalize.address(F.lit("1 Main St Suite #2, Naples, FL")))["suite"] is None


@pytest.mark.parametrize("raw, wanted", [("Jane Q. Doe, MD", "DOE|JANE"), ("Jane Doe M.D. Ph.D.", "DOE|JANE"), ("Cher", "|CHER"), ("MD", None), ("John Doe Jr", "JR|JOHN"), ("", None)])
def test_name(spark, raw, wanted):
    assert one(spark, normalize.name(F.lit(raw)))["canonical"] == wanted


def test_small_canonical_forms(spark):
    assert one(spark, normalize.practice_name(F.lit("Gulf Heart Group, P.A., LLC"))) == "GULF HEART P A"
    assert one(spark, normalize.active(F.lit(True))) == "active" and one(spark, normalize.active(F.lit("Retired"))) == "inactive"
    assert one(spark, normalize.zip_display(F.lit("341020000"))) == "34102" and one(spark, normalize.zip_display(F.lit("341021234"))) == "34102-1234"
    assert one(spark, normalize.domain(F.lit("WWW.Site.org:80/x?y"))) == "site.org:80"
    assert one(spark, normalize.source_date(F.lit("04/18/2026 x"))) == date(2026, 4, 18) and one(spark, normalize.source_date(F.lit("soon"))) is None
    assert not one(spark, normalize.valid_npi(F.lit("1234567890"))) and one(spark, normalize.valid_npi(F.lit("1234567893")))


def test_similarity(spark):
    assert one(spark, similarity.soundex(F.lit("Robert"))) == one(spark, similarity.soundex(F.lit("Rupert"))) == "R163"
    assert one(spark, similarity.soundex(F.lit("1 "))) == ""
    assert round(one(spark, similarity.trigram_similarity(F.lit("SMITH|JOHN"), F.lit("SMITH|JON"))), 4) == 0.6154
    assert 40 < one(spark, similarity.haversine_km(F.lit(26.142), F.lit(-81.795), F.lit(26.64), F.lit(-81.87))) < 70
    assert one(spark, similarity.site_similarity(F.lit(0.1))) == 1.0 and one(spark, similarity.site_similarity(F.lit(None).cast("double"))) is None


RECORDS = "provider_id string, provider_name string, npi string, practice_name string, address string, phone string"


def test_resolve_statuses(spark):
    registry = spark.createDataFrame(
        [("1234567893", "Jane", "Doe", None, "Jane Doe", 0), ("1234567890", "Ann", "Lee", None, "Ann Lee", 1), ("1111111112", "Al", "Poe", None, "Al Poe", 2), ("2222222222", "Al", "Poe", None, "Al Poe", 3), ("3333333333", None, None, "Gulf Heart", "Gulf Heart", 4)],
        "npi string, first_name string, last_name string, organization_name string, display_name string, _ord long",
    )
    rows = [("a", "Jane Doe, MD", "1234567893", None), ("b", "Ann Lee", "1234567890", None), ("c", "Bob Ray", "1234567893", None), ("d", "Ann Lee", "9", None), ("e", "Jane Doe", None, None), ("f", "Al Poe", " ", None), ("g", None, None, "Gulf Heart"), ("h", "No Body", None, None)]
    directory = spark.createDataFrame([(p, n, i, o, None, None) for p, n, i, o in rows], RECORDS)
    got = {r["provider_id"]: (r["status"], r["npi"], r["agreement"]) for r in resolve.resolve(directory, registry).collect()}
    assert got == {
        "a": ("validated", "1234567893", 1.0), "b": ("bad_checkdigit", "1234567890", 1.0), "c": ("mismatch", "1234567893", 0.0), "d": ("unresolved", "9", 0.0),
        "e": ("resolved_by_search", "1234567893", 1.0), "f": ("unresolved", None, 1.0), "g": ("resolved_by_search", "3333333333", 0.8), "h": ("unresolved", None, 0.0),
    }


def test_duplicates(spark):
    rows = [
        ("1", "John Smith", "123", None, "1 Main St, Naples, FL 34102", "239-555-0100"), ("2", "Jon Smith MD", None, None, "1 Main Street, Naples, FL 34102", "(239) 555-0100"),
        ("3", "Zed Young", "123", None, "9 Bay Rd, Estero, FL 33928", None), ("4", "Amy Ng", None, None, None, None), ("5", None, None, "Org", "1 Main St, Naples, FL 34102", None),
    ]
    got = matching.clusters(spark.createDataFrame(rows, RECORDS)).collect()
    assert [r["provider_ids"] for r in got] == [["1", "3"]] and got[0]["match_score"] == 1.0 and got[0]["reason"] == "identical NPI 123"
    near = spark.createDataFrame([("1", 26.1, -81.7), ("2", 26.1, -81.7)], "provider_id string, lat double, lon double")
    pairs = matching.scored_pairs(matching.candidate_pairs(matching.block_keys(spark.createDataFrame(rows, RECORDS))), near)
    assert "geo=1.00" in {r["reason"].split(", ")[1] for r in pairs.where("provider_id_a = '1' and provider_id_b = '2'").collect()}


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(f"{i:03d}", f"{i + 1:03d}") for i in range(60)] + [("x", "y")], "a string, b string")
    got = {r["node"]: r["component"] for r in matching.connected_components(edges).collect()}
    assert set(got.values()) == {"000", "x"} and len(got) == 63


def test_site_choice(spark):
    held = discovery.targets(spark.createDataFrame([("r", ["Gulf Heart, LLC"], ["Jane Doe"], ["1"], ["239-555-0100"], [None], ["Jane Doe"])], "provider_id string, practices array<string>, names array<string>, npis array<string>, phones array<string>, addresses array<string>, mentions array<string>"))
    cands = spark.createDataFrame(
        [("r", "https://www.yelp.com/x", 0, "Gulf Heart", ["Jane Doe, MD"], ["1"], "239-555-0100", None, "jane doe!"), ("r", "gulfheart.com", 1, "Gulf Heart", ["Jane Doe"], ["1"], "2395550100", None, "about Jane  Doe"), ("r", "", 2, None, [], [], None, None, None)],
        "provider_id string, url string, pos int, practice_name string, provider_names array<string>, npis array<string>, phone string, address string, page_text string",
    )
    best = discovery.best_site(discovery.score(cands, held)).first()
    assert (best["pos"], best["score"], best["status"]) == (1, 0.85, "verified_official_site")
    assert {r["field"] for r in discovery.to_assertions(discovery.best_site(discovery.score(cands, held))).collect()} == {"phone", "practice_name"}


def test_triage(spark):
    rows = spark.createDataFrame([("a", "1", date(2026, 6, 1)), ("b", None, None), ("c", "1", date(2020, 1, 1))], "provider_id string, phone string, last_verified_date date")
    got = [r["provider_id"] for r in triage.verify_queue(triage.risk(rows, AS_OF)).collect()]
    assert got[-1] == "a" and triage.risk(rows.where("provider_id = 'b'"), AS_OF).first()["reasons"] == ["never verified"]


def test_audit_round_trip(spark, tmp_path):
    rows = [("phone", "N", "A", "gov_self_reported", None)]
    a = assessed(spark, rows, [("phone", "O")])
    events = audit.events(decide.decide(a, POLICY), a, at="2026-06-13 00:00:00")
    for _ in range(2):
        audit.append(events, str(tmp_path / "trail"))
    back = spark.read.schema(events.schema).json(str(tmp_path / "trail"))
    assert back.count() == 2 and audit.review_queue(back).count() == 1
    assert audit.review_queue(back, back).count() == 0
    assert audit.review_counts(back, back).first().asDict() == {"queue": 1, "reviewed": 1, "pending": 0}


def test_backtest_empty_ratios_and_bins(spark):
    a = assessed(spark, [("phone", "N", "A", "gov_self_reported", None)], [("phone", "N")])
    none = spark.createDataFrame([], "provider_id string, field string, value string")
    got = backtest.report(decide.decide(a, POLICY), none, spark.createDataFrame([("r", "no_change")], "provider_id string, expected_action string")).first()
    assert got["recall"] == got["auto_update_precision"] == got["routing_accuracy"] == 1.0
    samples = spark.createDataFrame([(1.0, True), (0.0, False), (0.5, True)], "confidence double, right boolean")
    assert [r["n"] for r in backtest.calibration(samples).orderBy("lo").collect()] == [1, 0, 1, 0, 1]
    assert backtest.brier(samples).first()[0] == round(0.25 / 3, 4)


def test_readers(spark, tmp_path):
    (tmp_path / "d.json").write_text('{"description": "x", "records": [{"provider_id": "p", "npi": "1", "active": true, "last_verified_date": "2026-01-02", "more": 1}]}')
    got = readers.directory(spark, str(tmp_path / "d.json")).first()
    assert (got["provider_id"], got["active"], got["last_verified_date"], got["_ord"]) == ("p", True, date(2026, 1, 2), 0)
    (tmp_path / "l.json").write_text('[{"provider_id": "q"}]')
    assert readers.directory(spark, str(tmp_path / "l.json")).first()["provider_id"] == "q"
    (tmp_path / "n.json").write_text(
        '{"result_count": 1, "results": [{"number": "1", "enumeration_type": "NPI-1", "basic": {"first_name": "JANE", "last_name": "DOE", "credential": "MD", "status": "A"}, "taxonomies": [{"code": "a", "desc": "A", "primary": false}, {"code": "207RC0000X", "desc": "Cardiology", "primary": true}],'
        ' "addresses": [{"address_purpose": "MAILING", "address_1": "no"}, {"address_purpose": "LOCATION", "address_1": "1 Main Street", "city": "Naples", "state": "FL", "postal_code": "341021234", "telephone_number": "239-555-0100"}]}]}'
    )
    rows = {r["field"]: r["value"] for r in readers.registry_assertions(readers.registry(spark, str(tmp_path / "n.json"))).collect()}
    assert rows == {"provider_name": "DOE|JANE", "specialty": "207RC0000X", "active": "active", "address": "1 MAIN ST, NAPLES, FL 34102", "phone": "+12395550100"}
    claims = spark.createDataFrame([("1", "Gulf Heart", " ", "x", 0), ("1", "Other", "2", "y", 1)], "NPI string, `Facility Name` string, `Telephone Number` string, phn_numbr string, _ord int")
    assert {(r["field"], r["value"]) for r in readers.claims_assertions(readers.claims(claims)).collect()} == {("practice_name", "GULF HEART")}
    web = spark.createDataFrame([("p", [("w", "W", "practice_web", "u", '{"phone": {"value": "239-555-0100", "note": "n"}, "active": "no"}')])], readers.WEB)
    assert {(r["field"], r["value"]) for r in readers.web_assertions(web).collect()} == {("phone", "+12395550100"), ("active", "inactive")}
    (tmp_path / "t.csv").write_text("code,specialty\n207rc0000x,Heart\n")
    assert readers.specialties(spark, str(tmp_path / "t.csv")).where("code = '207RC0000X'").first()["specialty"] == "Heart"
    header = "NPI,Entity Type Code,Provider First Line Business Practice Location Address,Provider Business Practice Location Address City Name,Provider Business Practice Location Address State Name,Provider Business Practice Location Address Postal Code,Provider Business Practice Location Address Telephone Number,NPI Deactivation Date,Provider First Name,Provider Last Name (Legal Name),Provider Organization Name (Legal Business Name)"
    (tmp_path / "s.csv").write_text(f"{header}\n1,1,1 Main St,Naples,FL,341021234,2395550100,,Jane,Doe,\n1,1,2 Main St,Naples,FL,341021234,2395550100,01/01/2026,Jane,Doe,\n")
    got = readers.snapshot(spark, str(tmp_path / "s.csv")).collect()
    assert [(r["address"], r["status"]) for r in got] == [("2 Main St, Naples, FL 34102", "I")]


def test_generator_is_fixed_by_its_seed(spark):
    a, b = (synth.generate(spark, 500, seed).orderBy("provider_id").collect() for seed in (0, 0))
    assert a == b and a != synth.generate(spark, 500, 1).orderBy("provider_id").collect()
    shares = {r["scenario"]: r["count"] / 500 for r in synth.generate(spark, 500, 0).groupBy("scenario").count().collect()}
    assert abs(shares["no_change"] - 0.5) < 0.08 and len(shares) == 5


def test_stream(spark, tmp_path):
    source = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    source.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(source.schema).parquet(str(tmp_path / "in"))
    query = incremental.windowed_counts(stream).writeStream.outputMode("complete").format("memory").queryName("counts").start()
    query.processAllAvailable()
    query.stop()
    assert spark.sql("select sum(n) from counts").first()[0] == source.count()
    query = incremental.each_batch(stream.select("event_id"), lambda rows: rows, str(tmp_path / "out"), str(tmp_path / "check"))
    query.processAllAvailable()
    query.stop()
    assert spark.read.json(str(tmp_path / "out")).count() == source.count()
