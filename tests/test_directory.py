"""Six records through the whole engine, against results worked out by hand."""

import json
from datetime import date

import pytest

from accordion import __main__ as cli
from accordion.operators import audit, backtest, discovery, matching, triage
from accordion.plans.policy import Policy
from accordion.plans.reconcile import Inputs, clues, reconcile
from accordion.sources import readers

AS_OF = date(2026, 6, 13)
# The six records and what their sources say.
PEOPLE = [
    ("HL_001", "John Smith, MD", "1234567890", "Cardiology", "ABC Heart Group", "100 Main St, Naples, FL 34102", "239-555-1234", "2023-09-01"),
    ("HL_002", "Jane A Doe, NP", None, "Family Medicine", "Gulf Coast Family Care", "300 1st St, Fort Myers, FL 33901", "239-555-2000", "2022-05-15"),
    ("HL_003", "John Smith M.D.", "1234567890", "Cardiology", "ABC Heart Group", "100 Main Street, Suite 2, Naples, FL 34102", "239-555-1234", "2023-09-01"),
    ("HL_004", "Robert Lee, MD", "1555666779", "Pediatrics", "Sunset Pediatrics", "75 Pine Ave, Naples, FL 34102", "239-555-3000", "2021-01-10"),
    ("HL_005", "Maria Garcia, MD", "1938475609", "Internal Medicine", "Bayfront Internal Medicine", "900 Bay Rd, Naples, FL 34103", "239-555-4000", "2026-03-01"),
    ("HL_006", None, "1003004003", None, "Gulf Coast Women's Health", "850 6th Ave N, Naples, FL 34102", "239-555-6000", "2022-11-01"),
]
ENTRIES = [
    ("1002003006", "JANE", "DOE", "N.P.", "A", "207Q00000X", "Family Medicine", "501 HEALTHPARK BLVD", "FORT MYERS", "33908", "239-555-7777"),
    ("1234567890", "JOHN", "SMITH", "M.D.", "A", "207RC0000X", "Cardiology", "100 MAIN ST", "NAPLES", "341020000", "239-555-9000"),
    ("1555666779", "ROBERT", "LEE", "M.D.", "I", "208000000X", "Pediatrics", "75 PINE AVE", "NAPLES", "34102", "239-555-3000"),
    ("1938475609", "MARIA", "GARCIA", "M.D.", "A", "207R00000X", "Internal Medicine", "900 BAY RD", "NAPLES", "34103", "239-555-4000"),
]
CLAIMS = [
    ("1002003006", "Gulf Coast Family Care", "501 Healthpark Blvd", "Fort Myers", "33908", "239-555-7777", None),
    ("1003004003", "Gulf Coast Women's Health", "3300 Pine Ridge Rd", "Naples", "34109", "239-555-6100", "2026-04-01"),
    ("1234567890", "ABC Heart Group", "250 Health Park Dr", "Fort Myers", "33908", "", None),
    ("1938475609", "Bayfront Internal Medicine", "900 Bay Rd", "Naples", "34103", "239-555-4000", None),
]
SITES = {
    "HL_001": ("239-555-9000", "250 Health Park Dr, Fort Myers, FL 33908"),
    "HL_002": ("239-555-7777", "501 Healthpark Blvd, Fort Myers, FL 33908"),
    "HL_003": ("239-555-9000", "250 Health Park Dr, Fort Myers, FL 33908"),
    "HL_006": ("239-555-6100", "3300 Pine Ridge Rd, Naples, FL 34109"),
}
CANDIDATES = {
    "HL_001": [
        ("https://www.healthgrades.com/physician/dr-john-smith", "ABC Heart Group", ["John Smith, MD"], None, "250 Health Park Dr, Fort Myers, FL 33908", "239-555-9000", "John Smith MD cardiology ABC Heart Group"),
        ("https://abcheart.example.com", "ABC Heart Group", ["John Smith, MD"], "1234567890", "250 Health Park Dr, Fort Myers, FL 33908", "239-555-9000", "ABC Heart Group locations. John Smith MD. Fort Myers cardiology."),
        ("https://miamiorthopedics.example.com", "Miami Orthopedics", ["Jonathan Smythe, DO"], None, "1 Ocean Dr, Miami, FL 33139", "305-555-1000", "Orthopedics Miami"),
    ],
    "HL_005": [
        ("https://npiprofile.com/npi/1938475609", "Bayfront Internal Medicine", ["Maria Garcia, MD"], "1938475609", "900 Bay Rd, Naples, FL 34103", "239-555-4000", None),
        ("https://bayfrontinternal.example.com", "Bayfront Internal Medicine", ["Maria Garcia, MD"], None, "900 Bay Rd, Naples, FL 34103", "239-555-4000", "Bayfront Internal Medicine. Maria Garcia MD. Naples FL."),
    ],
}
WANTED = {
    "HL_001": ("human_review", 0.73, {"address": 0.58, "phone": 0.88}),
    "HL_002": ("auto_update", 0.96, {"address": 0.96, "phone": 0.96}),
    "HL_003": ("human_review", 0.73, {"address": 0.58, "phone": 0.88}),
    "HL_004": ("human_review", 0.99, {"active": 0.99}),
    "HL_005": ("no_change", 0.94, {}),
    "HL_006": ("auto_update", 0.94, {"address": 0.95, "phone": 0.94}),
}


@pytest.fixture(scope="module")
def files(tmp_path_factory):
    top = tmp_path_factory.mktemp("sources")
    names = ("provider_id", "provider_name", "npi", "specialty", "practice_name", "address", "phone", "last_verified_date")
    (top / "directory.json").write_text(json.dumps({"records": [dict(zip(names, p, strict=True)) | {"active": True} for p in PEOPLE]}))
    for d in ("registry", "claims", "web", "candidates"):
        (top / d).mkdir()
    for npi, first, last, cred, status, code, label, street, city, zip_, phone in ENTRIES:
        body = {"number": npi, "enumeration_type": "NPI-1", "basic": {"first_name": first, "last_name": last, "credential": cred, "status": status}, "taxonomies": [{"code": code, "desc": label, "primary": True, "state": "FL"}]}
        body["addresses"] = [{"address_purpose": "LOCATION", "address_1": street, "city": city, "state": "FL", "postal_code": zip_, "telephone_number": phone}]
        (top / f"registry/{npi}.json").write_text(json.dumps({"result_count": 1, "results": [body]}))
    firm = {"number": "1003004003", "enumeration_type": "NPI-2", "basic": {"organization_name": "GULF COAST WOMEN'S HEALTH", "status": "A", "last_updated": "2026-04-18"}, "taxonomies": [{"code": "207V00000X", "desc": "Obstetrics & Gynecology", "primary": True}]}
    firm["addresses"] = [{"address_purpose": "LOCATION", "address_1": "3300 PINE RIDGE RD", "city": "NAPLES", "state": "FL", "postal_code": "341090000", "telephone_number": "239-555-6100"}]
    (top / "registry/1003004003.json").write_text(json.dumps({"result_count": 1, "results": [firm]}))
    for npi, org, street, city, zip_, phone, day in CLAIMS:
        row = {"NPI": npi, "Facility Name": org, "adr_ln_1": street, "City/Town": city, "State": "FL", "ZIP Code": zip_, "Telephone Number": phone} | ({"Last Updated": day} if day else {})
        (top / f"claims/{npi}.json").write_text(json.dumps({"results": [row]}))
    for who, (phone, address) in SITES.items():
        site = {"source_name": "practice_web", "source_label": "Practice Website", "source_class": "practice_web", "url": "u", "fields": {"phone": {"value": phone}, "address": {"value": address}}}
        (top / f"web/{who}.json").write_text(json.dumps({"provider_id": who, "sources": [site]}))
    board = {"source_name": "state_board", "source_label": "State Medical Board", "source_class": "regulatory_board", "url": "u", "fields": {"active": {"value": "inactive", "note": "Expired"}}}
    (top / "web/HL_004.json").write_text(json.dumps({"provider_id": "HL_004", "sources": [board]}))
    keys = ("practice_name", "provider_names", "npi", "address", "phone", "page_text")
    for who, sites in CANDIDATES.items():
        listed = [{"url": u, "fields": {k: v for k, v in zip(keys, rest, strict=True) if v is not None}} for u, *rest in sites]
        (top / f"candidates/{who}.json").write_text(json.dumps({"provider_id": who, "candidates": listed}))
    return top


@pytest.fixture(scope="module")
def inputs(spark, files):
    from pyspark.sql import functions as F

    claims = spark.read.option("multiLine", True).json(f"{files}/claims").select(F.posexplode("results").alias("_ord", "r")).select("_ord", "r.*")
    return Inputs(
        readers.directory(spark, f"{files}/directory.json"), readers.registry(spark, f"{files}/registry"), readers.claims(claims),
        readers.web_files(spark, f"{files}/web"), readers.candidate_files(spark, f"{files}/candidates"), readers.specialties(spark),
    )


@pytest.fixture(scope="module")
def done(inputs):
    return reconcile(inputs, Policy(as_of=AS_OF), at="2026-06-13 00:00:00")


def test_recommendations(done):
    got = {r["provider_id"]: r for r in done.recommendations.collect()}
    for who, (action, overall, changes) in WANTED.items():
        r = got[who]
        assert (r["recommended_action"], r["overall_confidence"]) == (action, overall), who
        assert {c["field"]: c["confidence_score"] for c in r["changes"]} == changes, who
        assert r["change_detected"] == bool(changes)
    assert got["HL_002"]["npi"] == "1002003006" and got["HL_002"]["reason"].startswith("NPI 1002003006 recovered")
    assert got["HL_001"]["reason"].startswith("NPI 1234567890 fails its check digit")
    change = got["HL_004"]["changes"][0]
    assert (change["old_value"], change["new_value"]) == ("Active", "Deactivated")


def test_signals_and_trail(done):
    got = {r["provider_id"]: r["signals"] for r in done.signals.collect()}
    assert got["HL_002"][0].startswith("provider movement: 300 1st St") and got["HL_006"][0].startswith("practice relocation") and got["HL_004"] == ["provider inactive/retired"] and got["HL_005"] == []
    assert done.events.count() == 10 and done.events.where("decision = 'human_review'").count() == 5
    assert audit.review_queue(done.events).count() == 3
    assert done.events.where("field = 'phone' and provider_id = 'HL_002'").first()["sources"][0]["source_label"] == "NPPES"


def test_backtest(spark, done):
    truth = [("HL_001", "phone", "239-555-9000"), ("HL_001", "address", SITES["HL_001"][1]), ("HL_002", "phone", "239-555-7777"), ("HL_002", "address", SITES["HL_002"][1]), ("HL_003", "phone", "239-555-9000"), ("HL_003", "address", SITES["HL_003"][1]), ("HL_004", "active", "Inactive"), ("HL_006", "phone", "239-555-6100"), ("HL_006", "address", SITES["HL_006"][1])]
    expected = spark.createDataFrame([(k, v[0]) for k, v in WANTED.items()], "provider_id string, expected_action string")
    got = backtest.report(done.recommendations, spark.createDataFrame(truth, "provider_id string, field string, value string"), expected).first()
    assert (got["records"], got["true_changes"]) == (6, 9)
    assert got["recall"] == got["detection_precision"] == got["auto_update_precision"] == got["routing_accuracy"] == 1.0
    samples = backtest.judged(done.recommendations, spark.createDataFrame(truth, "provider_id string, field string, value string"))
    assert backtest.brier(samples).first()[0] <= 0.1


def test_duplicates_triage_sites(inputs):
    (cluster,) = matching.clusters(inputs.directory).collect()
    assert (cluster["provider_ids"], cluster["match_score"], cluster["reason"]) == (["HL_001", "HL_003"], 1.0, "identical NPI 1234567890")
    got = {r["provider_id"]: r["score"] for r in triage.risk(inputs.directory, AS_OF).collect()}
    assert got == {"HL_004": 0.6283, "HL_002": 0.5149, "HL_006": 0.4756, "HL_001": 0.4052, "HL_003": 0.4052, "HL_005": 0.1941}
    scored = discovery.score(inputs.candidates, discovery.targets(clues(inputs.directory, inputs)))
    assert {(r["provider_id"], r["pos"]): r["score"] for r in scored.collect()} == {("HL_001", 0): 0.5, ("HL_001", 1): 1.0, ("HL_001", 2): 0.05, ("HL_005", 0): 0.58, ("HL_005", 1): 0.9}


def test_command_line(files, capsys, tmp_path):
    paths = [x for k, v in {"--directory": "directory.json", "--registry": "registry", "--claims": "claims", "--web": "web"}.items() for x in (k, f"{files}/{v}")]
    assert cli.main(["run", *paths, "--as-of", "2026-06-13", "--record", "HL_002", "--audit", str(tmp_path / "trail")]) == 0
    assert json.loads(capsys.readouterr().out.strip())["recommended_action"] == "auto_update"
    assert cli.main(["run", *paths, "--as-of", "2026-06-13", "--record", "none"]) == 2
    assert cli.main(["triage", "--directory", f"{files}/directory.json", "--as-of", "2026-06-13"]) == 0
    assert json.loads(capsys.readouterr().out.split("\n")[0])["provider_id"] == "HL_004"
    assert cli.main(["duplicates", "--directory", f"{files}/directory.json"]) == 0
