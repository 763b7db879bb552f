"""Readers of cases, trails, snapshots and geocodes, reviewer rows, and the command line."""

import json

import pytest

from accordion.__main__ import main
from accordion.operators import audit, matching
from accordion.sources import readers

CASES = {
    "directory": [{"provider_id": "A", "provider_name": "Jane Smith, MD", "npi": "1234567893", "practice_name": "P", "address": "1 Elm St, Albany, NY 12207", "phone": "518-555-1234", "active": True}],
    "truth": {"A": {"changes": {"phone": "518-555-9999", "address": "2 Oak St, Albany, NY 12207"}, "expected_action": "auto_update"}, "B": {"changes": {}, "expected_action": "no_change"}},
}


def test_cases(spark, tmp_path):
    (tmp_path / "c.json").write_text(json.dumps(CASES))
    got = readers.cases(spark, str(tmp_path / "c.json"))
    assert [r["provider_id"] for r in got["directory"].collect()] == ["A"]
    assert sorted(map(tuple, got["truth"].collect())) == [("A", "address", "2 Oak St, Albany, NY 12207"), ("A", "phone", "518-555-9999")]
    assert sorted(map(tuple, got["expected"].collect())) == [("A", "auto_update"), ("B", "no_change")]
    (tmp_path / "d.json").write_text(json.dumps({"truth": {}}))
    assert all(t.count() == 0 for t in readers.cases(spark, str(tmp_path / "d.json")).values())


def test_decisions_are_appended_and_read(spark, tmp_path):
    at = str(tmp_path / "decisions")
    for who, what in (("A", "approve"), ("B", "reject")):
        audit.append(audit.reviewed(spark, who, what, ["phone"], "n", "r", "2026-01-02 03:04:05"), at)
    got = sorted(map(tuple, readers.decisions(spark, at).select("provider_id", "decision", "fields", "note", "reviewer").collect()))
    assert got == [("A", "approve", ["phone"], "n", "r"), ("B", "reject", ["phone"], "n", "r")]


def test_snapshots_read_files_in_order(spark, tmp_path):
    head = "NPI,Entity Type Code,Provider First Line Business Practice Location Address,Provider Business Practice Location Address City Name,Provider Business Practice Location Address State Name,Provider Business Practice Location Address Postal Code,Provider Business Practice Location Address Telephone Number,NPI Deactivation Date,Provider First Name,Provider Last Name (Legal Name),Provider Organization Name (Legal Business Name)"
    line = lambda npi, phone: f"{npi},1,1 Elm St,Albany,NY,122070000,{phone},,Jane,Smith,"
    (tmp_path / "b.csv").write_text("\n".join([head, line("1", "new"), line("3", "c")]) + "\n")
    (tmp_path / "a.csv").write_text("\n".join([head, line("1", "old"), line("", "none"), line("2", "x"), line("2", "y"), *[line(f"9{i}", "z") for i in range(500)]]) + "\n")
    got = {r["npi"]: r for r in readers.snapshot(spark, str(tmp_path)).collect()}
    assert len(got) == 503 and (got["1"]["phone"], got["2"]["phone"], got["1"]["address"]) == ("new", "y", "1 Elm St, Albany, NY 12207")
    few = {r["npi"]: r["phone"] for r in readers.snapshot(spark, str(tmp_path), limit=3).collect()}
    assert few == {"1": "old", "2": "x"}


def test_geocodes(spark):
    records = spark.createDataFrame([("A", "1 Elm Street, Albany, NY 12207"), ("B", ""), ("C", "nowhere")], "provider_id string, address string")
    echo = {r["provider_id"]: (r["matched"], r["canonical"], r["lat"]) for r in readers.geocoded(records).collect()}
    assert echo["A"] == (True, "1 ELM ST, ALBANY, NY 12207", None) and echo["B"][:2] == (False, None) and echo["C"][0]
    answers = spark.createDataFrame([("1 Elm Street, Albany, NY 12207", "1 ELM ST, ALBANY, NY, 12207", 42.6, -73.7)], "address string, matched_address string, lat double, lon double")
    got = {r["provider_id"]: (r["matched"], r["lat"]) for r in readers.geocoded(records, answers).collect()}
    assert got == {"A": (True, 42.6), "B": (False, None), "C": (False, None)}


def test_pairs_of_a_hot_block_are_made_once(spark):
    rows = [(str(i), "1234567893" if i % 2 else None, "Jane Smith", "1 Elm St, Albany, NY 12207", "518-555-1234") for i in range(40)]
    pairs = matching.candidate_pairs(matching.block_keys(spark.createDataFrame(rows, "provider_id string, npi string, provider_name string, address string, phone string")))
    assert pairs.count() == pairs.select("provider_id_a", "provider_id_b").distinct().count() == 40 * 39 // 2
    assert {"name_g_a", "place_g_b", "phone_a"} <= set(pairs.columns)


def test_commands(spark, tmp_path, capsys):
    assert main(["backtest", "--scale", "40", "--as-of", "2026-06-13"]) == 0
    report = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert report["records"] == 40 and report["routing_accuracy"] == 1.0 and "brier" in report and "ece" in report
    assert main(["demo", "--records", "20", "--as-of", "2026-06-13", "--audit", str(tmp_path / "trail"), "--output", str(tmp_path / "out")]) == 0
    events = readers.trail(spark, str(tmp_path / "trail"))
    assert events.select("provider_id").distinct().count() == 20 and events.where("decision is null").count() == 0
    assert main(["backtest", "--as-of", "2026-06-13"]) == 2
    lines = tmp_path / "dir.jsonl"
    lines.write_text("\n".join(json.dumps({**CASES["directory"][0], "provider_id": str(i)}) for i in range(3)))
    assert main(["duplicates", "--directory", str(lines), "--lines"]) == 0
    assert json.loads(capsys.readouterr().out.strip().splitlines()[-1])["provider_ids"] == ["0", "1", "2"]


def test_discover_site_command(spark, tmp_path, capsys):
    one = CASES["directory"][0]
    (tmp_path / "dir.json").write_text(json.dumps([one]))
    registry = {"result_count": 1, "results": [{"number": one["npi"], "enumeration_type": "NPI-1", "basic": {"first_name": "JANE", "last_name": "SMITH", "status": "A"}, "taxonomies": [], "addresses": []}]}
    (tmp_path / "r.json").write_text(json.dumps(registry))
    (tmp_path / "c.json").write_text(json.dumps({"results": [{"NPI": one["npi"], "Facility Name": "P", "adr_ln_1": "1 Elm St", "City/Town": "Albany", "State": "NY", "ZIP Code": "12207", "Telephone Number": "5185551234"}]}))
    (tmp_path / "s.json").write_text(json.dumps({"provider_id": "A", "candidates": [{"url": "https://p.example.com", "fields": {"practice_name": "P", "phone": "518-555-1234", "address": one["address"], "npi": one["npi"], "provider_names": ["Jane Smith"]}}]}))
    args = ["discover-site", *(x for n in (("directory", "dir"), ("registry", "r"), ("claims", "c"), ("candidates", "s")) for x in (f"--{n[0]}", str(tmp_path / f"{n[1]}.json")))]
    assert main([*args, "--record", "A"]) == 0
    site = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert site["url"] == "https://p.example.com" and site["status"] == "verified_official_site" and pytest.approx(site["score"]) == 0.98
    assert main([*args, "--record", "Z"]) == 2
