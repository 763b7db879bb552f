"""Command line: reconcile a directory, rank it, find duplicates and sites, measure accuracy.

    python -m accordion run --directory D --registry R --claims C --web W --as-of 2026-06-13
    python -m accordion demo --records 1000 --as-of 2026-06-13
    python -m accordion triage --directory D --as-of 2026-06-13
    python -m accordion duplicates --directory D
    python -m accordion discover-site --directory D --registry R --claims C --candidates S --record ID
    python -m accordion backtest --cases J --registry R --claims C --web W --as-of 2026-06-13
    python -m accordion backtest --scale 5000 --as-of 2026-06-13
"""

from __future__ import annotations

import argparse
import sys
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from accordion.operators import backtest, discovery, matching, triage
from accordion.plans.policy import Policy
from accordion.plans.reconcile import Inputs, clues, reconcile
from accordion.plans.store import written
from accordion.sources import readers, synth

#: Commands and the options that each must have or may have.
COMMANDS = {
    "run": ("directory registry claims web as-of", "record audit candidates"),
    "demo": ("as-of", "records seed audit"),
    "triage": ("directory as-of", ""),
    "duplicates": ("directory", "geocodes"),
    "discover-site": ("directory registry claims candidates record", ""),
    "backtest": ("as-of", "cases registry claims web scale seed"),
}


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="accordion")
    commands = parser.add_subparsers(dest="command", required=True)
    kinds = {"as-of": date.fromisoformat, "records": int, "scale": int, "seed": int}
    for name, (needed, optional) in COMMANDS.items():
        one = commands.add_parser(name)
        for option in (*needed.split(), *optional.split()):
            one.add_argument(f"--{option}", required=option in needed.split(), type=kinds.get(option, str), default={"seed": 0, "records": 1000}.get(option))
        one.add_argument("--lines", action="store_true", help="the directory has a record a line")
        one.add_argument("--output", help="write JSON lines there instead of printing them")
    return parser


def _sources(spark: SparkSession, given, records: DataFrame) -> Inputs:
    claims = spark.read.option("multiLine", True).json(given.claims).select(F.posexplode("results").alias("_ord", "r")).select("_ord", "r.*")
    web = readers.web_files(spark, given.web) if getattr(given, "web", None) else spark.createDataFrame([], readers.WEB)
    candidates = readers.candidate_files(spark, given.candidates) if getattr(given, "candidates", None) else None
    return Inputs(records, readers.registry(spark, given.registry), readers.claims(claims), web, candidates, readers.specialties(spark))


def _world(spark: SparkSession, n: int, seed: int) -> tuple[Inputs, dict[str, DataFrame]]:
    rows = synth.source_rows(written(synth.generate(spark, n, seed)))
    return Inputs(rows["directory"], rows["registry"], rows["claims"], rows["web"], specialties=readers.specialties(spark)), rows


def accuracy(inputs: Inputs, truth: DataFrame, expected: DataFrame, policy: Policy) -> DataFrame:
    """The backtest's row with its Brier score and calibration error."""
    found = written(reconcile(inputs, policy).recommendations)
    samples = written(backtest.judged(found, truth))
    return backtest.report(found, truth, expected).join(backtest.brier(samples)).join(backtest.calibration_error(backtest.calibration(samples)))  # tables of one row


def sites(records: DataFrame, inputs: Inputs) -> DataFrame:
    """The best candidate site of each record, with its evidence."""
    best = discovery.best_site(discovery.score(inputs.candidates, discovery.targets(clues(records, inputs))))
    return best.select("provider_id", "url", "status", "score", "evidence")


def _run(spark: SparkSession, given) -> DataFrame | None:
    command = given.command
    if command == "backtest" and given.scale:
        inputs, rows = _world(spark, given.scale, given.seed)
        return accuracy(inputs, rows["truth"], rows["expected"], Policy(as_of=given.as_of))
    if command == "backtest":
        labelled = readers.cases(spark, given.cases)
        return accuracy(_sources(spark, given, labelled["directory"]), labelled["truth"], labelled["expected"], Policy(as_of=given.as_of))
    if command == "demo":
        records, inputs = None, _world(spark, given.records, given.seed)[0]
    else:
        records = readers.directory(spark, given.directory, given.lines)
    if command == "triage":
        return triage.verify_queue(triage.risk(records, given.as_of))
    if command == "duplicates":
        answers = spark.read.schema("address string, matched_address string, lat double, lon double").json(given.geocodes) if given.geocodes else None
        places = readers.geocoded(records, answers).where("lat is not null and lon is not null")
        return matching.clusters(records, places.select("provider_id", "lat", "lon") if answers is not None else None)
    if command != "demo":
        if given.record:
            records = records.where(F.col("provider_id") == given.record)
            if not records.limit(1).count():
                return None
        inputs = _sources(spark, given, records)
    if command == "discover-site":
        return sites(records, inputs)
    done = reconcile(inputs, Policy(as_of=given.as_of))
    if given.audit:
        done.events.write.mode("append").json(given.audit)
    return done.recommendations


def main(args: list[str] | None = None) -> int:
    given = _parser().parse_args(args)
    if given.command == "backtest" and not given.scale and not (given.cases and given.registry and given.claims):
        print("backtest needs --scale, or --cases with --registry and --claims", file=sys.stderr)
        return 2
    spark = SparkSession.builder.appName("accordion").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    out = _run(spark, given)
    if out is None:
        print(f"no record {given.record}", file=sys.stderr)
        return 2
    if given.output:
        out.write.mode("overwrite").json(given.output)
    else:
        for row in out.toJSON().toLocalIterator():
            print(row)
    return 0


if __name__ == "__main__":
    sys.exit(main())
