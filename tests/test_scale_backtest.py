"""The engine on generated worlds: the published accuracy, and sources that repeat themselves."""

from dataclasses import replace
from datetime import date

import pytest

from accordion.operators import backtest
from accordion.plans import record_queries, reconcile
from accordion.plans.policy import Policy
from accordion.sources import readers, synth


@pytest.mark.parametrize(("n", "seed"), [(600, 0), (5000, 0)])
def test_accuracy_of_generated_worlds(spark, n, seed):
    world = record_queries.written(synth.generate(spark, n, seed))
    rows = synth.source_rows(world)
    inputs = reconcile.Inputs(rows["directory"], rows["registry"], rows["claims"], rows["web"], specialties=readers.specialties(spark))
    done = reconcile.reconcile(inputs, Policy(as_of=date(2026, 6, 1)))
    found = record_queries.written(done.recommendations)
    r = backtest.report(found, rows["truth"], rows["expected"]).first()
    assert r["records"] == n and 0.90 <= r["recall"] <= 1.0
    assert 0.90 <= r["auto_update_precision"] < 1.0 and r["routing_accuracy"] >= 0.95
    samples = record_queries.written(backtest.judged(found, rows["truth"]))
    b, e = backtest.brier(samples).first()[0], backtest.calibration_error(backtest.calibration(samples)).first()[0]
    print(n, r, b, e)
    assert b < 0.15


def test_a_source_that_repeats_itself_is_one_source(spark):
    rows = synth.source_rows(record_queries.written(synth.generate(spark, 60, 3)))
    inputs = reconcile.Inputs(rows["directory"], rows["registry"], rows["claims"], rows["web"], specialties=readers.specialties(spark))
    twice = replace(inputs, registry=inputs.registry.unionByName(inputs.registry), claims=inputs.claims.unionByName(inputs.claims).unionByName(inputs.claims))
    policy = Policy(as_of=date(2026, 6, 1))
    once, again = (sorted(map(str, reconcile.reconcile(i, policy).recommendations.collect())) for i in (inputs, twice))
    assert once == again
