"""Operator 3: a set that speaks for others meets every block."""

import numpy as np

from accordion.llm import ngram_join


def test_speaker_that_is_the_least_of_the_main_component(spark, monkeypatch):
    known = spark.createDataFrame([(1, 1), (2, 1), (3, 1), (4, 4)], "sid long, label long")
    placed = spark.createDataFrame([(s, 1, 4, b) for s, b in ((1, 0), (2, 0), (3, 1), (4, 1))], "sid long, cluster long, size long, block long")
    speakers = spark.createDataFrame([(1, 9, 10)], "sid long, pid long, least long")
    rows = sorted(ngram_join._marked(known, placed, speakers).select("sid", "label", "cluster", "members", "block", "main").collect())
    assert [r["main"] for r in rows] == [-1, 1, 1, 0]
    at = lambda c: np.array([r[c] for r in rows])
    same = np.full(4, 7)
    monkeypatch.setattr(ngram_join, "_groups", lambda table: [same.astype(np.uint64), at("sid"), at("sid"), same * 10, same, at("label"), at("cluster"), at("members"), at("block"), at("main")])
    asked = {tuple(x.values()) for x in ngram_join._meetings(None).to_pylist()}
    # (cluster, block, sid): the speaker asks the other block, as does the set outside the
    # main component; the other members of the main component do not.
    assert asked == {(1, 1, 1), (1, 0, 4)}
