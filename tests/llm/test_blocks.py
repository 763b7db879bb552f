"""Operator 3 with blocks and askers cut by their tokens, against brute force."""

import random

import pytest
from test_operators import SCHEMA, WORDS, components_of

from accordion.llm import ngram_join


@pytest.mark.parametrize(("tokens", "asks", "askers"), [(150, 100, 3200), (60, 1 << 21, 2), (1 << 20, 200, 1)])
def test_blocks_of_few_tokens(spark, tokens, asks, askers, monkeypatch):
    for name, value in (("BLOCK", 6), ("PIVOTS", 2), ("BLOCK_TOKENS", tokens), ("ASK_TOKENS", asks), ("ASKERS", askers)):
        monkeypatch.setattr(ngram_join, name, value)
    rng, out = random.Random(tokens), []
    passage = [rng.choice(WORDS) for _ in range(80)]
    for i in range(70):
        own = [f"{i}z{j}" for j in range(rng.choice([0, 2, 6, 12, 19, 24, 30]))]
        cut = rng.randrange(12)
        out.append((i, " ".join(passage[cut:] + own if i % 3 else own + passage[: 80 - cut]), "", "", 0, "", 0))
    got = sorted(tuple(r) for r in ngram_join.link_components(spark.createDataFrame(out, SCHEMA)).select("_id", "n", "component").collect())
    assert got == components_of(out)
