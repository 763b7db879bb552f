"""Operator 7: the direct sort in pieces, common prefixes, and groups under one minimiser."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from test_operators import SCHEMA, bytes_removed

from accordion.llm import suffix_dedup


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=150), st.integers(1, 30), st.integers(1, 12))
def test_direct_sort_and_common_prefixes(values, depth, keys):
    text = np.array(values, np.uint8)
    raw = text.tobytes()
    before, suffix_dedup.KEYS = suffix_dedup.KEYS, keys
    try:
        got = suffix_dedup.suffix_array(text, depth)
    finally:
        suffix_dedup.KEYS = before
    assert [raw[i : i + depth] for i in got.tolist()] == sorted(raw[i : i + depth] for i in range(len(raw)))
    if len(raw):
        full = np.array(sorted(range(len(raw)), key=lambda i: raw[i:]), np.int64)
        padded = raw + bytes(40)
        want = [next((j for j in range(depth) if padded[a + j] != padded[b + j]), depth) for a, b in zip(full.tolist(), full[1:].tolist(), strict=False)]
        assert suffix_dedup.common_prefixes(text, full, depth).tolist() == want


@pytest.mark.parametrize(("hot", "listed"), [(4096, 100_000), (40, 100_000), (40, 0)])
def test_unlike_segments_under_one_minimiser(spark, hot, listed, monkeypatch):
    """Thousands of texts around one shared string of few bytes: its grams are minimisers of
    unlike segments; some texts are copies, one row is there many times."""
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    monkeypatch.setattr(suffix_dedup, "LISTED", listed)
    rng = random.Random(11)
    shared = "".join(rng.choice("abcdefgh") for _ in range(40))
    rows = []
    for i in range(1500):
        ends = ["".join(rng.choice("xyz") for _ in range(20)) for _ in range(2)]
        rows.append((i, ends[0] + shared + ends[1], "en", "s", 80, "x", 1))
    rows += [(2000 + i, rows[i][1] + "q", "en", "s", 81, "x", 1) for i in range(30)] + [(5000, shared * 3, "en", "s", 120, "x", 1)] * 7
    got = [tuple(r) for r in suffix_dedup.dedup_bytes(spark.createDataFrame(rows, SCHEMA), 50).collect()]
    assert sorted(got, key=str) == bytes_removed(rows, 50)
