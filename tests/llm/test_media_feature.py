"""Operator 6: the fingerprint against a naive transform and pairing."""

import cmath
import hashlib
import math
import random

from accordion.llm import media

FRAME, HOP = 256, 128


def naive(payload):
    """Time-coded pairs, number by number; None where two levels are too near to rank."""
    n = max(1, 1 + -(-max(0, len(payload) - FRAME) // HOP))
    samples = [b - 128 for b in payload] + [0] * ((n - 1) * HOP + FRAME - len(payload))
    peaks = []
    for t in range(n):
        x = [samples[t * HOP + i] * (0.5 - 0.5 * math.cos(2 * math.pi * i / (FRAME - 1))) for i in range(FRAME)]
        power = [abs(sum(v * cmath.exp(-2j * math.pi * f * i / FRAME) for i, v in enumerate(x))) for f in range(FRAME // 2 + 1)]
        local = [(power[f], f) for f in range(1, FRAME // 2) if power[f] > power[f - 1] and power[f] >= power[f + 1]]
        local.sort(key=lambda p: (-p[0], p[1]))
        if any(a[0] - b[0] < 1e-3 * a[0] for a, b in zip(local[:4], local[1:4], strict=False)):
            return None
        peaks.append([f for _, f in local[: media.PEAKS]])
    pairs = []
    for t, own in enumerate(peaks):
        for step in range(1, media.REACH + 1):
            if t + step < n and peaks[t + step]:
                pairs += [t << 24 | f << 16 | peaks[t + step][0] << 8 | step for f in own]
    return sorted(pairs)


def test_fingerprints_equal_a_naive_transform():
    rng, checked = random.Random(8), 0
    payloads = [bytes(rng.choice(b"abc defgh\nABC\0\xc3\xa9") for _ in range(64 * rng.choice([1, 3, 4, 5, 9, 12]))) for _ in range(14)]
    for payload, got in zip(payloads, media.fingerprints(payloads), strict=True):
        want = naive(payload)
        if want is not None:
            checked += 1
            assert got.tolist() == want
    assert checked >= 6


def test_query_returns_media_and_feature(spark):
    docs = spark.createDataFrame([(1, "one two " * 200), (2, None), (3, "one two " * 200)], "doc_id long, text string")
    rows = {r["doc_id"]: r for r in media.media_rows(docs, with_media=True).collect()}
    assert bytes(rows[1]["media"]) == bytes(rows[3]["media"]) and rows[1]["fingerprint"] == rows[3]["fingerprint"] and rows[2]["fingerprint"] == []
    packed = b"".join(int(x).to_bytes(8, "little") for x in rows[1]["fingerprint"])
    assert rows[1]["feature"] == f"{len(rows[1]['fingerprint'])}:{hashlib.sha256(packed).hexdigest()[:32]}"
