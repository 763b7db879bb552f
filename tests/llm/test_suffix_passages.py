"""Operator 7's query: passages of over 50 words go from 400 bytes on, shorter ones and clean texts stay."""

import random

from test_operators import SCHEMA, bytes_removed

from accordion.llm import suffix_dedup

SIZES = (312, 398, 399, 400, 401, 764)


def test_passages_of_over_50_words_go_from_400_bytes_on(spark, tmp_path):
    rng = random.Random(3)
    say = lambda n, letters: " ".join("".join(rng.choice(letters) for _ in range(3)) for _ in range(n))
    rows = []

    def add(text):
        rows.append((len(rows), text, "en", "s", len(text), "x", 1))

    want = []
    for letters in ("abcdefgh", "abcdefé漢"):
        for size in SIZES:
            passage = say(200, letters).encode()[: size - 2].decode(errors="ignore")
            # Whole again after the cut, and unlike neighbours: not a byte more is common to the two texts.
            passage = "<" + passage + "." * (size - 2 - len(passage.encode())) + ">"
            assert len(passage.encode()) == size and len(passage.split()) > 50
            add(say(40, "stu") + "1" + passage + "2" + say(30, "stu"))
            add(say(25, "vwx") + "3" + passage + "4" + say(60, "vwx"))
            want += [(size * (size >= 400), int(size >= 400))] * 2
    for _ in range(20):
        add(say(300, "abcdefgh"))
        want.append((0, 0))
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(tuple(r) for r in suffix_dedup.op7_suffix_array_dedup(spark, str(tmp_path)).collect())
    assert [r[2:4] for r in got] == want
    assert sorted(got, key=str) == bytes_removed(rows, 400)
