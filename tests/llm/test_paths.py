"""Operator 9: nonbranching paths, branches, cycles, and whole tables against brute force."""

import random

import pytest
from test_operators import SCHEMA, words_removed

from accordion.llm import substring_dedup

LETTERS = [f"w{i}" for i in range(300)]


def test_paths_of_pieces(spark):
    """1 -> 2 -> 3 is a path; 4 has two ways on; 7, 8 and 9 are a cycle; 10 ends in itself."""
    pieces = [(1, 5, 100, 101), (2, 2, 101, 102), (3, 9, 102, 103), (4, 1, 200, 201), (5, 1, 201, 202), (6, 1, 201, 203), (7, 1, 301, 302), (8, 1, 302, 303), (9, 1, 303, 301), (10, 4, 400, 400)]
    got = substring_dedup.compacted(spark.createDataFrame(pieces, "pid long, n int, a long, b long")).collect()
    assert sorted((r["pid"], r["path"], r["place"]) for r in got) == [(2, 1, 5), (3, 1, 7)]
    long = [(i, 1, i, i + 1) for i in range(1000)]
    random.Random(1).shuffle(long)
    got = substring_dedup.compacted(spark.createDataFrame(long, "pid long, n int, a long, b long")).collect()
    assert sorted((r["pid"], r["path"], r["place"]) for r in got) == [(i, 0, i) for i in range(1, 1000)]
    assert substring_dedup.compacted(spark.createDataFrame([], "pid long, n int, a long, b long")).count() == 0


@pytest.mark.parametrize(("seed", "k", "parts"), [(0, 13, 3), (1, 13, 100), (2, 4, 1), (3, 4, 100), (4, 2, 20)])
def test_branching_passages(spark, seed, k, parts):
    """Passages that part and meet again, in any order of ids, that loop, and that texts
    enter or leave halfway; gathered in one batch and in as many as there are rows."""
    rng = random.Random(seed)
    say = lambda n: [rng.choice(LETTERS) for _ in range(n)]
    stem, ways, tail = say(40), [say(25) for _ in range(3)], say(40)
    loop = say(17)
    rows = []
    for i in rng.sample(range(1000), 60):
        kind = i % 5
        text = say(5) + stem[rng.randrange(20) :] + rng.choice(ways) + tail[: rng.randrange(10, 40)] + say(5)
        if kind == 1:
            text = say(3) + loop * rng.randrange(1, 4) + say(3)
        elif kind == 2:
            text = rng.choice(ways) + stem + rng.choice(ways)
        elif kind == 3:
            text = say(30)
        rows.append((i, " ".join(text), "en", "s", 1, "x", 1))
    rows += [rows[0], rows[0], (5000, " ".join(stem + tail), "en", "s", 1, "x", 1), (5000, " ".join(stem + say(3)), "en", "s", 1, "x", 1)]
    rows += [(2000 + i, rows[7][1], "en", "s", 1, "x", 1) for i in range(40)]
    got = substring_dedup.dedup_words(spark.createDataFrame(rows, SCHEMA).repartition(parts), k).select("_id", "n_words", "n_removed", "kept_sha256").collect()
    assert sorted(map(tuple, got)) == words_removed(rows, k)


def test_repeated_paths_follow_their_sources(spark):
    """Each path's pieces, one after the other, are words that two documents share."""
    rng = random.Random(6)
    say = lambda n: [rng.choice(LETTERS) for _ in range(n)]
    stem, one, two = say(60), say(30), say(30)
    texts = {1: stem + one + say(4), 2: say(2) + stem + two, 3: stem + one, 4: two + say(9), 5: say(50) + stem + two}
    docs = spark.createDataFrame([(i, " ".join(t), "", "", 0, "", 0) for i, t in texts.items()], SCHEMA)
    k, paths = 13, {}
    for r in substring_dedup.repeated_paths(docs, k).collect():
        paths.setdefault(r["path"], []).append((r["place"], r["n"], texts[r["doc_id"]][r["at"] : r["at"] + r["n"] + k - 1]))
    spelled = []
    for pieces in paths.values():
        words = []
        for place, n, said in sorted(pieces):
            assert words[place:] == said[: len(words) - place] and len(said) == n + k - 1
            words = words[:place] + said
        spelled.append(tuple(words))
    # The stem is one path; what follows it parts into two, each with the stem's last words.
    assert sorted(map(len, spelled)) == sorted([60, 30 + k - 1, 30 + k - 1])
    assert tuple(stem) in spelled and all(tuple(stem[-(k - 1) :] + way) in spelled for way in (one, two))
