"""Operator 8: trees kept in a table, and a table of edits applied to them."""

import random

from accordion.llm import token_counts

WORDS = ["one", "two's", "  three", "\n", "4567", "é漢", "!?", " "]


def test_edits_on_kept_trees(spark):
    rng = random.Random(3)
    say = lambda n: " ".join(rng.choice(WORDS) for _ in range(n))
    texts = {i: say(rng.choice([0, 1, 30, 900])) for i in range(30)}
    docs = spark.createDataFrame([*texts.items(), (None, "a b c"), (5, texts[5])], "doc_id long, text string")
    rounds = [[(i, k, a := rng.randrange(0, 3000), a + rng.randrange(0, 40), say(rng.randrange(0, 200))) for i in range(0, 30, 3) for k in range(rng.randrange(0, 5))] for _ in range(2)]
    trees = token_counts.keep_trees(docs)
    for edits in rounds:
        table = spark.createDataFrame([*edits, (None, 0, 0, 1, "x"), (999, 0, 0, 1, "x")], "doc_id long, ord int, begin long, end long, new string")
        trees = token_counts.apply_edits(trees, table.repartition(4))
        for i, _, a, b, new in sorted(edits):
            t = texts[i]
            texts[i] = t[: min(a, len(t))] + new + t[min(b, len(t)) :]
    with open(token_counts.VOCABULARY, "rb") as f:
        encoder = token_counts.Encoder(f.read())
    rows = trees.collect()
    assert len(rows) == 32
    for r in rows:
        want = "a b c" if r["doc_id"] is None else texts[r["doc_id"]]
        assert r["text"] == want and r["n_tokens"] == len(encoder.whole.encode_ordinary(want))
        tree = token_counts.TokenTree.stored(r["text"], r.asDict(), encoder)
        assert tree.total() == r["n_tokens"] and tree.chars.total() == len(want)
        if r["doc_id"] is None or r["doc_id"] % 3:
            assert r["n_reencoded"] == 0
    empty = token_counts.apply_edits(token_counts.keep_trees(docs.where("false")), spark.createDataFrame([], "doc_id long, ord int, begin long, end long, new string"))
    assert empty.count() == 0
