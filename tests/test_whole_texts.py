"""Queries over whole texts, by brute force on small fixtures."""

from accordion.plans import record_queries, tables


def grams(text: str) -> set:
    padded = f"  {text.lower()} "
    return {padded[i : i + 3] for i in range(len(padded) - 2)}


def test_trigram_pairs_compare_whole_texts(spark, tmp_path):
    words = [f"w{i * 7919 % 1000:03d} ñé😀" for i in range(400)]
    opening, tail, other = " ".join(words[:30]), " ".join(words[30:90]), " ".join(words[200:260])
    texts = [f"{opening} {tail}", f"{opening} {other}", f"{opening} {tail} more", f"{opening[:9]}X{' '.join(words[90:110])} {tail}", opening, "", None]
    texts += [f"{opening[:9]}Y{' '.join(words[110:118])} {tail} {other}", f"{opening[:9]}Z{' '.join(words[118:126])} {tail} {other}"]
    texts += [" ".join(words[: 100 + 7 * k]) for k in range(12)]
    spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    found = {(r["id_a"], r["id_b"]): r["similarity"] for r in record_queries.trigram_pairs(spark, str(tmp_path)).collect()}
    sets = {i: grams(t) for i, t in enumerate(texts) if t is not None}
    block = lambda i: texts[i][:8].lower()
    every = {(a, b): round(len(sets[a] & sets[b]) / len(sets[a] | sets[b]), 4) for a in sets for b in sets if a < b and block(a) == block(b)}
    assert found == {p: s for p, s in every.items() if s >= 0.82}
    assert (0, 2) in found and (0, 1) not in found and (7, 8) in found and (0, 4) not in found


def test_sites_read_the_whole_page(spark, tmp_path):
    customers = [(k, f"Customer#{k}", 0, "BUILDING") for k in (1, 2, 4, 2 * 10**9)]
    spark.createDataFrame(customers, "c_custkey long, c_name string, c_nationkey long, c_mktsegment string").write.parquet(f"{tmp_path}/customer.parquet")
    spark.createDataFrame([(0, "FRANCE")], "n_nationkey long, n_name string").write.parquet(f"{tmp_path}/nation.parquet")
    named = {r["provider_id"]: r["provider_name"] for r in tables.directory(spark, str(tmp_path)).collect()}
    page = lambda k, name: (k, f"https://site{k}.org/", f"<html><head><title>t</title>{'<meta>' * 100}</head><body><p>We are {name}.</p></body></html>")
    pages = [page(1, "nobody"), page(2, named["2"]), page(4, "nobody"), page(2 * 10**9, named[str(2 * 10**9)])]
    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    rows = record_queries.site_scores(spark, str(tmp_path)).collect()
    assert {r["provider_id"]: "page_text_match" in r["evidence"].split(",") for r in rows} == {"1": False, "2": True, "4": False, str(2 * 10**9): True}


def test_slugs_are_of_whole_texts(spark, tmp_path):
    opening = "The same opening, " * 5
    spark.createDataFrame([(1, opening + "One!"), (2, opening + "Two!"), (3, "")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    slugs = {r["doc_id"]: r["slug"] for r in record_queries.clean_texts(spark, str(tmp_path)).collect()}
    assert slugs == {1: "the_same_opening_" * 5 + "one", 2: "the_same_opening_" * 5 + "two", 3: ""}
