"""Seeding, submissions and runs on small fixtures."""

import time
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from sparkurate.operators import policy, tables
from sparkurate.plans import queries, seed, submissions
from sparkurate.sources.files import read_taxonomy

from .test_operators import TAXONOMY, rows


def test_seed(spark, tmp_path):
    (tmp_path / "t.txt").write_text(TAXONOMY)
    out = seed.seed_taxonomy(read_taxonomy(spark, str(tmp_path / "t.txt")))
    assert rows(out["ingredients"], "name", "slug") == [("Sea Water", "sea-water"), ("Water", "water")]
    assert {r.alias for r in out["aliases"].collect()} == {"Aqua", "Eau pure", "Eau", "Meerwasser", "Salzwasser"}
    assert {(r.source_type, r.external_id) for r in out["sources"].collect()} == {("cas", "7732-18-5"), ("wikidata", "Q283"), ("ec", "231-791-2")}
    products = spark.createDataFrame([("1", "Mist", " ,Lab", "Aqua, Water"), ("2", "Mist", "Lab", "Aqua"), ("3", "Balm", "Lab", "Aqua, Unknown"), ("4", "Old", "Lab", "Aqua"), ("5", None, "Lab", "Aqua")], "barcode string, name string, brand string, ingredients_text string")
    index = spark.createDataFrame([("aqua", 1), ("water", 1)], "term string, id int")
    made = seed.seed_products(products, index, spark.createDataFrame([("lab-old",)], "slug string"))
    assert rows(made["products"], "slug", "barcode", "brand") == [("lab-mist", "1", "LAB")] and rows(made["items"], "position", "id") == [(1, 1), (2, 1)] and rows(made["brands"]) == [("LAB", "Lab")]


def test_repairs(spark):
    unmatched = spark.createDataFrame([("Cl 77891",), ("Cl 77891",), ("apply to skin oil",), ("apply to skin oil",), ("Rare oil",), ("Jojoba Oil",), ("jojoba oil",), ("Jojoba Oil",)], "token string")
    new, log = seed.promote_tokens(unmatched, spark.createDataFrame([("x",)], "normalized_name string"))
    assert rows(new, "name", "reason") == [("CI 77891", "colorant"), ("Jojoba Oil", "vocabulary")] and log.count() == 2
    t = spark.createDataFrame([("Inactive Ingredients: Aqua",), ("Glycerin* 5% (plant)",), ("Cl77891 &amp; x",)], "t string")
    assert [r[0] for r in t.select(seed.without_section_prefix("t")).collect()][0] == "Aqua"
    got = [r[0] for r in t.select(F.array(*seed.without_annotations("t"))).collect()]
    assert got[1][3] == "Glycerin" and got[2][4] == "CI 77891" and got[2][0] == "Cl77891 & x"
    tables = {"items": spark.createDataFrame([(1, 5), (2, 6)], "p int, id int"), "aliases": spark.createDataFrame([(5, "x")], "id int, alias string"), "entries": spark.createDataFrame([(5,), (6,)], "id int")}
    out = seed.purge_entries(tables, spark.createDataFrame([(5,)], "id int"))
    assert rows(out["items"]) == [(2, 6)] and rows(out["entries"]) == [(6,)] and out["aliases"].count() == 0
    terms = seed.weighted_terms(spark.createDataFrame([(1, "Blue Cream", "a cream")], "id int, a string, b string"), "id", {"a": 1.0, "b": 0.4})
    assert rows(terms, "term", "weight") == [("a", 0.4), ("blue", 1.0), ("cream", 1.0)]
    assert rows(seed.seed_queue(spark.createDataFrame([(1, "aqua")], "id int, normalized_name string"), spark.createDataFrame([("Aqua", 5), ("AQUA", 2)], "name string, priority int"))) == [(1, 2)]
    ed = seed.editorial_input(spark.createDataFrame([(1,), (2,)], "id int"), spark.createDataFrame([(1, i, "t", "x") for i in range(9)] + [(2, 1, "t", " ")], "id int, pmid int, title string, text string"))
    assert [(r.id, [a.pmid for a in r.abstracts]) for r in ed.collect()] == [(1, [8, 7, 6, 5, 4])]


def test_apply(spark):
    make = spark.createDataFrame
    tables = {
        "brands": make([("LAB", "Lab")], "normalized string, name string"), "entries": make([("e1", "Aqua", "aqua")], "id string, name string, normalized_name string"), "aliases": make([("e1", "Eau")], "id string, alias string"),
        "products": make([("p1", "Lab", "Old", "lab-old")], "product_id string, brand string, name string, slug string"), "items": make([("p1", 1, "e1")], "product_id string, position int, id string"),
    }
    subs = make([(1, "New", "Mist", "decision_ready"), (2, "Lab", "old", "decision_ready"), (3, "Lab", "Bad", "decision_ready"), (4, "new", "mist", "decision_ready"), (5, "x", "y", "verifying")], "id int, brand string, name string, status string")
    toks = make([(1, 1, "Water", "matched", None, "e1"), (1, 2, "??", "junk", None, None), (1, 3, "Niacinamide!", "new_ingredient", "Niacinamide", None), (2, 1, "Aqua", "matched", None, "e1"), (3, 1, "z", "pending_human", None, None), (4, 1, "Aqua", "matched", None, "e1")], "id int, position int, raw_token string, resolution string, canonical_name string, entry_id string")
    out = submissions.apply_submissions(tables, subs, toks)
    assert rows(out["states"]) == [(1, "applied"), (2, "duplicate"), (3, "failed"), (4, "duplicate")]
    assert rows(out["brands"], "normalized") == [("LAB",), ("NEW",)] and rows(out["entries"], "name") == [("Aqua",), ("Niacinamide",)]
    assert rows(out["aliases"], "alias") == [("Eau",), ("Water",)] and rows(out["products"], "slug") == [("lab-old",), ("new-mist",)]
    assert out["items"].count() == 3 and out["items"].where("product_id <> 'p1'").select("position").orderBy("position").collect() == [(1,), (2,)]
    assert out["audit"].count() == 4


def test_review_and_runs(spark, tmp_path):
    now = F.lit("2024-01-10 00:00:00").cast("timestamp")
    q = spark.createDataFrame([(1, "a", datetime(2024, 1, 9, 23, 30)), (2, "b", datetime(2024, 1, 1))], "id int, trigger string, created_at timestamp")
    got, facets = submissions.filter_queue(q, now, older_than_hours=24)
    assert rows(got, "id", "age") == [(2, "9 days")] and facets.count() == 2
    d = spark.createDataFrame([("Aqua, Citric Acid; Mica", ["AQUA", "Citric-Acid", "Talc"])], "l string, o array<string>").select(submissions.list_difference("l", "o").alias("d")).first().d
    assert (d.submitted_only, d.online_only) == (["Mica"], ["Talc"])
    log = f"{tmp_path}/runs"
    with submissions.recorded_run(spark, log, "seed") as counters:
        counters["rows"] = 3
    with pytest.raises(ValueError), submissions.recorded_run(spark, log, "seed"):
        raise ValueError("x")
    assert spark.read.parquet(log).count() == 2 and rows(submissions.last_success(spark, log), "stage") == [("seed",)]


def test_rows_are_not_dropped(spark):
    make = spark.createDataFrame
    items = make([(1, 1, None), (1, 2, None), (1, 3, 7), (1, 4, 8), (1, 5, 9), (2, 1, None), (3, 16, 7), (3, 20, 99)], "product_id int, position int, id int")
    entries = make([(7, "A", ["f"]), (8, "B", None), (9, "C", []), (10, "D", [])], "id int, name string, functions array<string>")
    got = {r.product_id: [(x.name, x.functions) for x in r.ingredients] for r in submissions.description_context(items, entries, most=2).collect()}
    assert got == {1: [("A", ["f"]), ("B", [])], 3: [("A", ["f"])]}

    kinds = "id string, brand string, name string, ingredients string, submitted_by string, status string, attempt_count int, created_at timestamp"
    new = make([("a", "b", "x", None)] * 3 + [("a|b", "c", "x", None), ("a", "b|c", "x", None), ("a", "b", "x", ""), (None, None, None, None)], "brand string, name string, ingredients string, submitted_by string").repartition(3)
    now = F.lit("2026-01-01").cast("timestamp")
    out = submissions.new_submissions(make([("z", "a", "b", "x", None, "done", 1, None)], kinds), new, now)
    assert out.count() == 8 and out.select("id").distinct().count() == 8
    ids = make([("a|b", "c"), ("a", "b|c"), ("a", None), ("a", "")], "a string, b string").select(submissions.request_id(F.col("a"), F.col("b")).alias("i")).distinct()
    assert ids.count() == 4 and ids.where("length(i) = 64").count() == 4

    products = make([("1", "Mist", "Lab", "Aqua, Unknown"), ("2", "Mist", "Lab", "Sea, Salt, Aqua"), ("3", "MIST", "lab", "Aqua"), (None, "Gel", "Lab", "Aqua"), ("9", "Gel", "Lab", ",")], "barcode string, name string, brand string, ingredients_text string")
    index = make([("aqua", 1), ("sea salt", 2)], "term string, id int")
    made = seed.seed_products(products, index, make([], "slug string"))
    assert rows(made["products"], "slug", "barcode") == sorted([("lab-mist", "2"), ("lab-gel", None)], key=str)
    assert rows(made["items"].where("slug = 'lab-mist'"), "position", "id") == [(1, 2), (2, 1)]


def test_decisions_in_chains(spark):
    make = spark.createDataFrame
    n = 12
    entries = make([(i, f"E{i}") for i in range(1, n + 1)] + [(20, "X"), (21, "Y"), (22, "Z"), (30, "P"), (31, "Q")], "id int, name string")
    chain = [(i, "merge_into_existing" if i % 2 else "alias_to_existing", i + 1, None, [f"a{i}"]) for i in range(1, n)]
    circle = [(20, "merge_into_existing", 21, None, []), (21, "merge_into_existing", 20, None, ["c"]), (22, "alias_to_existing", 20, None, [])]
    rest = [(30, "delete", None, None, ["no"]), (31, "merge_into_existing", 99, None, ["no"]), (40, "merge_into_existing", 30, None, ["no"]), (1, "merge_into_existing", 30, None, ["no"])]
    decisions = make(chain + circle + rest, "id int, decision string, target_id int, canonical string, aliases array<string>").repartition(3)
    out = tables.apply_decisions({"entries": entries, "aliases": make([(1, "old", "typo"), (2, "old", "synonym"), (20, "keep", "typo")], "id int, alias string, alias_type string"), "items": make([(7, 1), (8, 5), (9, 20), (9, 30)], "product int, id int")}, decisions)
    assert rows(out["entries"], "id") == [(12,), (20,), (21,), (22,), (30,), (31,)]
    assert rows(out["items"]) == [(7, 12), (8, 12), (9, 20), (9, 30)]
    want = [(12, f"E{i}", "typo" if i % 2 else "synonym") for i in range(1, n)] + [(12, f"a{i}", "synonym") for i in range(1, n)] + [(12, "old", "synonym"), (20, "keep", "typo")]
    assert rows(out["aliases"]) == sorted(want)
    left = {(r.id, r.status) for r in out["audit"].collect()}
    assert left == {(i, "applied") for i in range(1, n)} | {(i, "pending_human") for i in (1, 20, 21, 22, 30, 31, 40)}


def test_entries_meet_a_wanted_name_once(spark):
    n = 20_000
    entries = spark.range(n).select("id", F.lit("aqua").alias("normalized_name"))
    wanted = spark.range(n).select(F.lit("Aqua").alias("name"), F.col("id").cast("int").alias("priority"))
    made = _rows_of_joins(spark, seed.seed_queue(entries, wanted), lambda out: out.agg(F.count("*"), F.max("priority")).first() == (n, 0))
    assert made == n


def _rows_of_joins(spark, df, holds):
    """The most rows that a join of df's plan makes as holds(df) runs."""
    log = spark._jsparkSession.sharedState().statusStore()
    before = log.executionsCount()
    assert holds(df)
    time.sleep(1)  # figures are brought up to date now and then
    most = 0
    for k in range(before, log.executionsCount()):
        run = log.executionsList().apply(k).executionId()
        figures, nodes = log.executionMetrics(run), log.planGraph(run).allNodes()
        for i in range(nodes.size()):
            node = nodes.apply(i)
            for j in range(node.metrics().size()):
                m = node.metrics().apply(j)
                if "Join" in node.name() and m.name() == "number of output rows":
                    most = max(most, int(figures.get(m.accumulatorId()).get().replace(",", "")))
    return most


def test_candidates_meet_an_alias_of_many_entries_once(spark, tmp_path):
    n = 3000
    many = spark.range(n).select(F.col("id").alias("p_partkey"), F.lit("Aqua").alias("p_name"), F.lit("Brand").alias("p_brand"), F.when(F.col("id") > 0, "Big").otherwise("Small").alias("p_type"), F.lit(1).alias("p_size"))
    many.write.parquet(f"{tmp_path}/part.parquet")

    def right(out):
        got = {(r.id - 3_000_000, r.decision, r.target_id) for r in out.where("id >= 3000000").collect()}
        return got == {(0, "alias_to_existing", "0")} | {(i, "needs_human", None) for i in range(1, n)}

    assert _rows_of_joins(spark, queries.QUERIES["deterministic_decision"](spark, str(tmp_path)), right) < 3 * n


def test_alias_targets_tell_one_from_several(spark):
    c = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (4, None), (5, "a")], "id int, name string")
    a = spark.createDataFrame([("a", 7), ("a", 7), ("b", 9), ("b", 8), ("b", 10), ("b", None), ("c", None), (None, 3)], "name string, target_id int")
    assert set(rows(policy.alias_targets(c, a))) == {(1, 7), (2, 8), (2, 10), (5, 7)}
