"""Operators on small fixtures: matching, formulas, lists, tables, policies, sources, the queue."""

import gzip
import json
import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from sparkurate.functions import text as tx
from sparkurate.operators import formulas, lists, matching, policy, tables
from sparkurate.sources import files, lookups
from sparkurate.streaming import queue


def rows(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=str)


@pytest.fixture(scope="module")
def make(spark):
    return lambda data, schema: spark.createDataFrame(data, schema)


def test_cascade(make):
    catalog = make([(1, "Aqua"), (2, "Glycerin"), (3, "Salicylic Acid")], "id int, name string")
    aliases = make([(1, "Water", "manual"), (2, "Glycerol", "x")], "id int, alias string, source string")
    got = {r.term: (r.id, r.match_type) for r in matching.match(make([("AQUA",), ("glycerol",), ("Salycilic acid",), ("zzz",), (None,), ("",)], "t string"), catalog, aliases).collect()}
    assert got == {"aqua": (1, "canonical_exact"), "glycerol": (2, "alias_exact"), "salycilic acid": (3, "canonical_fuzzy")}
    remote = make([(9, "Niacinamide"), (8, "Glycerin")], "id int, name string")
    got = {r.token: (r.id, r.origin, r.match_type) for r in matching.match_with_remote(make([("Niacinamide",), ("Aqua (Eau)",), ("Glycerine",)], "t string"), catalog, aliases, remote).collect()}
    assert got == {"Niacinamide": (9, "remote", "canonical_exact"), "Aqua (Eau)": (1, "local", "canonical_exact"), "Glycerine": (2, "local", "canonical_fuzzy")}
    assert rows(matching.rank_matches(catalog, make([("gly",)], "q string")), "name", "confidence") == [("Glycerin", 0.95)]


def test_disagreement(make):
    e = make([("a", "registry", True, "X y"), ("a", "page", True, "x  Y"), ("b", "registry", True, "x"), ("b", "page", True, "z"), ("b", "compound", True, "q")], "token string, source string, found boolean, canonical string")
    assert rows(matching.spelling_disagreement(e)) == [("a", False), ("b", True)]


def test_formula_match(make):
    catalog, aliases = make([(1, "a"), (2, "b"), (3, "c")], "id int, name string"), make([(1, "alpha"), (2, "both"), (3, "both")], "id int, alias string")
    tokens = make([(7, 1, "A"), (7, 2, "b"), (8, 1, "alpha"), (8, 2, "both"), (9, 1, "c")], "input int, position int, token string")
    resolved = formulas.resolve_tokens(tokens, catalog, aliases)
    assert rows(resolved) == sorted([(7, 1, 1), (7, 2, 2), (8, 1, 1), (8, 2, None), (9, 1, 3)], key=str)
    products = make([(70, "B", "One"), (71, "B", "Two")], "product_id int, brand string, name string")
    items = make([(70, 1, 1), (70, 2, 2), (71, 1, 2), (71, 2, 1)], "product_id int, position int, id int")
    inputs = make([(7, " b ", "one"), (8, "B", "Two"), (9, "B", "Two")], "input int, brand string, name string")
    got = {r.input: r for r in formulas.formula_match(inputs, resolved, products, items, 0.5).collect()}
    assert (got[7].product_id, got[7].is_exact, got[7].same_product, got[7].similarity) == (70, True, True, 1.0)
    assert (got[8].product_id, got[8].is_exact, got[8].similarity) == (70, False, 0.5) and 9 not in got
    assert rows(formulas.identity_match(inputs, products)) == [(7, 70), (8, 71), (9, 71)]


def test_coverage(make):
    cases = make([(["Water (Aqua/Eau)", "Glycerin"], ["Aqua", "glycerin!"]), (["Water", "Aqua"], ["Eau"]), (["Water"], ["Aqua", "Glycerin"]), ([], ["x"])], "a array<string>, b array<string>")
    assert [tuple(r.c) for r in cases.select(formulas.coverage("a", "b").alias("c")).collect()] == [(1.0, 1.0), (0.5, 1.0), (1.0, 0.5), (0.0, 0.0)]
    d = make([(["aqua", "glycerine"], [False, True], ["Water", "Glycerin (Glycerine)"])], "t array<string>, u array<boolean>, o array<string>")
    assert d.select(formulas.donated_names(F.col("t"), F.col("u"), F.col("o"))).first()[0] == [None, "Glycerin (Glycerine)"]
    assert make([("CI 77891 x2", "ci-77891 (2)", "CI 77491 2")], "a string, b string, c string").select(formulas.same_numbers("a", "b"), formulas.same_numbers("a", "c")).first() == (True, False)


def test_pairing_equals_plain_first_fit(make):
    """Random lists with several spellings, repeats, nulls and empty names: first fit, entry by entry."""
    r = random.Random(8)
    words = ["Aqua", "eau", "Zinc", "zinc (water/x)", "x", "y/x", "", None, "(y)", "É", "e", "z y"]
    lists = [[r.choice(words) for _ in range(r.randrange(7))] for _ in range(300)]
    rows = [(i, lists[i], [r.random() < 0.6 for _ in lists[i]], lists[-1 - i] if i % 3 else lists[i][::-1]) for i in range(150)] + [(900, None, None, ["x"]), (901, ["x"], [True], None)]
    df = make(rows, "i int, t array<string>, o array<boolean>, n array<string>")
    alternatives = {x: set(got) for x, got in make([(w,) for w in words if w is not None], "w string").select("w", tx.overlap_alternatives("w")).collect()} | {None: set()}

    def first_fit(a, b):
        free, hits = list(range(len(b))), 0
        for x in a:
            hit = next((j for j in free if alternatives[x] & alternatives[b[j]]), None)
            if hit is not None:
                free.remove(hit)
                hits += 1
        return (hits / len(a), hits / len(b)) if a and b else (0.0, 0.0)

    def donated(a, o, b):
        if min(first_fit(a, b)) < 0.5:
            return [None] * len(a)
        free, out = list(range(len(b))), []
        for x, open_ in zip(a, o, strict=True):
            fits = [j for j in free if open_ and alternatives[x] & alternatives[b[j]]]
            out.append(b[fits[0]].strip() if len(fits) == 1 else None)
            free = [j for j in free if len(fits) != 1 or j != fits[0]]
        return out

    got = df.select("i", formulas.coverage("t", "n").alias("c"), formulas.donated_names(F.col("t"), F.col("o"), F.col("n"), 0.5).alias("d")).collect()
    for x in got:
        _, a, o, b = next(y for y in rows if y[0] == x.i)
        assert tuple(x.c) == (first_fit(a, b) if a is not None and b is not None else (0.0, 0.0))
        assert x.d == (donated(a, o, b) if a is not None and b is not None else None if a is None else [None])


def test_lists(make):
    l = make([(1, 1, "a"), (1, 2, "b"), (1, 4, "a"), (2, 1, "x")], "g int, position int, token string")
    assert rows(lists.keep_best(l, "g", "token", [-F.col("position")]), "g", "position", "token") == [(1, 1, "a"), (1, 2, "b"), (2, 1, "x")]
    assert rows(lists.gaps(l, "g", ["position"]), "g", "position", "expected") == [(1, 4, 3)]
    assert rows(lists.shift_after_deletions(l, "g", F.col("token") == "b"), "g", "position", "token") == [(1, 1, "a"), (1, 3, "a"), (2, 1, "x")]
    assert rows(lists.truncate_at_marker(l, "g", F.col("token") == "b"), "g", "position") == [(1, 1), (2, 1)]
    chain = make([(1, i, t) for i, t in enumerate("a b a b b a b".split(), 1)], "g int, position int, token string")
    assert [r[2] for r in rows(lists.merge_pairs(chain, "g", "token", (F.col("token") == "a") & (F.col("next_token") == "b")), "g", "position", "token")] == ["a b", "a b", "b", "a b"]
    b = make([(1, i, n) for i, n in enumerate([5, 5, 5, 50, 1])], "g int, i int, n long")
    assert [r.batch for r in lists.fill_groups(b, ["i"], "n", 2, 20, "g").orderBy("i").collect()] == [0, 0, 1, 2, 3]
    left, found = lists.pattern_purge(make([("call 555-123-4567",), ("aqua",)], "t string"), "t", make([("[0-9]{3}[- ][0-9]{3}", "phone")], "pattern string, reason string"))
    assert rows(left) == [("aqua",)] and rows(found) == [("phone", "delete", "call 555-123-4567", 1)]


def test_tables(make):
    t = make([(1, "a", {"x": "1"}, ["q"]), (2, None, None, None)], "id int, name string, info map<string,string>, tags array<string>")
    n = make([(1, None, {"x": "2", "y": None, "z": "3"}, []), (3, "c", {"k": "v"}, ["r"])], "id int, name string, info map<string,string>, tags array<string>")
    got = {r.id: (r.name, r.info, r.tags) for r in tables.upsert(t, n, ["id"], ("info",), ("tags",)).collect()}
    assert got == {1: ("a", {"x": "2", "z": "3"}, ["q"]), 2: (None, None, None), 3: ("c", {"k": "v"}, ["r"])}
    assert rows(tables.insert_missing(t.select("id", "name"), make([(1, "z"), (4, "b"), (4, "a"), (None, "n"), (None, "n")], "id int, name string"), ["id"], ["name"])) == sorted([(1, "a"), (2, None), (4, "a"), (None, "n"), (None, "n")], key=str)
    entries = make([(1, "A", 5, "a", None), (2, "a", 3, "a", "c2"), (3, "B", 1, "b", None)], "id int, name string, created_at int, normalized_name string, cas string")
    out = tables.merge_duplicates({"entries": entries, "aliases": make([(1, "x"), (2, "x")], "id int, alias string"), "items": make([(7, 2), (8, 3)], "product int, id int")}, scalars=("cas",))
    assert rows(out["entries"], "id", "cas") == sorted([(2, "c2"), (3, None)], key=str) and rows(out["aliases"]) == [(2, "A"), (2, "x")] and rows(out["items"]) == [(7, 2), (8, 3)]
    done = tables.apply_decisions({"entries": entries.select("id", "name"), "aliases": make([(1, "x", "typo")], "id int, alias string, alias_type string"), "items": make([(7, 1)], "product int, id int")}, make([(1, "merge_into_existing", 2, None, ["aa"]), (3, "keep", None, "Bee", [])], "id int, decision string, target_id int, canonical string, aliases array<string>"))
    assert rows(done["entries"]) == [(2, "a"), (3, "Bee")] and rows(done["items"]) == [(7, 2)] and rows(done["aliases"]) == [(2, "A", "typo"), (2, "aa", "synonym"), (2, "x", "typo")]
    assert done["audit"].count() == 2
    assert rows(tables.parity(entries.select("id", "name"), make([(1, "A"), (2, "x"), (9, None)], "id int, name string"), "id", ["name"])) == [(3, 3, 1, 1, 1)]
    assert rows(tables.with_positions_checked(make([(1, 1), (1, 2), (2, 1), (2, 3)], "g int, position int"), "g")) == [(1, True), (2, False)]
    assert tables.backup(entries, make([(1,)], "id int"), ["id"], label="x").count() == 1
    assert tables.visible(entries, F.col("cas").isNotNull(), F.col("name"), "A").count() == 2


def test_decisions(make):
    c = make([(1, "aqua"), (2, "alias"), (3, "two"), (4, "salycilic acid"), (5, "page"), (6, "none")], "id int, name string")
    collisions = make([(1, 10, 2, "Aqua"), (1, 11, 1, "AQUA")], "id int, target_id int, created_at int, canonical string")
    alias = make([(2, 20), (2, 20), (3, 30), (3, 31)], "id int, target_id int")
    ev = make([(5, 0, "taxonomy", True, "search", "Page", 0.5), (5, 1, "page", True, "page", "Page!", 0.88)], "id int, seq int, source string, found boolean, lookup_type string, canonical string, confidence double")
    sc = make([(4, 40, "salicylic acid", 0.94, 2, 0.3, 1, 0.2)], "source_id int, target_id int, target string, similarity double, edit_distance int, token_overlap double, rank int, score_margin double")
    got = {r.id: (r.decision, r.target_id, r.canonical, r.confidence) for r in policy.decide(c, collisions, alias, ev, sc).collect()}
    assert got == {1: ("merge_into_existing", "11", "AQUA", 0.99), 2: ("alias_to_existing", "20", None, 0.97), 3: ("needs_human", None, None, 0.0), 4: ("merge_into_existing", "40", None, 0.94), 5: ("keep", None, "Page", 0.90), 6: ("needs_human", None, None, 0.0)}


def test_parsed_decisions(make):
    ok = {"decision": "merge_into_existing", "target_id": "7", "confidence": 0.9, "aliases": ["x"], "reason": "r"}
    raw = make([(1, "```json\n" + json.dumps(ok) + "\n```"), (2, "{"), (3, json.dumps(ok | {"target_id": "8"})), (4, json.dumps(ok | {"confidence": 0.7})), (5, json.dumps(ok | {"decision": "maybe"}))], "id int, raw string")
    got = {r.id: (r.decision, r.reason, r.confidence) for r in policy.parse_decisions(raw, make([(7,)], "id int")).collect()}
    assert got == {1: ("merge_into_existing", "r", 0.9), 2: ("needs_human", "malformed", 0.0), 3: ("needs_human", "unknown target", 0.0), 4: ("needs_human", "unsure", 0.7), 5: ("needs_human", "malformed", 0.0)}


def test_judgments(make):
    cases = [
        (("matched", "zzz", 0.99, "", 5, None), ("pending_human", "llm_choice_id_invalid")), (("matched", "evidence_0", 0.99, "", 5, "authoritative"), ("pending_human", "matched_non_catalog_hypothesis")),
        (("new_ingredient", "fuzzy", 0.99, "", 5, "existing"), ("pending_human", "llm_verdict_choice_mismatch")), (("new_ingredient", "evidence_0", 0.89, "", 5, "authoritative"), ("pending_human", "llm_confidence_below_threshold")),
        (("junk", "fuzzy", 0.99, "", 5, "existing"), ("pending_human", "llm_choice_id_invalid")), (("new_ingredient", "evidence_0", 0.86, "", 5, "existing"), ("matched", None)), (("junk", None, 0.9, "", 3, None), ("pending_human", "junk_at_top_positions")),
        (("junk", None, 0.9, "", 4, None), ("junk", None)), (("new_ingredient", "evidence_0", 0.9, "", 1, "authoritative"), ("new_ingredient", None)), (("unknown", None, 0.9, "", 1, None), ("pending_human", "llm_unknown")), (("unknown", None, 0.0, "no parseable result", 1, None), ("pending_human", "llm_response_invalid")),
    ]
    df = make([(i, *c) for i, (c, _) in enumerate(cases)], "i int, verdict string, choice string, confidence double, reason string, position int, kind string")
    got = df.orderBy("i").select(policy.judge(*[F.col(c) for c in ("verdict", "choice", "confidence", "reason", "position", "kind")]).alias("x")).collect()
    assert [tuple(r.x) for r in got] == [w for _, w in cases]


def test_hypotheses(make):
    t = make([(1, 5, "Aqua", "alias_fuzzy", 0.9), (2, 6, "X", "canonical_exact", 1.0)], "token_id int, entry_id int, name string, match_type string, confidence double")
    e = make([(1, 0, "registry", True, "Aqua", 0.97), (1, 1, "compound", True, "Aqua", 0.85), (2, 0, "page", True, "New", 0.92)], "token_id int, seq int, source string, found boolean, canonical string, confidence double")
    assert rows(policy.hypotheses(t, e, make([("Aqua", 5)], "canonical string, entry_id int")), "token_id", "hypothesis", "kind") == [(1, "evidence_0", "existing"), (1, "fuzzy", "existing"), (2, "evidence_0", "authoritative")]


TAXONOMY = """# a comment
en: Water, Aqua, Eau pure
fr: Eau
cas_number:en: 7732-18-5
cas_number:en: 0-0-0
wikidata:en: Q283

< en: Water
en: Sea Water
ec_number: 231-791-2
de: Meerwasser, Salzwasser

fr: Sans anglais
"""


def test_sources(spark, tmp_path):
    (tmp_path / "t.txt").write_text(TAXONOMY)
    got = {r.canonical: r for r in files.read_taxonomy(spark, str(tmp_path / "t.txt")).collect()}
    assert set(got) == {"Water", "Sea Water"}
    w, s = got["Water"], got["Sea Water"]
    assert (w.synonyms, w.cas, w.ec, w.wikidata, w.parents, w.other_names) == (["Aqua", "Eau pure"], "7732-18-5", None, "Q283", [], {"fr": ["Eau"]})
    assert (s.ec, s.parents, s.other_names) == ("231-791-2", ["Water"], {"de": ["Meerwasser", "Salzwasser"]})
    lines = [{"code": "1", "product_name": "n", "ingredients_text": "a", "ingredients_text_en": ""}, {"_id": "2", "code": "", "ingredients_text_en": "b"}, {"product_name": "no code"}]
    with gzip.open(tmp_path / "p.jsonl.gz", "wt") as f:
        f.write("\n".join([*map(json.dumps, lines), "", "{broken"]))
    assert rows(files.read_products(spark, str(tmp_path / "p.jsonl.gz")), "barcode", "ingredients_text") == [("1", "a"), ("2", "b")]
    (tmp_path / "in").mkdir()
    good = {"what_it_does": "a", "summary_short": "b", "summary_long": "c", "quick_facts": ["d"]}
    (tmp_path / "in/one.json").write_text("```json\n" + json.dumps(good) + "\n```")
    (tmp_path / "in/two.json").write_text(json.dumps({"what_it_does": "a"}))
    ok, bad = files.read_inbox(spark, str(tmp_path / "in"))
    assert rows(ok, "slug", "quick_facts") == [("one", ["d"])] and rows(bad, "slug") == [("two",)]
    files.write_prompts(spark.createDataFrame([("A b", [("t", "x")]), ("C", [])], "name string, abstracts array<struct<title:string,text:string>>"), str(tmp_path / "out"))
    assert rows(spark.read.text(str(tmp_path / "out"), wholetext=True).select("slug").distinct()) == [("a-b",)]


def test_lookups(spark):
    names = spark.createDataFrame([(f"n{i}",) for i in range(7)], "name string").repartition(1)

    def fetch(part):
        if "n3" in part:
            raise ValueError("down")
        return [{"name": k, "cid": k.upper()} for k in part]

    got = {r.name: (r.cid, r.found) for r in lookups.lookup(names, fetch, "name string, cid string", size=1).collect()}
    assert got["n1"] == ("N1", True) and got["n3"] == (None, False) and len(got) == 7
    waits = [lookups.wait_seconds(a, r, 0.0) for a, r in ((0, None), (9, None), (0, "5"), (0, "60"), (0, "Thu, 01 Jan 1970 00:00:07 GMT"), (0, "?"))]
    assert waits == [1.0, 30.0, 5.0, None, 7.0, 1.0]
    calls = []

    def flaky():
        calls.append(1)
        if len(calls) < 3:
            raise lookups.Retry()
        return "ok"

    assert lookups.with_retries(flaky, sleep=lambda s: None) == "ok" and len(calls) == 3
    table = spark.createDataFrame([("Aqua", "Aqua", "exact"), ("Water", "Aqua", "alias")], "term string, canonical string, kind string")
    ev = lookups.table_evidence(spark.createDataFrame([("WATER",), ("x",)], "name string"), table, "taxonomy", {"exact": 0.95, "alias": 0.92})
    assert rows(ev, "name", "found", "canonical", "confidence") == sorted([("WATER", True, "Aqua", 0.92), ("x", False, None, None)], key=str)
    assert lookups.all_evidence(ev, ev).count() == 4
    filled = lookups.fill_identifiers(spark.createDataFrame([("1", None, "old"), ("2", "e", None)], "cas string, ec string, iupac string"), spark.createDataFrame([("1", "E", "new"), ("2", "F", None)], "cas string, ec string, iupac string"))
    assert rows(filled) == sorted([("1", "E", "new"), ("2", "e", None)], key=str)


def test_queue(spark, tmp_path):
    at = datetime(2024, 1, 1)
    q = spark.createDataFrame([(1, "received", at, 0, None, None, None), (2, "submitted", at, 3, at, "b1", None), (3, "submitted", at, 1, at, "b2", None)], "id int, status string, created_at timestamp, attempt_count int, locked_at timestamp, batch_id string, last_error string")
    assert rows(queue.finalize(q, spark.createDataFrame([(2, "b1", "decision_ready"), (3, "old", "decision_ready")], "id int, batch_id string, status string")), "id", "status") == [(1, "received"), (2, "decision_ready"), (3, "submitted")]
    failed = queue.fail(q, spark.createDataFrame([(2, "x" * 3000), (3, "y")], "id int, error string"), "verifying")
    assert rows(failed, "id", "status") == [(1, "received"), (2, "failed"), (3, "verifying")] and failed.where("id = 2").first().last_error == "x" * 2000
    steps = spark.createDataFrame([(1, 1, "received"), (1, 2, "processing"), (1, 3, "applied")], "id int, seq int, status string")
    assert rows(queue.illegal_steps(steps), "seq", "before", "status") == [(3, "processing", "applied")]
    log = spark.createDataFrame([(1, at, "old"), (1, datetime(2024, 1, 2), "new")], "id int, at timestamp, trigger string")
    waiting = queue.review_queue(spark.createDataFrame([(1, "pending_human"), (2, "applied")], "id int, status string"), log, spark.createDataFrame([(1, "pending_human"), (1, "junk")], "id int, resolution string"))
    assert rows(waiting, "id", "trigger", "n_waiting") == [(1, "new", 1)]
    for i in range(3):
        spark.createDataFrame([(i,)], "id int").write.parquet(f"{tmp_path}/in/{i}")
    seen = []
    for _ in range(2):  # the second run finds nothing new
        queue.run_ticks(spark, f"{tmp_path}/in/*", "id int", f"{tmp_path}/state", lambda df, n: seen.extend(r.id for r in df.collect()), 1)
    assert sorted(seen) == [0, 1, 2]


def test_similar_bags_equal_all_pairs(spark):
    import random

    from sparkurate.operators.formulas import bag_overlap, similar_bags

    r = random.Random(4)
    rows = [(g, r.choice([None, 1, 1, 2, 3, 4, 5, 6, 7])) for g in range(60) for _ in range(r.randrange(1, 9))]
    a = spark.createDataFrame(rows, "input long, v long")
    b = a.withColumnRenamed("input", "product_id")
    size = {}
    for g, _ in rows:
        size[g] = size.get(g, 0) + 1
    all_ = {(x.input, x.product_id): x.common for x in bag_overlap(a, b, ("input", "product_id"), "v").collect()}
    for t in (0.25, 0.5, 0.8, 1.0):
        got = {(x.input, x.product_id): x.common for x in similar_bags(a, b, ("input", "product_id"), "v", t).collect()}
        fit = lambda p, n, t=t: n / max(size[p[0]], size[p[1]]) >= t - 1e-9
        assert {p: n for p, n in got.items() if fit(p, n)} == {p: n for p, n in all_.items() if fit(p, n)}


def test_counted_and_moved(spark, tmp_path):
    from sparkurate.plans.submissions import counted
    from sparkurate.sources.files import move_files

    df, seen = counted(spark.range(10), "stage", kept=F.count_if(F.col("id") > 3), rows=F.count("*"))
    df.write.format("noop").mode("overwrite").save()
    assert seen.get == {"kept": 6, "rows": 10}
    (tmp_path / "in").mkdir()
    for n in "abc":
        (tmp_path / "in" / f"{n}.json").write_text("{}")
    assert move_files(spark, f"file://{tmp_path}/in", spark.createDataFrame([("a",), ("b",)], "slug string"), f"file://{tmp_path}/done") == 2
    assert sorted(p.name for p in (tmp_path / "done").glob("*.json")) == ["a.json", "b.json"] and (tmp_path / "in" / "c.json").exists()


def test_beside_takes_one_row(spark):
    from sparkurate.operators.tables import beside

    assert [r.n for r in beside(spark.range(2), spark.range(5).selectExpr("count(*) as n")).collect()] == [5, 5]
    with pytest.raises(Exception, match="more than one row"):
        beside(spark.range(2), spark.range(2).withColumnRenamed("id", "n")).collect()
