"""Queries over the driver's tables, each with the SQL that a plain engine runs for the same rows.

The tables stand in for a catalog: parts are entries (64 names or so, so most are duplicates), brands
and types give aliases, orders are products, their lines ordered lists of parts, events a queue.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import similarity as sim
from ..functions import text as tx
from ..functions import web
from ..operators import formulas, lists, matching, policy, tables
from ..streaming import queue

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function's name; sql: None where SQL can't express it."""

    def add(f):
        if f.__name__ in QUERIES:
            raise ValueError(f"two queries are called {f.__name__}")
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = f"{sql}"
        return f

    return add


def read(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def lines(spark, d) -> DataFrame:
    """Lines of orders at the positions 1, 2, 3, ... (line numbers repeat)."""
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey")
    return read(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_suppkey", "l_quantity", "l_returnflag", F.row_number().over(w).cast("int").alias("position"))


LINES = "lines AS (SELECT l_orderkey, l_partkey, l_linenumber, l_suppkey, l_quantity, l_returnflag, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS position FROM lineitem)"


def catalog(spark, d) -> DataFrame:
    return read(spark, d, "part").groupBy(F.col("p_name").alias("name")).agg(F.min("p_partkey").alias("id"))


def aliases(spark, d) -> DataFrame:
    p = read(spark, d, "part").select(F.concat_ws(" ", "p_brand", "p_type").alias("alias"), "p_partkey", "p_size")
    return p.groupBy("alias").agg(F.min("p_partkey").alias("id"), F.when(F.min("p_size") < 5, "manual").otherwise("import").alias("source"))


def tokens(spark, d) -> DataFrame:
    """Names as people write them: as they are, in capitals, cut short, by brand and type, and market segments."""
    p = read(spark, d, "part")
    forms = [p.select(F.upper("p_name").alias("token")), p.select(F.expr("substring(p_name, 1, length(p_name) - 1)").alias("token")), p.select(F.concat_ws("  ", "p_brand", "p_type").alias("token")), read(spark, d, "customer").select(F.col("c_mktsegment").alias("token"))]
    return forms[0].unionAll(forms[1]).unionAll(forms[2]).unionAll(forms[3])


NORM = "trim(regexp_replace(regexp_replace(lower(strip_accents({0})), '[^a-z0-9 ]', '', 'g'), ' +', ' ', 'g'))"


def norm(c: str) -> str:
    return NORM.format(c)


CATALOG = "catalog AS (SELECT p_name AS name, min(p_partkey) AS id FROM part GROUP BY 1)"
ALIASES = "aliases AS (SELECT p_brand || ' ' || p_type AS alias, min(p_partkey) AS id, CASE WHEN min(p_size) < 5 THEN 'manual' ELSE 'import' END AS source FROM part GROUP BY 1)"
TOKENS = "tokens AS (SELECT upper(p_name) AS token FROM part UNION ALL SELECT substr(p_name, 1, length(p_name) - 1) FROM part UNION ALL SELECT p_brand || '  ' || p_type FROM part UNION ALL SELECT c_mktsegment FROM customer)"
GRAMS = "list_distinct(flatten(list_transform(list_filter(string_split({0}, ' '), lambda w: w <> ''), lambda w: list_transform(range(1, length(w) + 2), lambda i: substr('  ' || w || ' ', i, 3)))))"


def jac(a: str, b: str) -> str:
    x, y = GRAMS.format(a), GRAMS.format(b)
    return f"(len(list_intersect({x}, {y})) * 1.0 / (len({x}) + len({y}) - len(list_intersect({x}, {y}))))"


def dice(a: str, b: str) -> str:
    x, y = GRAMS.format(a), GRAMS.format(b)
    return f"(2.0 * len(list_intersect({x}, {y})) / (len({x}) + len({y})))"


# --------------------------------------------------------------------------- formulas


@query(
    f"""WITH {LINES}, counts AS (SELECT l_orderkey, l_partkey, count(*) AS n FROM lines GROUP BY 1, 2), sizes AS (SELECT l_orderkey, count(*) AS n FROM lines GROUP BY 1),
    common AS (SELECT a.l_orderkey AS input, b.l_orderkey AS product_id, sum(least(a.n, b.n)) AS common FROM counts a JOIN counts b USING (l_partkey) WHERE a.l_orderkey <> b.l_orderkey GROUP BY 1, 2),
    scored AS (SELECT input, product_id, common * 1.0 / greatest(x.n, y.n) AS s FROM common JOIN sizes x ON x.l_orderkey = input JOIN sizes y ON y.l_orderkey = product_id)
    SELECT input, product_id, round(s, 6) AS similarity FROM (SELECT *, row_number() OVER (PARTITION BY input ORDER BY s DESC, product_id) AS k FROM scored WHERE s >= 0.25) WHERE k = 1"""
)
def formula_topk(spark, d):
    items = read(spark, d, "lineitem").withColumnRenamed("l_orderkey", "input")
    near = formulas.nearest_bags(items, None, ("input", "product_id"), "l_partkey", least=0.25)
    return near.select("input", "product_id", F.round("similarity", 6).alias("similarity"))


@query(
    f"""WITH {LINES}, f AS (SELECT l_orderkey, string_agg(l_partkey::VARCHAR, '|' ORDER BY position) AS ids FROM lines GROUP BY 1)
    SELECT md5(ids) AS fingerprint, count(*) AS n, min(l_orderkey) AS first_order FROM f GROUP BY 1 HAVING count(*) > 1"""
)
def formula_exact_duplicates(spark, d):
    f = tx.group_fingerprint(lines(spark, d), "l_orderkey", ["position"], "l_partkey")
    return f.groupBy("fingerprint").agg(F.count("*").alias("n"), F.min("l_orderkey").alias("first_order")).where("n > 1")


@query(f"WITH {LINES} SELECT l_orderkey, md5(string_agg(l_partkey::VARCHAR, '|' ORDER BY position)) AS fingerprint FROM lines GROUP BY 1")
def ordered_fingerprint(spark, d):
    return tx.group_fingerprint(lines(spark, d), "l_orderkey", ["position"], "l_partkey")


@query(f"WITH {LINES}, f AS (SELECT l_orderkey, md5(string_agg(l_partkey::VARCHAR, '|' ORDER BY position)) AS fp FROM lines GROUP BY 1) SELECT l_orderkey, CASE WHEN count(*) OVER (PARTITION BY fp) = 1 THEN fp END AS fingerprint FROM f")
def unique_fingerprint(spark, d):
    return tx.unique_or_null(tx.group_fingerprint(lines(spark, d), "l_orderkey", ["position"], "l_partkey"), "fingerprint")


@query(
    f"""WITH {LINES}, f AS (SELECT l_orderkey, string_agg(l_partkey::VARCHAR, '|' ORDER BY position) AS ids, count(*) AS n FROM lines GROUP BY 1),
    counts AS (SELECT l_orderkey, l_partkey, count(*) AS n FROM lines GROUP BY 1, 2),
    p AS (SELECT o_orderkey, upper(trim(c_mktsegment)) AS brand, {norm('o_orderpriority')} AS name FROM orders JOIN customer ON c_custkey = o_custkey),
    common AS (SELECT a.l_orderkey AS input, b.l_orderkey AS product_id, sum(least(a.n, b.n)) AS common FROM counts a JOIN counts b USING (l_partkey) GROUP BY 1, 2),
    s AS (SELECT input, product_id, common * 1.0 / greatest(x.n, y.n) AS similarity, x.ids = y.ids AS is_exact, p.name = q.name AS product_name_matches, p.brand = q.brand AS brand_name_matches
      FROM common JOIN f x ON x.l_orderkey = input JOIN f y ON y.l_orderkey = product_id JOIN p ON p.o_orderkey = input JOIN p q ON q.o_orderkey = product_id)
    SELECT input, product_id, round(similarity, 6) AS similarity, is_exact, product_name_matches, brand_name_matches, product_name_matches AND brand_name_matches AS same_product FROM (
      SELECT *, row_number() OVER (PARTITION BY input ORDER BY (is_exact AND product_name_matches AND brand_name_matches) DESC, is_exact DESC, (NOT product_name_matches) DESC, similarity DESC, product_id) AS k FROM s WHERE is_exact OR similarity >= 0.95) WHERE k = 1"""
)
def formula_match(spark, d):
    o = read(spark, d, "orders").join(read(spark, d, "customer"), F.col("c_custkey") == F.col("o_custkey"))
    items = lines(spark, d)
    inputs = o.select(F.col("o_orderkey").alias("input"), F.col("c_mktsegment").alias("brand"), F.col("o_orderpriority").alias("name"))
    resolved = items.select(F.col("l_orderkey").alias("input"), "position", F.col("l_partkey").alias("id"))
    out = formulas.formula_match(inputs, resolved, inputs.withColumnRenamed("input", "product_id"), resolved.withColumnRenamed("input", "product_id"))
    return out.drop("product_name").withColumn("similarity", F.round("similarity", 6))


@query(f"WITH p AS (SELECT o_orderkey, upper(trim(c_name)) AS brand, {norm('o_orderpriority')} AS name FROM orders JOIN customer ON c_custkey = o_custkey) SELECT o_orderkey AS input, min(o_orderkey) OVER (PARTITION BY brand, name) AS product_id FROM p")
def identity_match(spark, d):
    o = read(spark, d, "orders").join(read(spark, d, "customer"), F.col("c_custkey") == F.col("o_custkey"))
    inputs = o.select(F.col("o_orderkey").alias("input"), F.col("c_name").alias("brand"), F.col("o_orderpriority").alias("name"))
    return formulas.identity_match(inputs, inputs.withColumnRenamed("input", "product_id"))


# --------------------------------------------------------------------------- names and similarity


@query(f"SELECT doc_id, md5({norm('text')}) AS normalized_md5, length({norm('text')}) AS n FROM documents")
def normalize_text(spark, d):
    docs = read(spark, d, "documents").withColumn("t", tx.inci_normalize("text"))
    return docs.select("doc_id", F.md5("t").alias("normalized_md5"), F.length("t").cast("long").alias("n"))


@query("SELECT c_custkey, trim(regexp_replace(lower(strip_accents(c_name || ' (' || c_mktsegment || ')')), '[^a-z0-9]+', '-', 'g'), '-') AS slug, trim(regexp_replace(lower(strip_accents(c_name || ' (' || c_mktsegment || ')')), '[^a-z0-9]+', '-', 'g'), '-') || '-' || substr(md5(c_name || ' (' || c_mktsegment || ')'), 1, 6) AS hashed FROM customer")
def slugify(spark, d):
    named = read(spark, d, "customer").withColumn("x", F.concat("c_name", F.lit(" ("), "c_mktsegment", F.lit(")")))
    return named.select("c_custkey", tx.slug("x").alias("slug"), tx.hashed_slug("x").alias("hashed"))


@query("WITH s AS (SELECT p_partkey, p_name, trim(regexp_replace(lower(p_name), '[^a-z0-9]+', '-', 'g'), '-') AS b FROM part) SELECT p_partkey, CASE WHEN row_number() OVER (PARTITION BY b ORDER BY p_partkey) = 1 THEN b ELSE b || '-' || substr(sha1(p_name), 1, 6) END AS slug FROM s")
def unique_slugs(spark, d):
    return tx.unique_slugs(read(spark, d, "part").select("p_partkey", "p_name"), "p_name", ["p_partkey"]).select("p_partkey", "slug")


@query("SELECT p_brand, upper(trim(regexp_replace(p_brand || '   of ', '\\s+', ' ', 'g'))) AS brand, count(*) AS n FROM part GROUP BY 1, 2")
def brand_key(spark, d):
    return read(spark, d, "part").groupBy("p_brand", tx.brand_key(F.concat("p_brand", F.lit("   of "))).alias("brand")).agg(F.count("*").alias("n"))


@query(f"WITH n AS (SELECT DISTINCT {norm('p_name')} AS name FROM part), t AS (SELECT DISTINCT substr(name, 1, length(name) - 1) AS name FROM n) SELECT t.name AS a, n.name AS b, round({jac('t.name', 'n.name')}, 6) AS similarity FROM t, n WHERE {jac('t.name', 'n.name')} > 0.3")
def trigram_jaccard_join(spark, d):
    n = read(spark, d, "part").select(tx.inci_normalize("p_name").alias("name")).distinct()
    return matching.similarity_join(n.select(F.expr("substring(name, 1, length(name) - 1)")), n, 0.3).withColumn("similarity", F.round("similarity", 6))


@query(f"WITH n AS (SELECT DISTINCT {norm('p_name')} AS name FROM part), t AS (SELECT DISTINCT substr(name, 1, length(name) - 1) AS name FROM n) SELECT t.name AS a, n.name AS b, round({dice('t.name', 'n.name')}, 6) AS similarity FROM t, n WHERE {dice('t.name', 'n.name')} > 0.5")
def trigram_dice_join(spark, d):
    n = read(spark, d, "part").select(tx.inci_normalize("p_name").alias("name")).distinct()
    return matching.similarity_join(n.select(F.expr("substring(name, 1, length(name) - 1)")), n, 0.5, "dice").withColumn("similarity", F.round("similarity", 6))


PAIRS = "p AS (SELECT DISTINCT p_name AS a, p_brand || ' ' || p_name AS b FROM part UNION SELECT DISTINCT p_name, p_type FROM part)"


def name_pairs(spark, d) -> DataFrame:
    p = read(spark, d, "part")
    return p.select(F.col("p_name").alias("a"), F.concat_ws(" ", "p_brand", "p_name").alias("b")).union(p.select("p_name", "p_type")).distinct()


@query(f"WITH {PAIRS} SELECT a, b, levenshtein(a, b) AS distance FROM p")
def levenshtein_pairs(spark, d):
    return name_pairs(spark, d).select("a", "b", F.levenshtein("a", "b").cast("long").alias("distance"))


@query(f"WITH {PAIRS}, w AS (SELECT a, b, list_distinct(string_split(a, ' ')) AS x, list_distinct(string_split(b, ' ')) AS y FROM p) SELECT a, b, round(len(list_intersect(x, y)) * 1.0 / (len(x) + len(y) - len(list_intersect(x, y))), 6) AS overlap FROM w")
def token_overlap(spark, d):
    return name_pairs(spark, d).select("a", "b", F.round(sim.token_jaccard("a", "b"), 6).alias("overlap"))


@query("SELECT CASE WHEN l_quantity / 50.0 >= 0.92 THEN 'keep' WHEN l_quantity / 50.0 >= 0.80 THEN 'review' ELSE 'reject' END AS bucket, count(*) AS n FROM lineitem GROUP BY 1")
def confidence_bucket(spark, d):
    return read(spark, d, "lineitem").groupBy(sim.confidence_bucket(F.col("l_quantity") / 50.0).alias("bucket")).agg(F.count("*").alias("n"))


@query("SELECT n_nationkey, regexp_replace(lower(n_name || ' (Área 51)'), '[^a-z0-9]', '', 'g') AS diff_key FROM nation")
def diff_keys(spark, d):
    return read(spark, d, "nation").select("n_nationkey", tx.diff_key(F.concat("n_name", F.lit(" (Área 51)"))).alias("diff_key"))


# --------------------------------------------------------------------------- index and matching


@query(f"WITH {CATALOG}, {ALIASES}, t AS (SELECT {norm('name')} AS term, id, 'canonical' AS source, 0 AS p FROM catalog UNION ALL SELECT {norm('alias')}, id, 'alias', CASE WHEN source = 'manual' THEN 1 ELSE 2 END FROM aliases) SELECT term, id, source FROM (SELECT *, row_number() OVER (PARTITION BY term ORDER BY p, id) AS k FROM t WHERE term <> '') WHERE k = 1")
def term_index_priority(spark, d):
    return matching.term_index(catalog(spark, d), aliases(spark, d))


MATCH = f"""{CATALOG}, {ALIASES}, {TOKENS}, terms AS (SELECT DISTINCT {norm('token')} AS term FROM tokens), c AS (SELECT {norm('name')} AS term, min(id) AS id FROM catalog GROUP BY 1), l AS (SELECT {norm('alias')} AS term, min(id) AS id FROM aliases GROUP BY 1),
    pool AS (SELECT term, id, 0 AS kind FROM c UNION ALL SELECT term, id, 1 FROM l), rest AS (SELECT term FROM terms WHERE term <> '' AND term NOT IN (SELECT term FROM c) AND term NOT IN (SELECT term FROM l)),
    near AS (SELECT r.term, p.id, p.kind, {jac('r.term', 'p.term')} AS s FROM rest r, pool p),
    matched AS (SELECT term, id, 'canonical_exact' AS match_type, 1.0 AS confidence FROM terms JOIN c USING (term) UNION ALL SELECT term, id, 'alias_exact', 0.98 FROM terms JOIN l USING (term) WHERE term NOT IN (SELECT term FROM c)
    UNION ALL SELECT term, id, CASE kind WHEN 0 THEN 'canonical_fuzzy' ELSE 'alias_fuzzy' END, s FROM (SELECT *, row_number() OVER (PARTITION BY term ORDER BY round(s, 9) DESC, kind, id) AS k FROM near WHERE s > 0.3) WHERE k = 1)"""


@query(f"WITH {MATCH} SELECT term, id, match_type, round(confidence, 6)::DOUBLE AS confidence FROM matched")
def match_cascade(spark, d):
    return matching.match(tokens(spark, d), catalog(spark, d), aliases(spark, d)).withColumn("confidence", F.round("confidence", 6))


@query(f"WITH {CATALOG}, {ALIASES}, {TOKENS}, x AS (SELECT {norm('name')} AS term FROM catalog UNION SELECT {norm('alias')} FROM aliases) SELECT {norm('token')} AS term, count(*) AS n FROM tokens WHERE {norm('token')} NOT IN (SELECT term FROM x) GROUP BY 1 ORDER BY n DESC, term LIMIT 5000")
def unmatched_topn(spark, d):
    return matching.unmatched_counts(tokens(spark, d), matching.term_index(catalog(spark, d), aliases(spark, d)))


@query(f"WITH {MATCH} SELECT DISTINCT id, token AS alias, round(confidence, 6)::DOUBLE AS confidence FROM tokens JOIN matched ON term = {norm('token')} WHERE confidence >= 0.92")
def alias_harvest(spark, d):
    t = tokens(spark, d)
    return matching.harvest_aliases(t, matching.match(t, catalog(spark, d), aliases(spark, d))).withColumn("confidence", F.round("confidence", 6))


@query(f"WITH {CATALOG}, {ALIASES}, {TOKENS}, n AS (SELECT {norm('name')} AS term, min(id) AS id FROM catalog GROUP BY 1) SELECT {norm('token')} AS term, min(id) AS id, count(*) AS n FROM tokens JOIN n ON term = {norm('token')} GROUP BY 1")
def exact_match(spark, d):
    t = tokens(spark, d).select(tx.inci_normalize("token").alias("term"))
    n = catalog(spark, d).groupBy(tx.inci_normalize("name").alias("term")).agg(F.min("id").alias("id"))
    return t.groupBy("term").agg(F.count("*").alias("n")).join(n, "term").select("term", "id", "n")


SPELL = f"""n AS (SELECT {norm('p_name')} AS name, min(p_partkey) AS id FROM part GROUP BY 1), s AS (SELECT id + 1000000 AS id, substr(name, 1, length(name) - 1) AS name FROM n),
    q AS (SELECT s.id AS source_id, s.name AS source, n.id AS target_id, n.name AS target, {dice('s.name', 'n.name')} AS similarity, levenshtein(s.name, n.name) AS edit_distance FROM s, n WHERE s.name <> n.name),
    r AS (SELECT *, row_number() OVER w AS rank, lead(similarity) OVER w AS nxt FROM q WHERE similarity > 0.72 - 1e-9 WINDOW w AS (PARTITION BY source_id ORDER BY round(similarity, 9) DESC, edit_distance, target_id))"""


def spelling(spark, d) -> DataFrame:
    n = read(spark, d, "part").groupBy(tx.inci_normalize("p_name").alias("name")).agg(F.min("p_partkey").alias("id"))
    return matching.spelling_candidates(n.select((F.col("id") + 1_000_000).alias("id"), F.expr("substring(name, 1, length(name) - 1)").alias("name")), n)


@query(f"WITH {SPELL} SELECT source_id, source, target_id, target, round(similarity, 6) AS similarity, edit_distance, rank, CASE WHEN rank = 1 THEN round(similarity - coalesce(nxt, 0), 6) END AS score_margin FROM r")
def spelling_margin(spark, d):
    s = spelling(spark, d).drop("token_overlap").withColumn("edit_distance", F.col("edit_distance").cast("long")).withColumn("rank", F.col("rank").cast("long"))
    return s.withColumn("similarity", F.round("similarity", 6)).withColumn("score_margin", F.round("score_margin", 6))


# --------------------------------------------------------------------------- lists


@query(
    f"""WITH {LINES}, k AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_partkey ORDER BY l_quantity DESC, position) AS n, min(position) OVER (PARTITION BY l_orderkey, l_partkey) AS f FROM lines)
    SELECT l_orderkey, l_partkey, l_quantity, row_number() OVER (PARTITION BY l_orderkey ORDER BY f) AS position FROM k WHERE n = 1"""
)
def dedupe_list_keep_best(spark, d):
    out = lists.keep_best(lines(spark, d), "l_orderkey", "l_partkey", [-F.col("l_quantity"), F.col("position")])
    return out.select("l_orderkey", "l_partkey", "l_quantity", F.col("position").cast("long").alias("position"))


@query("SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity) AS position FROM lineitem")
def renumber_positions(spark, d):
    rows = read(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity")
    return lists.renumber(rows, "l_orderkey", ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity"]).drop("l_quantity").withColumn("position", F.col("position").cast("long"))


@query("WITH n AS (SELECT l_orderkey, l_linenumber, l_partkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS expected FROM lineitem) SELECT * FROM n WHERE expected <> l_linenumber")
def gap_detect(spark, d):
    out = lists.gaps(read(spark, d, "lineitem"), "l_orderkey", ["l_linenumber", "l_partkey", "l_suppkey"], "l_linenumber")
    return out.select("l_orderkey", "l_linenumber", "l_partkey", F.col("expected").cast("long").alias("expected"))


@query(f"WITH {LINES}, m AS (SELECT l_orderkey, min(position) AS cut FROM lines WHERE l_returnflag = 'R' GROUP BY 1) SELECT l_orderkey, position, l_partkey FROM lines LEFT JOIN m USING (l_orderkey) WHERE cut IS NULL OR position < cut")
def truncate_after_marker(spark, d):
    return lists.truncate_at_marker(lines(spark, d), "l_orderkey", F.col("l_returnflag") == "R").select("l_orderkey", F.col("position").cast("long").alias("position"), "l_partkey")


@query(
    f"""WITH {LINES}, n AS (SELECT *, lead(l_returnflag) OVER w AS nxt FROM lines WINDOW w AS (PARTITION BY l_orderkey ORDER BY position)), p AS (SELECT *, coalesce(l_returnflag = 'A' AND nxt = 'N', false) AS pair FROM n),
    q AS (SELECT *, coalesce(lag(pair) OVER w, false) AS pb, coalesce(lead(pair) OVER w, false) AS pa FROM p WINDOW w AS (PARTITION BY l_orderkey ORDER BY position)), r AS (SELECT *, pair AND NOT pb AND NOT pa AS mg FROM q),
    s AS (SELECT *, coalesce(lag(mg) OVER (PARTITION BY l_orderkey ORDER BY position), false) AS gone FROM r), u AS (SELECT *, position - sum(gone::INT) OVER (PARTITION BY l_orderkey ORDER BY position) AS np FROM s)
    SELECT l_orderkey, np::BIGINT AS position, CASE WHEN mg THEN l_returnflag || ' ' || nxt ELSE l_returnflag END AS token FROM u WHERE NOT gone"""
)
def adjacent_pair_merge(spark, d):
    rows = lines(spark, d).select("l_orderkey", "position", F.col("l_returnflag").alias("token"))
    out = lists.merge_pairs(rows, "l_orderkey", "token", (F.col("token") == "A") & (F.col("next_token") == "N"))
    return out.select("l_orderkey", F.col("position").cast("long").alias("position"), "token")


@query(
    f"""WITH {LINES}, a AS (SELECT l_orderkey, list(l_returnflag ORDER BY position) AS v FROM lines GROUP BY 1), k(name, parts) AS (VALUES ('anr', ['A', 'N', 'R']), ('nn', ['N', 'N']), ('ra', ['R', 'A'])),
    h AS (SELECT l_orderkey, position, name, len(parts) AS length FROM lines JOIN a USING (l_orderkey), k WHERE v[position:position + len(parts) - 1] = parts)
    SELECT l_orderkey, position AS start, name, length FROM h x WHERE NOT EXISTS (SELECT 1 FROM h y WHERE y.l_orderkey = x.l_orderkey AND x.position < y.position + y.length AND y.position < x.position + x.length
      AND (y.length > x.length OR (y.length = x.length AND (y.position < x.position OR (y.position = x.position AND y.name < x.name)))))"""
)
def sequence_span_match(spark, d):
    known = spark.createDataFrame([("anr", ["A", "N", "R"]), ("nn", ["N", "N"]), ("ra", ["R", "A"])], "name string, parts array<string>")
    out = lists.find_sequences(lines(spark, d), "l_orderkey", "l_returnflag", known)
    return out.select("l_orderkey", F.col("start").cast("long").alias("start"), "name", F.col("length").cast("long").alias("length"))


RULES = [("^(economy|standard)", "plain"), ("small|tiny", "little"), ("ring|bolt", "hardware"), ("[0-9]{2,}", "numbered")]


@query("WITH t AS (SELECT p_name AS token FROM part UNION ALL SELECT p_type FROM part UNION ALL SELECT p_brand FROM part) SELECT token, CASE WHEN regexp_matches(token, '(?i)^(economy|standard)') THEN 'plain' WHEN regexp_matches(token, '(?i)small|tiny') THEN 'little' WHEN regexp_matches(token, '(?i)ring|bolt') THEN 'hardware' WHEN regexp_matches(token, '(?i)[0-9]{2,}') THEN 'numbered' ELSE 'other' END AS reason, count(*) AS n FROM t GROUP BY 1, 2")
def noise_purge_regex(spark, d):
    p = read(spark, d, "part")
    t = p.select(F.col("p_name").alias("token")).unionAll(p.select("p_type")).unionAll(p.select("p_brand"))
    return t.groupBy("token", lists.classify(RULES, "token", "other").alias("reason")).agg(F.count("*").alias("n"))


@query("WITH k(pattern, reason) AS (VALUES ('utm_|ref=', 'tracking'), ('#', 'fragment'), ('//(m|blog)\\.', 'subdomain')), h AS (SELECT url, min(reason) AS reason FROM pages JOIN k ON regexp_matches(url, '(?i)' || pattern) GROUP BY 1) SELECT page_id, url FROM pages WHERE url NOT IN (SELECT url FROM h)")
def pattern_table_purge(spark, d):
    k = spark.createDataFrame([("utm_|ref=", "tracking"), ("#", "fragment"), ("//(m|blog)\\.", "subdomain")], "pattern string, reason string")
    return lists.pattern_purge(read(spark, d, "pages").select("page_id", "url"), "url", k)[0].select("page_id", "url")


@query(f"WITH {CATALOG}, x AS (SELECT {norm('name')} AS term, min(id) AS id FROM catalog GROUP BY 1), c AS (SELECT p_partkey, 0 AS pr, split_part(p_name, ' ', 2) AS candidate FROM part UNION ALL SELECT p_partkey, 1, {norm('p_name')} FROM part UNION ALL SELECT p_partkey, 2, lower(p_type) FROM part) SELECT p_partkey, candidate, id FROM (SELECT *, row_number() OVER (PARTITION BY p_partkey ORDER BY pr, candidate, id) AS k FROM c JOIN x ON term = candidate) WHERE k = 1")
def candidate_priority_pick(spark, d):
    x = catalog(spark, d).groupBy(tx.inci_normalize("name").alias("term")).agg(F.min("id").alias("id"))
    return lists.priority_candidates(read(spark, d, "part"), "p_partkey", [F.split_part("p_name", F.lit(" "), F.lit(2)), tx.inci_normalize("p_name"), F.lower("p_type")], x)


# --------------------------------------------------------------------------- tables


@query(
    f"""WITH e AS (SELECT p_partkey AS id, {norm('p_name')} AS k FROM part), a AS (SELECT l_partkey AS id, count(*) AS n FROM lineitem GROUP BY 1),
    w AS (SELECT id, k, first_value(id) OVER (PARTITION BY k ORDER BY coalesce(n, 0) DESC, id) AS winner FROM e LEFT JOIN a USING (id))
    SELECT winner AS id, k AS normalized_name, count(DISTINCT w.id) AS n_entries, count(l_partkey) AS n_items FROM w LEFT JOIN lineitem ON l_partkey = w.id GROUP BY 1, 2"""
)
def merge_duplicates(spark, d):
    p = read(spark, d, "part")
    entries = p.select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.col("p_partkey").alias("created_at"), tx.inci_normalize("p_name").alias("normalized_name"))
    items = read(spark, d, "lineitem").select(F.col("l_partkey").alias("id"), "l_orderkey")
    # each line counts as an alias here, so the most used entry wins
    known = items.select("id", F.concat(F.lit("a"), F.col("l_orderkey").cast("string")).alias("alias"))
    to = tables.winners(entries, known, "normalized_name")
    merged = tables.merge_duplicates({"entries": entries, "aliases": known, "items": items})
    n_items = merged["items"].groupBy("id").agg(F.count("*").alias("n_items"))
    n_entries = to.groupBy(F.col("winner").alias("id")).agg(F.count("*").alias("n_entries"))
    return merged["entries"].select("id", "normalized_name").join(n_entries, "id").join(n_items, "id", "left").fillna({"n_items": 0}).select("id", "normalized_name", "n_entries", "n_items")


@query("SELECT s_suppkey AS id, s_name AS name FROM supplier UNION ALL SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT s_suppkey FROM supplier)")
def upsert_do_nothing(spark, d):
    s, c = read(spark, d, "supplier"), read(spark, d, "customer")
    return tables.insert_missing(s.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name")), c.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name")), ["id"])


@query("SELECT coalesce(s_suppkey, c_custkey) AS id, coalesce(c_name, s_name) AS name, CASE WHEN c_custkey IS NULL THEN 'supplier=' || s_nationkey WHEN s_suppkey IS NULL THEN 'customer=' || c_nationkey ELSE 'customer=' || c_nationkey || ',supplier=' || s_nationkey END AS info FROM supplier FULL JOIN customer ON s_suppkey = c_custkey")
def upsert_merge_map(spark, d):
    s = read(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.create_map(F.lit("supplier"), F.col("s_nationkey").cast("string")).alias("info"))
    c = read(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.create_map(F.lit("customer"), F.col("c_nationkey").cast("string"), F.lit("none"), F.lit(None).cast("string")).alias("info"))
    out = tables.upsert(s, c, ["id"], maps=("info",))
    clean = F.map_filter("info", lambda _, v: v.isNotNull())
    return out.select("id", "name", F.array_join(F.transform(F.array_sort(F.map_entries(clean)), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ",").alias("info"))


@query("SELECT coalesce(s_suppkey, c_custkey) AS id, coalesce(s_name, c_name) AS name, coalesce(s_acctbal, c_acctbal) AS acctbal FROM supplier FULL JOIN customer ON s_suppkey = c_custkey")
def full_outer_backfill(spark, d):
    s = read(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("acctbal"))
    c = read(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("acctbal"))
    return tables.full_outer_backfill(s, c, "id", ["name", "acctbal"])


@query("SELECT count(s_suppkey) AS n_left, count(c_custkey) AS n_right, count(*) FILTER (WHERE c_custkey IS NULL) AS only_left, count(*) FILTER (WHERE s_suppkey IS NULL) AS only_right, count(*) FILTER (WHERE s_suppkey IS NOT NULL AND c_custkey IS NOT NULL AND s_nationkey IS DISTINCT FROM c_nationkey) AS different FROM supplier FULL JOIN customer ON s_suppkey = c_custkey")
def backfill_parity_check(spark, d):
    s = read(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_nationkey").alias("nation"))
    return tables.parity(s, read(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("nation")), "id", ["nation"])


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)")
def delete_using(spark, d):
    gone = read(spark, d, "customer").where("c_acctbal < 0").select(F.col("c_custkey").alias("o_custkey"))
    return tables.delete_using(read(spark, d, "orders").select("o_orderkey", "o_custkey"), gone, ["o_custkey"])


@query("SELECT c_custkey, CASE WHEN s_suppkey IS NOT NULL THEN s_name ELSE c_name END AS c_name FROM customer LEFT JOIN supplier ON s_suppkey = c_custkey")
def update_from(spark, d):
    new = read(spark, d, "supplier").select(F.col("s_suppkey").alias("c_custkey"), F.col("s_name").alias("c_name"))
    return tables.update_from(read(spark, d, "customer").select("c_custkey", "c_name"), new, ["c_custkey"], ["c_name"])


@query("SELECT user_id, arg_max(event_type, event_id) AS event_type FROM events GROUP BY 1")
def latest_trigger_per_item(spark, d):
    return tables.latest(read(spark, d, "events"), "user_id", ["event_id"], "event_type")


# --------------------------------------------------------------------------- policy


@query(
    f"""WITH {SPELL}, b AS (SELECT source_id, target_id, target, source, similarity, edit_distance, similarity - coalesce(nxt, 0) AS margin FROM r WHERE rank = 1),
    al AS (SELECT {norm("p_brand || ' ' || p_type")} AS name, p_partkey AS id FROM part), c AS (SELECT id, name FROM s UNION ALL SELECT id + 2000000, name FROM n UNION ALL SELECT id + 3000000, name FROM al),
    same AS (SELECT c.id, min(n.id) AS t FROM c JOIN n ON n.name = c.name WHERE c.id >= 1000000 GROUP BY 1), ac AS (SELECT name, count(DISTINCT id) AS k, min(id) AS t FROM al GROUP BY 1)
    SELECT c.id, CASE WHEN same.t IS NOT NULL THEN 'merge_into_existing' WHEN k = 1 THEN 'alias_to_existing' WHEN k > 1 THEN 'needs_human'
      WHEN margin >= 0.05 AND CASE WHEN length(target) <= 8 THEN edit_distance <= 1 AND similarity >= 0.80 WHEN length(target) <= 20 THEN edit_distance <= 2 OR similarity >= 0.92 ELSE similarity >= 0.88 AND false END THEN 'merge_into_existing' ELSE 'needs_human' END AS decision,
      CASE WHEN same.t IS NOT NULL THEN same.t WHEN k = 1 THEN ac.t WHEN k > 1 THEN NULL WHEN margin >= 0.05 AND CASE WHEN length(target) <= 8 THEN edit_distance <= 1 AND similarity >= 0.80 WHEN length(target) <= 20 THEN edit_distance <= 2 OR similarity >= 0.92 ELSE false END THEN target_id END::VARCHAR AS target_id
    FROM c LEFT JOIN same USING (id) LEFT JOIN ac ON ac.name = c.name LEFT JOIN b ON b.source_id = c.id"""
)
def deterministic_decision(spark, d):
    p = read(spark, d, "part")
    n = p.groupBy(tx.inci_normalize("p_name").alias("name")).agg(F.min("p_partkey").alias("id"))
    al = p.select(tx.inci_normalize(F.concat_ws(" ", "p_brand", "p_type")).alias("name"), F.col("p_partkey").alias("id"))
    at = lambda df, k: df.select((F.col("id") + k).alias("id"), "name")
    cut = n.select("id", F.expr("substring(name, 1, length(name) - 1)").alias("name"))
    c = at(cut, 1_000_000).union(at(n, 2_000_000)).union(at(al, 3_000_000))
    collisions = c.join(n.select("name", F.col("id").alias("target_id")), "name").select("id", "target_id", F.col("target_id").alias("created_at"), F.col("name").alias("canonical"))
    evidence = spark.createDataFrame([], "id long, seq int, source string, found boolean, lookup_type string, canonical string, confidence double")
    out = policy.decide(c, collisions, policy.alias_targets(c, al.select("name", F.col("id").alias("target_id"))), evidence, spelling(spark, d))
    return out.select("id", "decision", "target_id")


@query("SELECT CASE WHEN l_returnflag <> 'N' AND l_discount * 10 >= 0.90 - 1e-12 THEN 'not_required' ELSE 'pending_human' END AS status, count(*) AS n FROM lineitem GROUP BY 1")
def review_status(spark, d):
    decision = F.when(F.col("l_returnflag") == "N", "needs_human").otherwise("keep")
    return read(spark, d, "lineitem").groupBy(policy.review_status(decision, F.col("l_discount") * 10 + 1e-12).alias("status")).agg(F.count("*").alias("n"))


@query(
    """WITH x AS (SELECT l_orderkey, sum((l_returnflag = 'A')::INT) AS a, sum((l_returnflag = 'N')::INT) AS n, count(*) AS k FROM lineitem GROUP BY 1), v AS (SELECT *, CASE WHEN k = 1 THEN 'not_found' WHEN a = 0 THEN 'untrusted_source' WHEN n = 0 THEN 'no_list' WHEN (a + n) * 1.0 / k >= 0.9 THEN CASE WHEN a > n THEN 'name_resolved' ELSE 'verified' END ELSE 'divergent' END AS verdict FROM x)
    SELECT l_orderkey, verdict, CASE WHEN verdict = 'verified' AND k < 5 THEN 'decision_ready' ELSE 'pending_human' END AS status,
    CASE WHEN verdict = 'verified' AND k < 5 THEN NULL WHEN verdict = 'name_resolved' THEN 'product_name_resolved' WHEN k >= 5 THEN 'unresolved_tokens' ELSE CASE verdict WHEN 'not_found' THEN 'product_not_found' WHEN 'untrusted_source' THEN 'product_source_untrusted' WHEN 'no_list' THEN 'product_ingredient_list_missing' WHEN 'divergent' THEN 'divergent_list' ELSE 'verification_incomplete' END END AS trigger FROM v"""
)
def product_verdict(spark, d):
    x = read(spark, d, "lineitem").groupBy("l_orderkey").agg(F.count_if(F.col("l_returnflag") == "A").alias("a"), F.count_if(F.col("l_returnflag") == "N").alias("n"), F.count("*").alias("k"))
    share = (F.col("a") + F.col("n")) / F.col("k")
    v = x.withColumn("verdict", policy.product_verdict(F.lit(True), F.col("k") > 1, F.col("a") > 0, F.col("n"), share, share, F.col("a") > F.col("n")))
    pending, junk = F.col("k") >= 5, F.lit(False)
    return v.select("l_orderkey", "verdict", policy.final_status(F.col("verdict"), pending, junk).alias("status"), policy.final_trigger(F.col("verdict"), pending, junk, F.array().cast("array<string>")).alias("trigger"))


@query(
    """SELECT o_orderkey, CASE WHEN count(l_orderkey) = 0 THEN 'failed' WHEN o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' THEN 'duplicate' WHEN o_orderpriority = '2-HIGH' THEN 'same_name_different_formula' WHEN o_orderstatus = 'P' AND o_orderpriority <> '5-LOW' THEN 'similar_product' ELSE 'verifying' END AS route
    FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey, o_orderstatus, o_orderpriority"""
)
def intake_route(spark, d):
    n = read(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("n"))
    o = read(spark, d, "orders").join(n, "o_orderkey", "left")
    is_ = lambda c, v: F.col(c) == v
    route = policy.intake_route(F.coalesce("n", F.lit(0)), is_("o_orderstatus", "F"), is_("o_orderpriority", "1-URGENT"), F.when(is_("o_orderpriority", "2-HIGH"), 1), is_("o_orderstatus", "P"), is_("o_orderpriority", "5-LOW"))
    return o.select("o_orderkey", route.alias("route"))


@query("SELECT p_partkey, CASE WHEN p_size % 10 = 0 THEN 'set' WHEN p_type = 'ECONOMY' THEN 'all,dry' WHEN p_type = 'SMALL' THEN 'acne_prone,oily' ELSE '' END AS skin FROM part")
def classify_tags(spark, d):
    f = F.when(F.col("p_type") == "ECONOMY", F.array(F.lit("humectant"), F.lit("emollient"))).when(F.col("p_type") == "SMALL", F.array(F.lit("exfoliating"))).otherwise(F.array(F.lit("solvent")))
    present = F.when(F.col("p_size") % 10 == 0, F.array(F.lit("set"))).otherwise(F.array().cast("array<string>"))
    return read(spark, d, "part").select("p_partkey", F.array_join(policy.tags(f, policy.SKIN_TYPES, present), ",").alias("skin"))


# --------------------------------------------------------------------------- pages, JSON, labels


@query("SELECT page_id, nullif(trim(regexp_replace(replace(replace(replace(replace(replace(replace(regexp_replace(regexp_extract(html, '(?is)<title\\b[^>]*>(.*?)</title\\s*>', 1), '<[^>]*>', ' ', 'g'), '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&#39;', ''''), '&middot;', '·'), '&amp;', '&'), '\\s+', ' ', 'g')), '') AS title, nullif(trim(regexp_replace(replace(replace(replace(replace(replace(regexp_replace(regexp_extract(html, '(?is)<h1\\b[^>]*>(.*?)</h1\\s*>', 1), '<[^>]*>', ' ', 'g'), '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&#39;', ''''), '&amp;', '&'), '\\s+', ' ', 'g')), '') AS h1 FROM pages")
def html_title_h1(spark, d):
    return read(spark, d, "pages").select("page_id", web.element_text("html", "title").alias("title"), web.element_text("html", "h1").alias("h1"))


@query("WITH h AS (SELECT page_id, CASE WHEN starts_with(url, 'https://') THEN regexp_replace(lower(regexp_extract(url, '^https://([^/?#:]+)', 1)), '^www\\.', '') END AS h FROM pages) SELECT page_id, h AS host, coalesce(h = 'example.com' OR h LIKE '%.example.com' OR h LIKE '%.example.org', false) AS trusted FROM h")
def trusted_domain_match(spark, d):
    domains = F.array(F.lit("example.com"), F.lit("WWW.example.org."))
    return read(spark, d, "pages").select("page_id", web.host("url").alias("host"), policy.trusted(F.col("url"), domains).alias("trusted"))


@query("SELECT event_type, sum(json_extract_string(props, '$.k')::BIGINT) AS k, count(*) FILTER (WHERE json_extract_string(props, '$.none') IS NULL) AS n FROM events GROUP BY 1")
def json_props_extract(spark, d):
    e = read(spark, d, "events")
    return e.groupBy("event_type").agg(F.sum(F.get_json_object("props", "$.k").cast("long")).alias("k"), F.count_if(F.get_json_object("props", "$.none").isNull()).alias("n"))


# --------------------------------------------------------------------------- queue

QUEUE = "q AS (SELECT event_id AS id, CASE event_type WHEN 'view' THEN 'received' WHEN 'click' THEN 'verifying' WHEN 'error' THEN 'failed' WHEN 'purchase' THEN 'applied' ELSE 'submitted' END AS status, ts AS created_at, ts AS locked_at, ts AS updated_at, (value::INT % 5)::INT AS attempt_count FROM events)"
NOW = "2024-01-20 00:00:00"


def submissions(spark, d) -> DataFrame:
    states = F.when(F.col("event_type") == "view", "received").when(F.col("event_type") == "click", "verifying").when(F.col("event_type") == "error", "failed").when(F.col("event_type") == "purchase", "applied").otherwise("submitted")
    # half-way values round to even in the SQL engine, as bround does
    tries = (F.bround("value").cast("int") % 5).cast("int")
    return read(spark, d, "events").select(F.col("event_id").alias("id"), states.alias("status"), F.col("ts").alias("created_at"), F.col("ts").alias("locked_at"), F.col("ts").alias("updated_at"), tries.alias("attempt_count"), F.lit(None).cast("timestamp").alias("processed_at"), F.lit(None).cast("string").alias("last_error"))


@query(f"WITH {QUEUE} SELECT id, 'processing' AS status, attempt_count + 1 AS attempt_count FROM q WHERE status = 'received' ORDER BY created_at, id LIMIT 25")
def claim_fifo(spark, d):
    return queue.claim(submissions(spark, d), "received", "processing", 25, F.lit(NOW).cast("timestamp")).select("id", "status", "attempt_count")


@query(f"WITH {QUEUE} SELECT status, n FROM (SELECT CASE WHEN status = 'verifying' AND locked_at < TIMESTAMP '{NOW}' - INTERVAL 30 MINUTE THEN CASE WHEN attempt_count >= 3 THEN 'failed' ELSE 'received' END ELSE status END AS status, count(*) AS n FROM q GROUP BY 1)")
def stale_release(spark, d):
    out = queue.release_stale(submissions(spark, d), "verifying", "received", F.lit(NOW).cast("timestamp"))
    return out.groupBy("status").agg(F.count("*").alias("n"))


@query(f"WITH {QUEUE} SELECT id, CASE WHEN status = 'submitted' THEN CASE WHEN attempt_count >= 3 THEN 'failed' ELSE 'received' END ELSE status END AS status FROM q")
def retry_dead_letter(spark, d):
    q = submissions(spark, d)
    return queue.fail(q, q.where("status = 'submitted'").select("id", F.lit("no answer").alias("error")), "received").select("id", "status")


@query(f"WITH {QUEUE} SELECT id, status FROM q WHERE NOT (status IN ('duplicate', 'applied', 'rejected', 'failed') AND updated_at < TIMESTAMP '{NOW}' - INTERVAL 7 DAY)")
def retention_purge(spark, d):
    return queue.purge(submissions(spark, d), F.lit(NOW).cast("timestamp"), days=7).select("id", "status")


@query("SELECT event_id, user_id FROM events WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-11'")
def date_window_backfill(spark, d):
    return queue.window_enqueue(read(spark, d, "events"), "ts", web.end_of_day(F.lit("2024-01-05")), web.end_of_day(F.lit("2024-01-10"), end=True)).select("event_id", "user_id")
