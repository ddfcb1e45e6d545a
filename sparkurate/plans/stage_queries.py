"""Further queries over the driver's tables with their SQL: keys, evidence, judgments, review, seeding, repairs and queue steps.

Inputs that no table has (answers of a model, pages' findings) are written from columns by one
expression that Spark and the plain engine both read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import similarity as sim
from ..functions import text as tx
from ..functions import web
from ..operators import formulas, lists, matching, policy, tables
from ..sources import lookups
from ..streaming import queue
from . import seed, submissions
from .queries import ALIASES, CATALOG, LINES, MATCH, QUEUE, SPELL, aliases, catalog, dice, lines, norm, query, read, spelling, tokens
from .queries import submissions as queued

# --------------------------------------------------------------------------- names and keys


@query(f"SELECT doc_id, md5(coalesce({norm('text')}, '')) AS name_md5 FROM documents")
def normalized_names(spark, d):
    return read(spark, d, "documents").select("doc_id", F.md5(tx.normalize_name("text")).alias("name_md5"))


BRANDS = "CASE p_size % 4 WHEN 0 THEN ' , ; ' || p_brand || ',x' WHEN 1 THEN p_brand || ';' || p_type WHEN 2 THEN ' ; ,' ELSE p_brand END"


@query(f"SELECT p_partkey, list_filter(list_transform(string_split_regex({BRANDS}, '[,;]'), lambda x: trim(x)), lambda x: x <> '')[1] AS brand FROM part")
def first_brand(spark, d):
    return read(spark, d, "part").select("p_partkey", tx.first_brand(F.expr(BRANDS)).alias("brand"))


SLUG = "trim(regexp_replace(lower(b || ' ' || n), '[^a-z0-9]+', '-', 'g'), '-')"


@query(f"WITH x AS (SELECT p_partkey, CASE WHEN p_size % 5 = 0 THEN '#' ELSE p_brand END AS b, CASE WHEN p_size % 5 = 0 THEN '/' ELSE p_name END AS n FROM part) SELECT p_partkey, CASE WHEN {SLUG} = '' THEN substr(sha1(b || '|' || n), 1, 6) ELSE {SLUG} END AS slug FROM x")
def product_slugs(spark, d):
    five = F.col("p_size") % 5 == 0
    return read(spark, d, "part").select("p_partkey", tx.product_slug(F.when(five, "#").otherwise(F.col("p_brand")), F.when(five, "/").otherwise(F.col("p_name"))).alias("slug"))


@query(
    f"""WITH x AS (SELECT p_partkey, p_name || ' (Aqua/' || p_type || ')' AS c FROM part), s AS (SELECT p_partkey, string_split(array_to_string(list_concat([c], regexp_extract_all(c, '\\(([^)]*)\\)', 1), [regexp_replace(c, '\\([^)]*\\)', ' ', 'g')]), '/'), '/') AS l FROM x),
    n AS (SELECT p_partkey, list_transform(l, lambda x: {norm('x')}) AS l FROM s)
    SELECT p_partkey, array_to_string(list_sort(list_distinct(list_filter(list_transform(l, lambda x: CASE WHEN x IN ('aqua', 'water', 'eau') THEN 'water' ELSE x END), lambda x: x <> ''))), '|') AS spellings FROM n"""
)
def overlap_alternatives(spark, d):
    p = read(spark, d, "part").select("p_partkey", F.concat("p_name", F.lit(" (Aqua/"), "p_type", F.lit(")")).alias("x"))
    return p.select("p_partkey", F.array_join(F.array_sort(tx.overlap_alternatives("x")), "|").alias("spellings"))


PUBLISHED = "p_brand || ' ' || p_name || CASE p_size % 3 WHEN 0 THEN ' Plus' WHEN 1 THEN ' ' || p_name ELSE '' END"


@query(
    f"""WITH x AS (SELECT p_partkey, {norm('p_name')} AS own, {norm(PUBLISHED)} AS new, {norm('p_brand')} AS maker FROM part), y AS (SELECT p_partkey, own, CASE WHEN maker <> '' AND starts_with(new, maker || ' ') THEN trim(substr(new, length(maker) + 1)) ELSE new END AS new FROM x)
    SELECT p_partkey, own <> '' AND new <> '' AND own <> new AND len(list_filter(string_split(new, ' '), lambda w: NOT list_contains(string_split(own, ' '), w))) > 0 AS renamed FROM y"""
)
def renames(spark, d):
    return read(spark, d, "part").select("p_partkey", tx.is_rename("p_name", F.expr(PUBLISHED), "p_brand").alias("renamed"))


WORDS = "CASE p_size % 4 WHEN 0 THEN ' seed oil' WHEN 1 THEN ' leaf extract' WHEN 2 THEN ' oil' ELSE '' END"
MODIFIERS = "['" + "', '".join(sim.MODIFIERS) + "']"


@query(f"WITH x AS (SELECT p_partkey, lower(p_name) || {WORDS} AS a, CASE WHEN p_partkey % 2 = 0 THEN lower(p_name) || ' oil' ELSE 'oil seed ' || lower(p_name) END AS b FROM part) SELECT p_partkey, list_sort(list_intersect({MODIFIERS}, string_split(a, ' '))) <> list_sort(list_intersect({MODIFIERS}, string_split(b, ' '))) AS differ FROM x")
def modifiers_differ(spark, d):
    a = F.concat(F.lower("p_name"), F.expr(WORDS))
    b = F.when(F.col("p_partkey") % 2 == 0, F.concat(F.lower("p_name"), F.lit(" oil"))).otherwise(F.concat(F.lit("oil seed "), F.lower("p_name")))
    return read(spark, d, "part").select("p_partkey", sim.modifiers_differ(a, b).alias("differ"))


TOKEN_OVERLAP = "(len(list_intersect(list_distinct(string_split(source, ' ')), list_distinct(string_split(target, ' ')))) * 1.0 / (len(list_distinct(string_split(source, ' '))) + len(list_distinct(string_split(target, ' '))) - len(list_intersect(list_distinct(string_split(source, ' ')), list_distinct(string_split(target, ' '))))))"


@query(
    f"""WITH {SPELL}, o AS (SELECT *, {TOKEN_OVERLAP} AS overlap, CASE WHEN rank = 1 THEN similarity - coalesce(nxt, 0) END AS margin FROM r)
    SELECT source_id, target_id, round(overlap, 6) AS token_overlap, coalesce(margin, 1.0) >= 0.05 AND CASE WHEN length(target) <= 8 THEN edit_distance <= 1 AND similarity >= 0.80 WHEN length(target) <= 20 THEN edit_distance <= 2 OR similarity >= 0.92 ELSE similarity >= 0.88 AND overlap >= 0.60 END AS merges FROM o"""
)
def spelling_merge(spark, d):
    c = F.col
    merges = sim.is_spelling_merge(c("source"), c("target"), c("similarity"), c("edit_distance"), c("token_overlap"), c("score_margin"))
    return spelling(spark, d).select("source_id", "target_id", F.round("token_overlap", 6).alias("token_overlap"), merges.alias("merges"))


@query("SELECT c_custkey, regexp_extract_all(c_name, '(\\d+)', 1) = regexp_extract_all(s_name, '(\\d+)', 1) AS same FROM customer JOIN supplier ON s_suppkey = c_custkey % 10 + 1")
def same_numbers(spark, d):
    met = read(spark, d, "customer").join(read(spark, d, "supplier"), F.col("s_suppkey") == F.col("c_custkey") % 10 + 1)
    return met.select("c_custkey", formulas.same_numbers("c_name", "s_name").alias("same"))


@query(
    f"""WITH RECURSIVE {CATALOG}, typed AS (SELECT DISTINCT substr(p_name, 1, 2) || substr(p_name, 4, 5) AS query FROM part UNION SELECT DISTINCT substr(p_name, 1, length(p_name) - 2) FROM part UNION SELECT DISTINCT p_brand FROM part),
    p AS (SELECT query, id, name, {norm('query')} AS q, {norm('name')} AS c FROM typed, catalog),
    step AS (SELECT query, id, q, c, 0 AS i, 0 AS last, 0 AS first FROM p UNION ALL SELECT query, id, q, c, i + 1, CASE WHEN place = 0 THEN -1 ELSE last + place END, CASE WHEN first = 0 THEN CASE WHEN place = 0 THEN 0 ELSE last + place END ELSE first END
      FROM (SELECT *, instr(substr(c, last + 1), substr(q, i + 1, 1)) AS place FROM step WHERE i < length(q) AND last >= 0)),
    f AS (SELECT query, id, first, last FROM step WHERE i = length(q) AND last > 0),
    s AS (SELECT p.*, CASE WHEN q = '' OR c = '' THEN NULL WHEN q = c THEN 1.0 WHEN starts_with(c, q) THEN 0.95 WHEN contains(c, q) THEN 0.9 WHEN last > 0 THEN least(0.89, 0.45::DOUBLE + length(q)::DOUBLE / (last - first + 1) * 0.25 + length(q)::DOUBLE / length(c) * 0.1 + CASE WHEN first = 1 OR substr(c, greatest(first - 1, 1), 1) = ' ' THEN 0.08 ELSE 0.0 END) END AS s
      FROM p LEFT JOIN f USING (query, id))
    SELECT query, id, name, round(s, 6)::DOUBLE AS confidence, rank FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY round(s, 9) DESC, name, id) AS rank FROM s WHERE s IS NOT NULL) WHERE rank <= 12"""
)
def fuzzy_rank_topk(spark, d):
    p = read(spark, d, "part")
    typed = p.select(F.concat(F.substring("p_name", 1, 2), F.substring("p_name", 4, 5)).alias("query")).union(p.select(F.expr("substring(p_name, 1, length(p_name) - 2)"))).union(p.select("p_brand")).distinct()
    return matching.rank_matches(catalog(spark, d), typed).select("query", "id", "name", F.round("confidence", 6).alias("confidence"), F.col("rank").cast("long").alias("rank"))


@query(
    f"""WITH {MATCH.replace('tokens AS (', 'tokens AS (SELECT token FROM tried UNION ALL ').replace(CATALOG, f"{CATALOG}, raw AS (SELECT DISTINCT upper(p_name) AS token FROM part UNION SELECT p_name || ' (' || p_type || ')' FROM part UNION SELECT c_mktsegment FROM customer), tried AS (SELECT token, token AS t0, 0 AS variant FROM raw UNION ALL SELECT token, regexp_replace(token, '\\([^)]*\\)', ' ', 'g'), 1 FROM raw WHERE contains(token, '('))", 1).replace('SELECT token FROM tried', 'SELECT t0 AS token FROM tried')},
    v AS (SELECT token, variant, {norm('t0')} AS term FROM tried), far AS (SELECT {norm('c_mktsegment')} AS term, min(c_custkey) AS id FROM customer GROUP BY 1),
    both_ AS (SELECT token, variant, id, match_type, confidence::DOUBLE AS confidence, 'local' AS origin FROM v JOIN matched USING (term) UNION ALL SELECT token, variant, id, 'canonical_exact', 1.0, 'remote' FROM v JOIN far USING (term)),
    k AS (SELECT *, CASE WHEN origin = 'local' AND confidence >= 0.98 THEN variant WHEN origin = 'remote' THEN variant + 2 ELSE 4 END AS p FROM both_)
    SELECT token, id, match_type, round(confidence, 6) AS confidence, origin FROM (SELECT *, row_number() OVER (PARTITION BY token ORDER BY p, confidence DESC, variant, id) AS n FROM k) WHERE n = 1"""
)
def match_with_remote(spark, d):
    p, c = read(spark, d, "part"), read(spark, d, "customer")
    raw = p.select(F.upper("p_name").alias("token")).union(p.select(F.concat("p_name", F.lit(" ("), "p_type", F.lit(")")))).union(c.select("c_mktsegment")).distinct()
    remote = c.select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("name"))
    return matching.match_with_remote(raw, catalog(spark, d), aliases(spark, d), remote).withColumn("confidence", F.round("confidence", 6))


# --------------------------------------------------------------------------- evidence, judgments and policies

EVIDENCE = "evidence AS (SELECT c_custkey AS id, 0 AS seq, 'registry' AS source, c_custkey % 3 = 0 AS found, 'exact' AS lookup_type, c_name AS canonical, 0.97 AS confidence FROM customer UNION ALL SELECT c_custkey, 1, 'compound', c_custkey % 2 = 0, CASE WHEN c_custkey % 4 = 0 THEN 'page' ELSE 'alias' END, upper(c_name), 0.85 FROM customer)"


def evidence(spark, d) -> DataFrame:
    c, k = read(spark, d, "customer"), F.col("c_custkey")
    one = c.select(k.alias("id"), F.lit(0).alias("seq"), F.lit("registry").alias("source"), (k % 3 == 0).alias("found"), F.lit("exact").alias("lookup_type"), F.col("c_name").alias("canonical"), F.lit(0.97).alias("confidence"))
    two = c.select(k.alias("id"), F.lit(1), F.lit("compound"), k % 2 == 0, F.when(k % 4 == 0, "page").otherwise("alias"), F.upper("c_name"), F.lit(0.85))
    return one.unionAll(two)


@query(
    f"""WITH {EVIDENCE}, f AS (SELECT id, max((lookup_type IN ('exact', 'page'))::INT) AS v, arg_min(source, seq) AS source, arg_min(canonical, seq) AS canonical, arg_min(confidence, seq) AS confidence FROM evidence WHERE found GROUP BY 1)
    SELECT c_custkey AS id, CASE WHEN v = 1 THEN 'keep' ELSE 'needs_human' END AS decision, CASE WHEN v = 1 THEN canonical END AS canonical, CASE WHEN v = 1 THEN greatest(0.90, confidence) ELSE 0 END::DOUBLE AS confidence, CASE WHEN v = 1 THEN 'verified by ' || source ELSE 'neither verified nor close to a name' END AS reason,
    CASE WHEN v = 1 THEN 'not_required' ELSE 'pending_human' END AS review FROM customer LEFT JOIN f ON id = c_custkey"""
)
def verified_decision(spark, d):
    c = read(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    none = lambda s: spark.createDataFrame([], s)
    scores = none("source_id long, target_id long, target string, similarity double, edit_distance int, token_overlap double, score_margin double, rank int")
    out = policy.decide(c, none("id long, target_id long, created_at long, canonical string"), none("id long, target_id long"), evidence(spark, d), scores)
    return out.select("id", "decision", "canonical", "confidence", "reason", policy.review_status(F.col("decision"), F.col("confidence")).alias("review"))


@query(
    f"""WITH {EVIDENCE}, t AS (SELECT c_custkey AS token_id, CASE WHEN c_custkey % 5 > 0 THEN c_custkey + 100000 END AS entry_id, c_name AS name, 'fuzzy' AS match_type, 0.80 + (c_custkey % 25) / 100.0 AS confidence FROM customer), x AS (SELECT c_name AS canonical, c_custkey AS entry_id FROM customer WHERE c_custkey % 2 = 0)
    SELECT token_id, 'fuzzy' AS hypothesis, 'existing' AS kind, name AS canonical, 'catalog:' || match_type AS source, confidence::DOUBLE AS confidence, entry_id FROM t WHERE entry_id IS NOT NULL AND confidence >= 0.85 AND confidence < 0.98
    UNION ALL SELECT id, 'evidence_' || seq, CASE WHEN entry_id IS NULL THEN 'authoritative' ELSE 'existing' END, canonical, source, confidence::DOUBLE, entry_id FROM evidence LEFT JOIN x USING (canonical) WHERE found AND canonical <> '' AND source IN ('registry', 'page')"""
)
def token_hypotheses(spark, d):
    c, k = read(spark, d, "customer"), F.col("c_custkey")
    t = c.select(k.alias("token_id"), F.when(k % 5 > 0, k + 100_000).alias("entry_id"), F.col("c_name").alias("name"), F.lit("fuzzy").alias("match_type"), F.round(0.80 + (k % 25) / 100.0, 2).alias("confidence"))
    exact = c.where(k % 2 == 0).select(F.col("c_name").alias("canonical"), k.alias("entry_id"))
    return policy.hypotheses(t, evidence(spark, d).withColumnRenamed("id", "token_id"), exact)


DECISIONS = """CASE event_id % 8 WHEN 0 THEN 'no answer' WHEN 1 THEN '```json' || chr(10) || '{"decision": "keep", "canonical": "name ' || event_id || '", "confidence": 0.9, "reason": "known", "aliases": ["a", "b"]}' || chr(10) || '```'
    WHEN 2 THEN '{"decision": "merge_into_existing", "target_id": "' || (user_id) || '", "confidence": 0.95, "reason": "same"}' WHEN 3 THEN '{"decision": "merge_into_existing", "target_id": "nobody", "confidence": 0.95}'
    WHEN 4 THEN '{"decision": "delete", "confidence": 0.5, "reason": "junk"}' WHEN 5 THEN '{"decision": "shrug", "confidence": 0.99}' WHEN 6 THEN '{"decision": "delete", "confidence": 1.5}' ELSE '{"decision": "delete", "confidence": 0.8, "reason": "a phrase"}' END"""


@query(
    f"""WITH raw AS (SELECT event_id AS id, trim(regexp_replace(regexp_replace({DECISIONS}, '^```[^\\n]*\\n', ''), '\\n```$', '')) AS j FROM events), p AS (SELECT id, CASE WHEN json_valid(j) THEN j ELSE '{{}}' END AS j FROM raw),
    d AS (SELECT id, j ->> 'decision' AS decision, j ->> 'target_id' AS target, j ->> 'canonical' AS canonical, (j ->> 'confidence')::DOUBLE AS confidence, j ->> 'reason' AS reason, json_array_length(j -> 'aliases') AS n FROM p),
    k AS (SELECT *, decision IS NULL OR decision NOT IN ('keep', 'merge_into_existing', 'alias_to_existing', 'delete', 'needs_human') OR confidence IS NULL OR confidence NOT BETWEEN 0 AND 1 AS bad, target IS NOT NULL AND target NOT IN (SELECT user_id::VARCHAR FROM events) AS unknown FROM d), h AS (SELECT *, bad OR unknown OR confidence < 0.8 AS human FROM k)
    SELECT id, CASE WHEN human THEN 'needs_human' ELSE decision END AS decision, CASE WHEN NOT human THEN target END AS target_id, CASE WHEN NOT human THEN canonical END AS canonical, CASE WHEN bad OR unknown THEN 0 ELSE confidence END::DOUBLE AS confidence,
    CASE WHEN bad THEN 'malformed' WHEN unknown THEN 'unknown target' WHEN confidence < 0.8 THEN 'unsure' ELSE reason END AS reason, CASE WHEN human THEN 0 ELSE coalesce(n, 0) END::BIGINT AS n_aliases FROM h"""
)
def parsed_decisions(spark, d):
    e = read(spark, d, "events")
    out = policy.parse_decisions(e.select(F.col("event_id").alias("id"), F.expr(DECISIONS).alias("raw")), e.select("user_id"))
    return out.select("id", "decision", "target_id", "canonical", "confidence", "reason", F.size("aliases").cast("long").alias("n_aliases"))


JUDGMENTS = """CASE event_id % 14 WHEN 0 THEN 'sorry' WHEN 1 THEN 'As I see it: {"verdict": "matched", "choice_id": "fuzzy", "confidence": 0.9, "reason": "close"} so.' WHEN 2 THEN '{"verdict": "matched", "choice_id": "evidence_0", "confidence": 0.7, "reason": "low"}'
    WHEN 3 THEN '{"verdict": "junk", "choice_id": null, "confidence": 0.95, "reason": "a phrase"}' WHEN 4 THEN '{"verdict": "junk", "choice_id": "fuzzy", "confidence": 0.95, "reason": "both"}' WHEN 5 THEN '{"verdict": "new_ingredient", "choice_id": "evidence_1", "confidence": 0.93, "reason": "found"}'
    WHEN 6 THEN '{"verdict": "maybe", "choice_id": null, "confidence": 0.9, "reason": "x"}' WHEN 7 THEN '{"verdict": "matched", "choice_id": 5, "confidence": 0.9, "reason": "x"}' WHEN 8 THEN '{"verdict": "matched", "choice_id": "fuzzy", "confidence": true, "reason": "x"}'
    WHEN 9 THEN '{"verdict": "matched", "choice_id": "fuzzy", "confidence": 1.2, "reason": "x"}' WHEN 10 THEN '{"verdict": "unknown", "choice_id": "", "confidence": 0, "reason": ""}' WHEN 11 THEN '{"verdict": "matched", "choice_id": "fuzzy", "confidence": 0.9}' WHEN 12 THEN '{"verdict": "new_ingredient", "choice_id": "fuzzy", "confidence": 1, "reason": "known"}'
    ELSE '{"verdict": "matched", "choice_id": "evidence_7", "confidence": 0.9, "reason": null}' END"""
JUDGED = f"""raw AS (SELECT event_id AS id, user_id, nullif(regexp_extract({JUDGMENTS}, '(?s)\\{{.*\\}}', 0), '') AS j FROM events), t AS (SELECT *, json_type(j, '$.verdict') AS tv, json_type(j, '$.choice_id') AS tc, json_type(j, '$.confidence') AS tn, json_type(j, '$.reason') AS tr, j ->> 'verdict' AS v, j ->> 'choice_id' AS c, j ->> 'reason' AS r FROM raw),
    w AS (SELECT *, CASE WHEN j IS NULL OR tv IS NULL OR tc IS NULL OR tn IS NULL OR tr IS NULL THEN 'no parseable result' WHEN tv <> 'VARCHAR' OR v NOT IN ('matched', 'new_ingredient', 'junk', 'unknown') THEN 'invalid verdict' WHEN tc NOT IN ('VARCHAR', 'NULL') THEN 'invalid choice_id' WHEN tr <> 'VARCHAR' THEN 'invalid reason'
      WHEN tn NOT IN ('UBIGINT', 'BIGINT', 'DOUBLE') OR (j ->> 'confidence')::DOUBLE NOT BETWEEN 0 AND 1 THEN 'invalid confidence' END AS why FROM t),
    judged AS (SELECT id, user_id, CASE WHEN why IS NULL THEN v ELSE 'unknown' END AS verdict, CASE WHEN why IS NULL THEN nullif(c, '') END AS choice, CASE WHEN why IS NULL THEN (j ->> 'confidence')::DOUBLE ELSE 0 END AS confidence, coalesce(why, r) AS reason FROM w)"""


def judged(spark, d) -> DataFrame:
    return read(spark, d, "events").select(F.col("event_id").alias("id"), "user_id", policy.parse_judgment(F.expr(JUDGMENTS)).alias("j")).select("id", "user_id", "j.*")


@query(f"WITH {JUDGED} SELECT id, verdict, choice, confidence, reason FROM judged")
def parsed_judgments(spark, d):
    return judged(spark, d).drop("user_id")


@query(
    f"""WITH {JUDGED}, k AS (SELECT *, user_id % 6 + 1 AS position, CASE WHEN choice IS NULL OR choice = 'evidence_7' THEN NULL WHEN choice = 'fuzzy' OR user_id % 2 = 0 THEN 'existing' ELSE 'authoritative' END AS kind FROM judged),
    f AS (SELECT *, coalesce(starts_with(choice, 'evidence_'), false) AS ev, verdict = 'junk' AND choice IS NULL AND confidence >= 0.90 AS junk FROM k)
    SELECT id, CASE WHEN junk AND position <= 3 THEN 'pending_human' WHEN junk THEN 'junk' WHEN kind = 'existing' AND confidence >= 0.85 AND (verdict = 'matched' OR (verdict = 'new_ingredient' AND ev)) THEN 'matched' WHEN verdict = 'new_ingredient' AND kind = 'authoritative' AND confidence >= 0.90 THEN 'new_ingredient' ELSE 'pending_human' END AS resolution,
    CASE WHEN junk AND position <= 3 THEN 'junk_at_top_positions' WHEN junk OR (kind = 'existing' AND confidence >= 0.85 AND (verdict = 'matched' OR (verdict = 'new_ingredient' AND ev))) OR (verdict = 'new_ingredient' AND kind = 'authoritative' AND confidence >= 0.90) THEN NULL
      WHEN reason = 'no parseable result' OR starts_with(reason, 'invalid ') THEN 'llm_response_invalid' WHEN verdict = 'unknown' THEN 'llm_unknown' WHEN (verdict IN ('matched', 'new_ingredient') AND kind IS NULL) OR (verdict = 'junk' AND choice IS NOT NULL) THEN 'llm_choice_id_invalid'
      WHEN verdict = 'matched' AND kind <> 'existing' THEN 'matched_non_catalog_hypothesis' WHEN verdict = 'new_ingredient' AND kind = 'existing' AND NOT ev THEN 'llm_verdict_choice_mismatch' ELSE 'llm_confidence_below_threshold' END AS trigger FROM f"""
)
def judgment_policy(spark, d):
    choice, u = F.col("choice"), F.col("user_id")
    kind = F.when(choice.isNull() | (choice == "evidence_7"), None).when((choice == "fuzzy") | (u % 2 == 0), "existing").otherwise("authoritative")
    x = policy.judge(F.col("verdict"), choice, F.col("confidence"), F.col("reason"), u % 6 + 1, kind)
    return judged(spark, d).select("id", x.alias("x")).select("id", "x.resolution", "x.trigger")


FINDINGS = """CASE event_id % 10 WHEN 0 THEN 'nothing' WHEN 1 THEN 'Found: {"found": true, "source_name": " Shop ", "source_url": "https://www.shop' || (event_id % 3) || '.com/x", "matched_product_name": " Cream ", "online_ingredients": [" Aqua ", "Salt"], "reason": "same"}' WHEN 2 THEN '{"found": false, "reason": "no page"}'
    WHEN 3 THEN '{"found": "yes", "reason": "x"}' WHEN 4 THEN '{"found": true, "reason": 3}' WHEN 5 THEN '{"found": true, "source_name": " ", "source_url": "https://a.com", "online_ingredients": ["x"], "reason": "r"}' WHEN 6 THEN '{"found": true, "source_name": "a", "source_url": "http://a.com", "online_ingredients": ["x"], "reason": "r"}'
    WHEN 7 THEN '{"found": true, "source_name": "a", "source_url": "https://a.com", "online_ingredients": ["x", " "], "reason": "r"}' WHEN 8 THEN '{"found": true, "source_name": "a", "source_url": "https://a.com", "online_ingredients": ["x", 4], "reason": "r"}' ELSE '{"found": true, "source_name": "a", "source_url": "https://b.com/y", "online_ingredients": [], "reason": "r"}' END"""


@query(
    f"""WITH raw AS (SELECT event_id AS id, nullif(regexp_extract({FINDINGS}, '(?s)\\{{.*\\}}', 0), '') AS j FROM events), l AS (SELECT *, from_json(j -> 'online_ingredients', '["JSON"]') AS items FROM raw),
    s AS (SELECT *, json_type(j, '$.found') = 'BOOLEAN' AND json_type(j, '$.reason') = 'VARCHAR' AS told, (j ->> 'found') = 'true' AS yes, trim(j ->> 'source_name') <> '' AND json_type(j, '$.source_name') = 'VARCHAR' AND regexp_matches(j ->> 'source_url', '^https://[^/@ ]+') AND json_type(j, '$.online_ingredients') = 'ARRAY'
      AND len(list_filter(items, lambda x: json_type(x) <> 'VARCHAR' OR trim(x ->> '$') = '')) = 0 AS sound FROM l), f AS (SELECT *, coalesce(told AND (NOT yes OR sound), false) AS ok FROM s)
    SELECT id, ok, CASE WHEN ok THEN yes END AS found, CASE WHEN ok AND yes THEN trim(j ->> 'source_name') END AS source_name, CASE WHEN ok AND yes THEN j ->> 'source_url' END AS source_url, CASE WHEN ok AND yes THEN nullif(trim(j ->> 'matched_product_name'), '') END AS product_name,
    CASE WHEN ok AND yes THEN array_to_string(list_transform(items, lambda x: trim(x ->> '$')), '|') END AS ingredients, CASE WHEN ok THEN j ->> 'reason' END AS reason FROM f"""
)
def product_findings(spark, d):
    x = read(spark, d, "events").select(F.col("event_id").alias("id"), policy.parse_finding(F.expr(FINDINGS)).alias("f"))
    return x.select("id", F.col("f").isNotNull().alias("ok"), "f.found", "f.source_name", "f.source_url", "f.product_name", F.array_join("f.ingredients", "|").alias("ingredients"), "f.reason")


@query(f"WITH {EVIDENCE} SELECT id AS token, count(DISTINCT CASE WHEN found AND source IN ('registry', 'compound') AND {norm('canonical')} <> '' THEN {norm('canonical')} || CASE WHEN id % 12 = 0 THEN source ELSE '' END END) > 1 AS disagrees FROM evidence GROUP BY 1")
def spelling_disagreement(spark, d):
    name = F.when(F.col("id") % 12 == 0, F.concat("canonical", "source")).otherwise(F.col("canonical"))
    return matching.spelling_disagreement(evidence(spark, d).withColumn("canonical", name).withColumnRenamed("id", "token"), ("registry", "compound"))


@query(
    f"""WITH {LINES}, t AS (SELECT l_orderkey AS id, position, CASE l_returnflag WHEN 'A' THEN 'junk' WHEN 'R' THEN 'unresolved' ELSE 'matched' END AS resolution FROM lines), v AS (SELECT o_orderkey AS id, CASE o_orderstatus WHEN 'F' THEN 'pending_human' ELSE 'failed' END AS status, CASE o_orderpriority WHEN '1-URGENT' THEN 'divergent' WHEN '2-HIGH' THEN 'not_found' ELSE 'verified' END AS verdict FROM orders)
    SELECT id, status = 'pending_human' AND count(*) FILTER (WHERE resolution = 'unresolved') = 0 AS approvable, count(*) FILTER (WHERE verdict IN ('divergent', 'not_found') OR (resolution = 'junk' AND position <= 3)) AS n_confirm FROM t JOIN v USING (id) GROUP BY id, status"""
)
def review_gates(spark, d):
    flag = F.col("l_returnflag")
    t = lines(spark, d).select(F.col("l_orderkey").alias("id"), "position", F.when(flag == "A", "junk").when(flag == "R", "unresolved").otherwise("matched").alias("resolution"))
    o, p = read(spark, d, "orders"), F.col("o_orderpriority")
    v = o.select(F.col("o_orderkey").alias("id"), F.when(F.col("o_orderstatus") == "F", "pending_human").otherwise("failed").alias("status"), F.when(p == "1-URGENT", "divergent").when(p == "2-HIGH", "not_found").otherwise("verified").alias("verdict"))
    met = t.join(v, "id").withColumn("confirm", policy.needs_confirmation(F.col("verdict"), F.col("resolution"), F.col("position")))
    open_ = F.count_if(F.col("resolution") == "unresolved")
    return met.groupBy("id", "status").agg(open_.alias("_n"), F.count_if("confirm").alias("n_confirm")).select("id", policy.approvable(F.col("_n"), F.col("status")).alias("approvable"), "n_confirm")


@query(f"WITH {EVIDENCE}, f AS (SELECT id, arg_min(canonical, seq) FILTER (WHERE found AND source IN ('registry', 'page')) AS c FROM evidence GROUP BY 1) SELECT c_custkey AS id, coalesce(c, c_address_) AS name FROM (SELECT *, c_mktsegment AS c_address_ FROM customer) LEFT JOIN f ON id = c_custkey")
def preferred_names(spark, d):
    e = evidence(spark, d).groupBy("id").agg(F.array_sort(F.collect_list(F.struct("seq", "source", "found", "canonical"))).alias("e"))
    c = read(spark, d, "customer").select(F.col("c_custkey").alias("id"), "c_mktsegment")
    return c.join(e, "id").select("id", policy.preferred_name(F.col("e"), F.col("c_mktsegment")).alias("name"))


RESOLVE = "CASE WHEN p_size % 7 = 0 THEN 'lost' WHEN p_size % 3 = 0 THEN 'matched' WHEN p_size % 3 = 1 THEN 'new_ingredient' ELSE 'junk' END"


@query(
    f"""WITH t AS (SELECT l_orderkey * 1000 + position AS token_id, l_orderkey AS id, p_name AS raw_token, p_size, p_partkey FROM (WITH {LINES} SELECT * FROM lines) JOIN part ON p_partkey = l_partkey), c AS (SELECT *, {RESOLVE} AS to_, CASE WHEN p_size % 2 = 0 THEN p_partkey ELSE -1 END AS entry, CASE WHEN p_size % 5 > 0 THEN ' ' || raw_token || ' ' ELSE '  ' END AS name FROM t WHERE p_size % 4 > 0),
    w AS (SELECT c.*, CASE WHEN to_ = 'lost' THEN 'invalid resolution' WHEN o_orderstatus <> 'F' THEN 'not awaiting review' WHEN to_ = 'matched' AND entry = -1 THEN 'no such entry' WHEN to_ = 'new_ingredient' AND trim(name) = '' THEN 'no name' END AS why FROM c JOIN orders ON o_orderkey = id)
    SELECT t.token_id, t.id, CASE WHEN w.token_id IS NOT NULL AND why IS NULL THEN to_ ELSE 'pending_human' END AS resolution, CASE WHEN why IS NULL AND to_ = 'matched' THEN entry END AS entry_id, CASE WHEN why IS NULL AND to_ = 'new_ingredient' THEN trim(name) END AS canonical_name, CASE WHEN w.token_id IS NOT NULL AND why IS NULL THEN 'human' END AS source, why AS refused FROM t LEFT JOIN w USING (token_id)"""
)
def resolved_tokens(spark, d):
    met = lines(spark, d).join(read(spark, d, "part"), F.col("p_partkey") == F.col("l_partkey"))
    base = met.select((F.col("l_orderkey") * 1000 + F.col("position")).alias("token_id"), F.col("l_orderkey").alias("id"), F.col("p_name").alias("raw_token"), "p_size", "p_partkey")
    null = lambda t: F.lit(None).cast(t)
    t = base.select("token_id", "id", "raw_token", F.lit("pending_human").alias("resolution"), null("long").alias("entry_id"), null("string").alias("canonical_name"), null("string").alias("match_type"), null("double").alias("confidence"), null("string").alias("resolution_source"))
    name = F.when(F.col("p_size") % 5 > 0, F.concat(F.lit(" "), "raw_token", F.lit(" "))).otherwise("  ")
    asked = base.where("p_size % 4 > 0").select("token_id", F.expr(RESOLVE).alias("resolution"), F.when(F.col("p_size") % 2 == 0, F.col("p_partkey")).otherwise(-1).alias("entry_id"), name.alias("canonical_name"), F.lit("ann").alias("actor"))
    subs = read(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.when(F.col("o_orderstatus") == "F", "pending_human").otherwise("applied").alias("status"))
    out, log = policy.resolve_tokens(t, subs, read(spark, d, "part").select(F.col("p_partkey").alias("id")), asked)
    return out.join(log.select("token_id", F.col("reason").alias("refused")), "token_id", "left").select("token_id", "id", "resolution", "entry_id", "canonical_name", F.col("resolution_source").alias("source"), "refused")


@query("SELECT o_orderkey AS id, CASE WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'F' THEN 'rejected' WHEN o_orderstatus = 'F' THEN 'pending_human' ELSE 'applied' END AS status FROM orders")
def rejected_submissions(spark, d):
    o = read(spark, d, "orders")
    subs = o.select(F.col("o_orderkey").alias("id"), F.when(F.col("o_orderstatus") == "F", "pending_human").otherwise("applied").alias("status"))
    return policy.reject_submissions(subs, o.where("o_orderpriority = '5-LOW'").select(F.col("o_orderkey").alias("id")))


@query(
    f"""WITH {LINES}, n AS (SELECT l_orderkey AS product_id, position, p_name AS name, CASE WHEN p_size % 2 = 0 THEN p_type ELSE '' END AS f FROM lines JOIN part ON p_partkey = l_partkey WHERE l_partkey % 3 > 0),
    k AS (SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY position) AS k FROM n) SELECT product_id, string_agg(name || ':' || f, '|' ORDER BY position) AS context FROM k WHERE k <= 3 GROUP BY 1"""
)
def description_context(spark, d):
    matched = F.when(F.col("l_partkey") % 3 > 0, F.col("l_partkey"))  # the others have no entry yet
    items = lines(spark, d).select(F.col("l_orderkey").alias("product_id"), "position", matched.alias("id"))
    entries = read(spark, d, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.when(F.col("p_size") % 2 == 0, F.array("p_type")).alias("functions"))
    out = submissions.description_context(items, entries, most=3)
    return out.select("product_id", F.array_join(F.transform("ingredients", lambda x: F.concat(x["name"], F.lit(":"), F.array_join(x["functions"], ","))), "|").alias("context"))


LABEL = "p_name || ', ' || p_type || ';' || p_brand || ', ,Extra-' || p_size"


@query(
    f"""WITH x AS (SELECT p_partkey, list_filter(list_transform(string_split_regex({LABEL}, '[,;\\n]'), lambda x: trim(x)), lambda x: x <> '') AS own, [upper(p_name), 'extra ' || p_size, 'Water'] AS net FROM part), k AS (SELECT *, list_transform(own, lambda x: regexp_replace(lower(x), '[^a-z0-9]', '', 'g')) AS ko, list_transform(net, lambda x: regexp_replace(lower(x), '[^a-z0-9]', '', 'g')) AS kn FROM x)
    SELECT p_partkey, array_to_string(list_filter(own, lambda x: NOT list_contains(kn, regexp_replace(lower(x), '[^a-z0-9]', '', 'g'))), '|') AS submitted_only, array_to_string(list_filter(net, lambda x: NOT list_contains(ko, regexp_replace(lower(x), '[^a-z0-9]', '', 'g'))), '|') AS online_only FROM k"""
)
def list_difference(spark, d):
    net = F.array(F.upper("p_name"), F.concat(F.lit("extra "), "p_size"), F.lit("Water"))
    out = read(spark, d, "part").select("p_partkey", submissions.list_difference(F.expr(LABEL), net).alias("x"))
    return out.select("p_partkey", F.array_join("x.submitted_only", "|").alias("submitted_only"), F.array_join("x.online_only", "|").alias("online_only"))


AGE_NOW = "2024-02-01 00:00:00"


@query(
    f"""WITH x AS (SELECT event_id AS id, event_type AS trigger, ts, floor(epoch(TIMESTAMP '{AGE_NOW}' - ts) / 3600)::BIGINT AS h FROM events) SELECT id, CASE WHEN h < 1 THEN '< 1 hour' WHEN h < 48 THEN h || ' hours' ELSE (h // 24) || ' days' END AS age, count(*) OVER () AS n_shown, (SELECT count(*) FROM events WHERE event_type = 'click') AS n_clicks FROM x WHERE trigger = 'click' AND ts < TIMESTAMP '{AGE_NOW}' - INTERVAL 36 HOUR"""
)
def filtered_queue(spark, d):
    e = read(spark, d, "events").select(F.col("event_id").alias("id"), F.col("event_type").alias("trigger"), F.col("ts").alias("created_at"))
    out, facets = submissions.filter_queue(e, F.lit(AGE_NOW).cast("timestamp"), "click", 36)
    totals = out.agg(F.count("*").alias("n_shown")).crossJoin(facets.where("trigger = 'click'").agg(F.max("n").alias("n_clicks")))
    return tables.beside(out.select("id", "age"), totals)


@query(
    f"""WITH {QUEUE}, p AS (SELECT id FROM q WHERE status = 'submitted'), l AS (SELECT e.event_id % 50 AS id, arg_max(event_type, event_id) FILTER (WHERE event_type <> 'view') AS trigger FROM events e GROUP BY 1), t AS (SELECT l_orderkey AS id, count(*) FILTER (WHERE l_returnflag = 'R') AS n FROM lineitem GROUP BY 1) SELECT p.id, trigger, coalesce(n, 0) AS n_waiting FROM p LEFT JOIN l USING (id) LEFT JOIN t USING (id)"""
)
def review_queue(spark, d):
    rows = queued(spark, d).withColumn("status", F.when(F.col("status") == "submitted", "pending_human").otherwise(F.col("status")))
    log = read(spark, d, "events").select((F.col("event_id") % 50).alias("id"), F.col("event_id").alias("at"), F.when(F.col("event_type") != "view", F.col("event_type")).alias("trigger"))
    t = read(spark, d, "lineitem").select(F.col("l_orderkey").alias("id"), F.when(F.col("l_returnflag") == "R", "pending_human").otherwise("matched").alias("resolution"))
    return queue.review_queue(rows, log, t).select("id", "trigger", "n_waiting")


@query(
    """WITH s AS (SELECT o_orderkey AS id, c_name AS brand, o_orderpriority AS name FROM orders JOIN customer ON c_custkey = o_custkey WHERE o_orderstatus = 'P'), t AS (SELECT l_orderkey AS id, l_linenumber, l_partkey FROM lineitem), n AS (SELECT id, arg_max(event_type, event_id) AS trigger FROM (SELECT event_id % 3000 AS id, event_id, event_type FROM events) GROUP BY 1)
    SELECT s.id, l_linenumber AS position, p_name AS matched_name, trigger, CASE WHEN brand LIKE '%1' THEN 'a.com,b.com' END AS domains FROM s JOIN t USING (id) LEFT JOIN part ON p_partkey = l_partkey LEFT JOIN n ON n.id = s.id"""
)
def review_detail(spark, d):
    o = read(spark, d, "orders").where("o_orderstatus = 'P'").join(read(spark, d, "customer"), F.col("c_custkey") == F.col("o_custkey"))
    subs = o.select(F.col("o_orderkey").alias("id"), F.col("c_name").alias("brand"), F.col("o_orderpriority").alias("name"), F.lit("pending_human").alias("status"), F.lit(None).cast("string").alias("similar_product"))
    t = read(spark, d, "lineitem").select(F.col("l_orderkey").alias("id"), F.col("l_linenumber").alias("position"), F.col("l_partkey").alias("entry_id"))
    entries = read(spark, d, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"))
    log = read(spark, d, "events").select((F.col("event_id") % 3000).alias("id"), F.col("event_id").alias("at"), F.col("event_type").alias("trigger"))
    named = read(spark, d, "customer").where("c_name like '%1'")
    domains = named.select(F.lower("c_name").alias("brand"), F.explode(F.array(F.lit("b.com"), F.lit("a.com"))).alias("domain"))
    products = spark.createDataFrame([], "product_id string, name string")
    out = submissions.review_detail(subs, t, entries, log, domains, products)
    return out.select("id", "position", "matched_name", "trigger", F.array_join("domains", ",").alias("domains"))


# --------------------------------------------------------------------------- seeding


def taxonomy(spark, d) -> DataFrame:
    """Parts as entries of a taxonomy file."""
    p = read(spark, d, "part")
    return p.select(F.concat("p_name", F.when(F.col("p_size") % 2 == 0, " Oil").otherwise("")).alias("canonical"), F.array("p_brand", "p_type").alias("synonyms"), F.create_map(F.lit("fr"), F.array(F.concat("p_name", F.lit(" fr")))).alias("other_names"), F.when(F.col("p_size") % 3 == 0, F.concat(F.lit("c"), "p_size")).alias("cas"), *[F.lit(None).cast("string").alias(c) for c in ("ec", "wikidata", "pubchem")], F.lit(1).alias("file"), F.col("p_partkey").alias("block"))


TAXONOMY = f"x AS (SELECT p_name || CASE WHEN p_size % 2 = 0 THEN ' Oil' ELSE '' END AS name, p_brand, p_type, p_name, p_size, p_partkey AS block FROM part), n AS (SELECT *, {norm('name')} AS normalized_name FROM x), one AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY normalized_name ORDER BY block) AS k FROM n WHERE normalized_name <> '') WHERE k = 1), s AS (SELECT *, substr(sha256(normalized_name), 1, 32) AS id, trim(regexp_replace(lower(name), '[^a-z0-9]+', '-', 'g'), '-') AS b FROM one)"


@query(f"WITH {TAXONOMY} SELECT id, name, normalized_name, CASE WHEN row_number() OVER (PARTITION BY b ORDER BY block) = 1 THEN b ELSE b || '-' || substr(sha1(name), 1, 6) END AS slug, CASE WHEN p_size % 3 = 0 THEN 'c' || p_size END AS cas FROM s")
def seeded_ingredients(spark, d):
    return seed.seed_taxonomy(taxonomy(spark, d))["ingredients"].select("id", "name", "normalized_name", "slug", "cas")


@query(f"WITH {TAXONOMY} SELECT id, p_brand AS alias, 'en' AS language, 'synonym' AS alias_type FROM s UNION SELECT id, p_type, 'en', 'synonym' FROM s UNION SELECT id, p_name || ' fr', 'fr', 'translation' FROM s")
def seeded_aliases(spark, d):
    return seed.seed_taxonomy(taxonomy(spark, d))["aliases"].select("id", "alias", "language", "alias_type")


PRODUCTS = """p AS (SELECT o_orderkey AS barcode, 'Product ' || (o_orderkey % 5) AS name, CASE WHEN o_custkey % 7 = 0 THEN ' ; ' ELSE c_name || ', other' END AS brand, string_agg(CASE WHEN l_partkey % 50 = 0 THEN 'Unknown stuff' ELSE p_name END, ', ' ORDER BY l_linenumber, l_partkey, l_suppkey) AS label FROM orders JOIN customer ON c_custkey = o_custkey JOIN lineitem ON l_orderkey = o_orderkey JOIN part ON p_partkey = l_partkey GROUP BY ALL)"""


def products(spark, d) -> DataFrame:
    met = read(spark, d, "lineitem").join(read(spark, d, "part"), F.col("p_partkey") == F.col("l_partkey"))
    named = F.when(F.col("l_partkey") % 50 == 0, "Unknown stuff").otherwise(F.col("p_name"))
    label = F.array_join(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey", named.alias("n"))))["n"], ", ")
    l = met.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(label.alias("label"))
    o = read(spark, d, "orders").join(read(spark, d, "customer"), F.col("c_custkey") == F.col("o_custkey")).join(l, "o_orderkey")
    brand = F.when(F.col("o_custkey") % 7 == 0, " ; ").otherwise(F.concat("c_name", F.lit(", other")))
    return o.select(F.col("o_orderkey").alias("barcode"), F.concat(F.lit("Product "), (F.col("o_orderkey") % 5).cast("string")).alias("name"), brand.alias("brand"), F.col("label").alias("ingredients_text"))


#: A slug's first product whose label resolves, not its first product.
SEEDED = f"""{PRODUCTS}, m AS (SELECT *, split_part(brand, ',', 1) AS maker FROM p WHERE brand <> ' ; '), g AS (SELECT *, trim(regexp_replace(lower(maker || ' ' || name), '[^a-z0-9]+', '-', 'g'), '-') AS slug FROM m),
    x AS (SELECT {norm('p_name')} AS term, min(p_partkey) AS id FROM part GROUP BY 1), t AS (SELECT slug, barcode, unnest(string_split(label, ', ')) AS token, generate_subscripts(string_split(label, ', '), 1) AS position FROM g),
    r AS (SELECT t.*, id FROM t LEFT JOIN x ON term = {norm('token')}), w AS (SELECT slug, barcode FROM r GROUP BY 1, 2 HAVING count(*) = count(id)),
    f AS (SELECT slug, min(barcode) AS barcode FROM w GROUP BY 1)"""


@query(f"WITH {SEEDED} SELECT slug, position::BIGINT AS position, id FROM r JOIN f USING (slug, barcode)")
def seeded_items(spark, d):
    index = read(spark, d, "part").groupBy(tx.inci_normalize("p_name").alias("term")).agg(F.min("p_partkey").alias("id"))
    out = seed.seed_products(products(spark, d), index, spark.createDataFrame([], "slug string"))
    return out["items"].select("slug", F.col("position").cast("long").alias("position"), "id")


@query(f"WITH {SEEDED} SELECT slug, name, barcode, upper(trim(maker)) AS brand FROM g JOIN f USING (slug, barcode)")
def seeded_products(spark, d):
    index = read(spark, d, "part").groupBy(tx.inci_normalize("p_name").alias("term")).agg(F.min("p_partkey").alias("id"))
    return seed.seed_products(products(spark, d), index, spark.createDataFrame([], "slug string"))["products"]


@query(f"WITH e AS (SELECT p_partkey AS id, {norm('p_name')} AS k FROM part), w AS (SELECT {norm('p_name')} AS k, min(p_size) AS priority FROM part WHERE p_size < 20 GROUP BY 1) SELECT id, priority FROM e JOIN w USING (k)")
def seeded_queue(spark, d):
    p = read(spark, d, "part")
    return seed.seed_queue(p.select(F.col("p_partkey").alias("id"), tx.inci_normalize("p_name").alias("normalized_name")), p.where("p_size < 20").select(F.upper("p_name").alias("name"), F.col("p_size").alias("priority")))


@query("WITH a AS (SELECT doc_id % 40 AS id, doc_id AS pmid, source AS title FROM documents WHERE trim(text, ' ') <> ''), t AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY pmid DESC) AS n FROM a) SELECT n_nationkey AS id, string_agg(pmid || ':' || coalesce(title, '-'), '|' ORDER BY n) AS abstracts FROM nation JOIN t ON id = n_nationkey WHERE n <= 5 GROUP BY 1")
def editorial_input(spark, d):
    docs = read(spark, d, "documents").select((F.col("doc_id") % 40).alias("id"), F.col("doc_id").alias("pmid"), F.coalesce("source", F.lit("-")).alias("title"), "text")
    out = seed.editorial_input(read(spark, d, "nation").select(F.col("n_nationkey").alias("id")), docs)
    return out.select("id", F.array_join(F.transform("abstracts", lambda a: F.concat(a["pmid"].cast("string"), F.lit(":"), a["title"])), "|").alias("abstracts"))


@query(
    """WITH t AS (SELECT CASE l_partkey % 8 WHEN 0 THEN 'Sweet Oil ' || (l_partkey % 30) WHEN 1 THEN 'apply to skin' WHEN 2 THEN 'CL 1234' || (l_partkey % 10) WHEN 3 THEN 'PEG-' || (l_partkey % 20) WHEN 4 THEN 'ab' WHEN 5 THEN 'Rose Water' WHEN 6 THEN 'Sea Salt: fine' ELSE 'Something' || l_partkey END AS token FROM lineitem),
    c AS (SELECT token, count(*) AS n FROM t GROUP BY 1), k AS (SELECT token, n, CASE WHEN regexp_matches(token, '(?i)^CL [0-9]{5}$') THEN 'colorant' WHEN regexp_matches(token, '(?i)^peg-[0-9]') THEN 'chemical' WHEN regexp_matches(token, '(?i)oil|water') THEN 'vocabulary' END AS reason FROM c WHERE length(token) >= 3 AND n >= 2 AND token NOT LIKE '%skin%' AND token NOT LIKE '%:%')
    SELECT CASE WHEN reason = 'colorant' THEN 'CI' || substr(token, 3) ELSE token END AS name, reason, n FROM k WHERE reason IS NOT NULL AND lower(token) <> 'rose water'"""
)
def promoted_tokens(spark, d):
    k = F.col("l_partkey")
    s = lambda m: (k % m).cast("string")
    t = F.when(k % 8 == 0, F.concat(F.lit("Sweet Oil "), s(30))).when(k % 8 == 1, "apply to skin").when(k % 8 == 2, F.concat(F.lit("CL 1234"), s(10))).when(k % 8 == 3, F.concat(F.lit("PEG-"), s(20))).when(k % 8 == 4, "ab").when(k % 8 == 5, "Rose Water").when(k % 8 == 6, "Sea Salt: fine").otherwise(F.concat(F.lit("Something"), k.cast("string")))
    return seed.promote_tokens(read(spark, d, "lineitem").select(t.alias("token")), spark.createDataFrame([("rose water",)], "normalized_name string"))[0].select("name", "reason", "n")


MARKED = "CASE p_size % 5 WHEN 0 THEN 'Ingredients: ' || p_name WHEN 1 THEN p_name || '* (' || p_type || ')' WHEN 2 THEN 'MAY CONTAIN: ' || p_name || ' 5%' WHEN 3 THEN p_name || ' &amp; C.I. CI 7789' || (p_size % 10) ELSE p_name END"
ENTITIES = "replace(replace(replace(replace(x, '&amp;', '&'), '&nbsp;', ' '), '&quot;', ''), '&#39;', '''')"


@query(
    f"""WITH t AS (SELECT p_partkey, {MARKED} AS x FROM part), a AS (SELECT p_partkey, trim(regexp_replace(x, '(?i)^\\s*((active|inactive|other)\\s+)?ingredients?\\s*[:\\-]\\s*|^\\s*may\\s+contain\\s*[:\\-]?\\s*', '')) AS bare_section, {ENTITIES} AS e FROM t), b AS (SELECT *, trim(regexp_replace(e, '[*†‡°^]+', '', 'g')) AS bare FROM a),
    c AS (SELECT *, trim(regexp_replace(bare, '(?i)\\s*\\(?<?\\s*[0-9]+([.,][0-9]+)?\\s*(%|ppm|mg)(\\s*w/w)?\\)?', '', 'g')) AS amount, regexp_extract(bare, '(?i)\\bC[IL]\\s*([0-9]{{5}})\\b', 1) AS i FROM b)
    SELECT p_partkey, bare_section, trim(e) || '|' || bare || '|' || amount || '|' || trim(regexp_replace(amount, '\\s*\\([^)]*\\)', '', 'g')) || '|' || CASE WHEN i <> '' THEN 'CI ' || i ELSE '' END AS spellings FROM c"""
)
def cleaner_tokens(spark, d):
    x = read(spark, d, "part").select("p_partkey", F.expr(MARKED).alias("x"))
    return x.select("p_partkey", seed.without_section_prefix("x").alias("bare_section"), F.concat_ws("|", *[F.coalesce(c, F.lit("")) for c in seed.without_annotations("x")]).alias("spellings"))


@query("SELECT 'items' AS part, count(*) AS n FROM lineitem WHERE l_partkey % 3 > 0 UNION ALL SELECT 'aliases', count(*) FROM part WHERE p_partkey % 3 > 0 UNION ALL SELECT 'entries', count(*) FROM part WHERE p_partkey % 3 > 0 OR p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_partkey % 3 > 0)")
def purged_entries(spark, d):
    t = {"items": read(spark, d, "lineitem").select(F.col("l_partkey").alias("id")), "aliases": read(spark, d, "part").select(F.col("p_partkey").alias("id"), F.col("p_type").alias("alias")), "entries": read(spark, d, "part").select(F.col("p_partkey").alias("id"))}
    out = seed.purge_entries(t, t["entries"].where("id % 3 = 0"))
    count = lambda n: out[n].agg(F.count("*").alias("n")).select(F.lit(n).alias("part"), "n")
    return count("items").unionAll(count("aliases")).unionAll(count("entries"))


@query("SELECT l_orderkey, l_linenumber, CASE WHEN p_size % 9 > 0 THEN l_partkey END AS id FROM lineitem JOIN part ON p_partkey = l_partkey")
def detached_items(spark, d):
    p = read(spark, d, "part")
    t = {"items": read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_partkey").alias("id")), "aliases": p.select(F.col("p_partkey").alias("id")), "entries": p.select(F.col("p_partkey").alias("id"))}
    return tables.detach(t, p.where("p_size % 9 = 0").select(F.col("p_partkey").alias("id")))["items"]


@query(f"WITH w AS (SELECT doc_id, unnest(list_distinct(list_filter(string_split({norm('text')}, ' '), lambda w: w <> ''))) AS term, 0.4 AS weight FROM documents UNION ALL SELECT doc_id, unnest(list_filter(string_split({norm('source')}, ' '), lambda w: w <> '')), 1.0 FROM documents) SELECT doc_id, count(*) AS n, round(sum(weight), 3)::DOUBLE AS total, min(term) AS first_term FROM (SELECT doc_id, term, max(weight) AS weight FROM w GROUP BY 1, 2) GROUP BY 1")
def weighted_terms(spark, d):
    out = seed.weighted_terms(read(spark, d, "documents"), "doc_id", {"text": 0.4, "source": 1.0})
    return out.groupBy("doc_id").agg(F.count("*").alias("n"), F.round(F.sum("weight"), 3).alias("total"), F.min("term").alias("first_term"))


# --------------------------------------------------------------------------- lists and tables


@query(
    f"""WITH {LINES}, s AS (SELECT l_orderkey, position, l_returnflag AS token, lead(l_returnflag) OVER w AS nxt, lead(l_returnflag, 2) OVER w AS nxt2 FROM lines WINDOW w AS (PARTITION BY l_orderkey ORDER BY position)), a AS (SELECT *, token = 'A' AND nxt = 'N' AND nxt2 = 'R' AS hit FROM s),
    g AS (SELECT *, coalesce(lag(hit) OVER w, false) OR coalesce(lag(hit, 2) OVER w, false) AS gone FROM a WINDOW w AS (PARTITION BY l_orderkey ORDER BY position)) SELECT l_orderkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY position) AS position, CASE WHEN hit THEN 'anr' ELSE token END AS token FROM g WHERE NOT gone"""
)
def merged_sequences(spark, d):
    rows = lines(spark, d).select("l_orderkey", "position", F.col("l_returnflag").alias("token"))
    known = spark.createDataFrame([("anr", ["A", "N", "R"])], "name string, parts array<string>")
    out = lists.merge_sequences(rows, "l_orderkey", "token", lists.find_sequences(rows, "l_orderkey", "token", known))
    return out.withColumn("position", F.col("position").cast("long"))


@query(
    """WITH RECURSIVE r AS (SELECT role, conv_id, turn, strlen(text) AS n, row_number() OVER (PARTITION BY role ORDER BY conv_id, turn, strlen(text)) AS i FROM conversations),
    f AS (SELECT role, i, n, 0 AS b, 1 AS c, n AS s FROM r WHERE i = 1 UNION ALL SELECT r.role, r.i, r.n, CASE WHEN f.c < 100 AND f.s + r.n <= 20000 THEN f.b ELSE f.b + 1 END, CASE WHEN f.c < 100 AND f.s + r.n <= 20000 THEN f.c + 1 ELSE 1 END, CASE WHEN f.c < 100 AND f.s + r.n <= 20000 THEN f.s + r.n ELSE r.n END FROM f JOIN r ON r.role IS NOT DISTINCT FROM f.role AND r.i = f.i + 1)
    SELECT role, conv_id, turn, n, b::BIGINT AS batch FROM f JOIN r USING (role, i, n)"""
)
def batch_fill(spark, d):
    rows = read(spark, d, "conversations").withColumn("n", F.octet_length("text"))
    return lists.fill_groups(rows, ["conv_id", "turn"], "n", 100, 20_000, "role")


@query(f"WITH {CATALOG}, x AS (SELECT {norm('name')} AS term, min(id) AS id FROM catalog GROUP BY 1) SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN p_partkey ELSE x.id END AS id FROM part LEFT JOIN x ON term = {norm('CASE WHEN p_size % 3 = 0 THEN p_type ELSE p_name END')}")
def rematched(spark, d):
    x = catalog(spark, d).groupBy(tx.inci_normalize("name").alias("term")).agg(F.min("id").alias("id"))
    items = read(spark, d, "part").select("p_partkey", F.when(F.col("p_size") % 3 == 0, F.col("p_type")).otherwise(F.upper("p_name")).alias("token"), F.when(F.col("p_size") % 2 == 0, F.col("p_partkey")).alias("id"))
    return matching.rematch(items, x).select("p_partkey", "id")


@query("SELECT o_orderkey AS id, string_agg('{\"l_linenumber\":' || l_linenumber || ',\"l_partkey\":' || l_partkey || '}', ',' ORDER BY l_linenumber, l_partkey, l_suppkey) AS items FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1")
def json_lists(spark, d):
    out = tables.json_lists(read(spark, d, "lineitem"), "l_orderkey", ["l_linenumber", "l_partkey", "l_suppkey"], ["l_linenumber", "l_partkey"])
    return out.select(F.col("l_orderkey").alias("id"), F.expr("substring(items, 2, length(items) - 2)").alias("items"))


@query("SELECT coalesce(s_suppkey, c_custkey) AS id, CASE WHEN c_custkey IS NOT NULL AND c_custkey % 2 = 0 THEN c_mktsegment ELSE coalesce(s_name, '') END AS tags FROM supplier FULL JOIN customer ON s_suppkey = c_custkey")
def upsert_arrays(spark, d):
    s = read(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.array("s_name").alias("tags"))
    c = read(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.when(F.col("c_custkey") % 2 == 0, F.array("c_mktsegment")).otherwise(F.array().cast("array<string>")).alias("tags"))
    return tables.upsert(s, c, ["id"], arrays=("tags",)).select("id", F.array_join("tags", ",").alias("tags"))


@query("SELECT 'purge' AS label, '{\"c_custkey\":' || c_custkey || '}' AS key, '{\"c_custkey\":' || c_custkey || ',\"c_name\":\"' || c_name || '\"}' AS \"row\" FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')")
def backups(spark, d):
    gone = read(spark, d, "orders").where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey"))
    return tables.backup(read(spark, d, "customer").select("c_custkey", "c_name"), gone, ["c_custkey"], label="purge")


@query("SELECT 'noise' AS label, l_returnflag AS reason, 'delete' AS action, p_name AS token, count(*) AS n FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 2, 4")
def findings_log(spark, d):
    met = read(spark, d, "lineitem").join(read(spark, d, "part"), F.col("p_partkey") == F.col("l_partkey"))
    return tables.findings(met, "noise", F.col("l_returnflag"), "delete", "p_name")


@query("SELECT l_orderkey, min(l_linenumber) = 1 AND max(l_linenumber) = count(*) AND count(DISTINCT l_linenumber) = count(*) AS ok FROM lineitem GROUP BY 1")
def positions_checked(spark, d):
    return tables.with_positions_checked(read(spark, d, "lineitem"), "l_orderkey", "l_linenumber")


@query("SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'F' OR o_custkey = 7")
def visible_rows(spark, d):
    o = read(spark, d, "orders")
    curators = o.where("false").select(F.lit("nobody").alias("user"))
    return tables.visible(o, F.col("o_orderstatus") == "F", F.col("o_custkey").cast("string"), "7", curators).select("o_orderkey", "o_orderstatus")


@query("SELECT l_orderkey, l_partkey, l_linenumber FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_partkey ORDER BY l_linenumber, l_suppkey) AS k FROM lineitem) WHERE k = 1")
def first_of_each_part(spark, d):
    rows = read(spark, d, "lineitem").withColumn("key", F.struct("l_orderkey", "l_partkey"))
    return tables.running_first(rows, "key", ["l_linenumber", "l_suppkey"]).select("l_orderkey", "l_partkey", "l_linenumber")


@query("WITH f AS (SELECT l_suppkey AS cas, min(CASE WHEN l_linenumber > 2 THEN 'ec' || l_partkey END) AS ec, min('iu' || l_orderkey) AS iupac FROM lineitem GROUP BY 1) SELECT s_suppkey AS id, coalesce(CASE WHEN s_suppkey % 2 = 0 THEN 'own' END, ec) AS ec, coalesce(iupac, s_name) AS iupac FROM supplier LEFT JOIN f ON cas = s_suppkey")
def filled_identifiers(spark, d):
    e = read(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_suppkey").alias("cas"), F.when(F.col("s_suppkey") % 2 == 0, "own").alias("ec"), F.col("s_name").alias("iupac"))
    found = read(spark, d, "lineitem").select(F.col("l_suppkey").alias("cas"), F.when(F.col("l_linenumber") > 2, F.concat(F.lit("ec"), "l_partkey")).alias("ec"), F.concat(F.lit("iu"), "l_orderkey").alias("iupac"))
    return lookups.fill_identifiers(e, found).select("id", "ec", "iupac")


@query(
    f"""WITH n AS (SELECT DISTINCT c_mktsegment AS name FROM customer UNION SELECT DISTINCT upper(p_name) FROM part UNION SELECT DISTINCT lower(p_brand) FROM part), t AS (SELECT {norm('p_name')} AS term, p_name AS canonical, 0 AS p FROM part UNION SELECT {norm('p_brand')}, p_name, 1 FROM part), b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY term ORDER BY p, canonical) AS k FROM t) WHERE k = 1)
    SELECT name, 'taxonomy' AS source, term IS NOT NULL AS found, CASE p WHEN 0 THEN 'exact' WHEN 1 THEN 'alias' END AS lookup_type, canonical, CASE p WHEN 0 THEN 0.95 WHEN 1 THEN 0.92 END::DOUBLE AS confidence FROM n LEFT JOIN b ON term = {norm('name')}"""
)
def source_evidence(spark, d):
    p = read(spark, d, "part")
    names = read(spark, d, "customer").select(F.col("c_mktsegment").alias("name")).union(p.select(F.upper("p_name"))).union(p.select(F.lower("p_brand"))).distinct()
    table = p.select(F.col("p_name").alias("term"), F.col("p_name").alias("canonical"), F.lit("exact").alias("kind")).union(p.select("p_brand", "p_name", F.lit("alias")))
    return lookups.table_evidence(names, table, "taxonomy", {"exact": 0.95, "alias": 0.92})


@query(
    """WITH RECURSIVE e AS (SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment FROM customer),
    k AS (SELECT id, name, CASE id % 4 WHEN 0 THEN 'merge_into_existing' WHEN 1 THEN 'alias_to_existing' WHEN 2 THEN 'keep' ELSE 'needs_human' END AS decision, CASE WHEN id % 20 = 5 THEN id - 1 WHEN id % 4 = 0 THEN id + 1 WHEN id % 4 = 1 THEN id + 2 END AS target, CASE WHEN id % 4 = 2 THEN name || ' new' END AS canonical FROM e),
    m AS (SELECT * FROM k WHERE id % 4 < 2 AND target IN (SELECT id FROM e)),
    c(id, stop, steps) AS (SELECT id, target, 1 FROM m UNION ALL SELECT c.id, m.target, steps + 1 FROM c JOIN m ON m.id = c.stop WHERE steps < 10),
    t AS (SELECT id, stop AS goal FROM c WHERE stop NOT IN (SELECT id FROM m)),
    i AS (SELECT coalesce(goal, o_custkey) AS id, count(*) AS n_items FROM orders LEFT JOIN t ON t.id = o_custkey GROUP BY 1),
    a AS (SELECT coalesce(goal, e.id) AS id, segment AS alias FROM e LEFT JOIN t USING (id) UNION SELECT goal, name FROM e JOIN t USING (id) UNION SELECT goal, name || ' aka' FROM e JOIN t USING (id) WHERE id % 3 = 0),
    l AS (SELECT id, string_agg(alias, '|' ORDER BY alias) AS aliases FROM a GROUP BY 1)
    SELECT k.id, CASE WHEN t.id IS NULL THEN coalesce(canonical, k.name) END AS name, CASE WHEN t.id IS NOT NULL THEN 'applied' WHEN decision = 'keep' THEN 'kept' ELSE 'pending_human' END AS status, coalesce(n_items, 0) AS n_items, coalesce(aliases, '') AS aliases FROM k LEFT JOIN t USING (id) LEFT JOIN i USING (id) LEFT JOIN l USING (id)"""
)
def applied_decisions(spark, d):
    """Chains of two moves, circles of two, aliases of decisions that do and don't take effect; a row for each decision."""
    c, k = read(spark, d, "customer"), F.col("c_custkey")
    t = {"entries": c.select(k.alias("id"), F.col("c_name").alias("name")), "aliases": c.select(k.alias("id"), F.col("c_mktsegment").alias("alias"), F.lit("synonym").alias("alias_type")), "items": read(spark, d, "orders").select(F.col("o_custkey").alias("id"), "o_orderkey")}
    kind = F.when(k % 4 == 0, "merge_into_existing").when(k % 4 == 1, "alias_to_existing").when(k % 4 == 2, "keep").otherwise("needs_human")
    target = F.when(k % 20 == 5, k - 1).when(k % 4 == 0, k + 1).when(k % 4 == 1, k + 2)
    given = F.when(k % 3 == 0, F.array(F.concat("c_name", F.lit(" aka")))).otherwise(F.array().cast("array<string>"))
    decisions = c.select(k.alias("id"), kind.alias("decision"), target.alias("target_id"), F.when(k % 4 == 2, F.concat("c_name", F.lit(" new"))).alias("canonical"), given.alias("aliases"))
    out = tables.apply_decisions(t, decisions)
    n = out["items"].groupBy("id").agg(F.count("*").alias("n_items"))
    names = out["aliases"].groupBy("id").agg(F.array_join(F.array_sort(F.collect_list("alias")), "|").alias("aliases"))
    rows = out["audit"].select("id", "status").join(out["entries"], "id", "left").join(n, "id", "left").join(names, "id", "left")
    return rows.select("id", "name", "status", F.coalesce("n_items", F.lit(0)).alias("n_items"), F.coalesce("aliases", F.lit("")).alias("aliases"))


@query(
    """WITH s AS (SELECT o_orderkey AS id, c_name AS brand, 'cream ' || (o_orderkey % 40) AS name FROM orders JOIN customer ON c_custkey = o_custkey WHERE o_orderstatus = 'F'), t AS (SELECT l_orderkey AS id, CASE l_returnflag WHEN 'A' THEN 'junk' WHEN 'N' THEN 'matched' ELSE CASE WHEN l_partkey % 11 = 0 THEN 'pending_human' ELSE 'new_ingredient' END END AS r FROM lineitem),
    c AS (SELECT id, bool_and(r <> 'pending_human') AS ok, count(*) FILTER (WHERE r <> 'junk') AS kept FROM t GROUP BY 1), j AS (SELECT s.*, CASE WHEN NOT coalesce(ok, false) OR coalesce(kept, 0) = 0 THEN 'failed' ELSE 'applied' END AS st FROM s LEFT JOIN c USING (id)), w AS (SELECT *, min(CASE WHEN st = 'applied' THEN id END) OVER (PARTITION BY brand, name) AS first_id FROM j)
    SELECT id, CASE WHEN st = 'applied' AND first_id <> id THEN 'duplicate' ELSE st END AS status FROM w"""
)
def applied_submissions(spark, d):
    o = read(spark, d, "orders").where("o_orderstatus = 'F'").join(read(spark, d, "customer"), F.col("c_custkey") == F.col("o_custkey"))
    subs = o.select(F.col("o_orderkey").alias("id"), F.col("c_name").alias("brand"), F.concat(F.lit("cream "), F.col("o_orderkey") % 40).alias("name"), F.lit("decision_ready").alias("status"))
    flag = F.col("l_returnflag")
    r = F.when(flag == "A", "junk").when(flag == "N", "matched").when(F.col("l_partkey") % 11 == 0, "pending_human").otherwise("new_ingredient")
    met = lines(spark, d).join(read(spark, d, "part"), F.col("p_partkey") == F.col("l_partkey"))
    t = met.select(F.col("l_orderkey").alias("id"), "position", F.col("p_name").alias("raw_token"), r.alias("resolution"), F.lit(None).cast("string").alias("canonical_name"), F.when(flag == "N", F.col("l_partkey").cast("string")).alias("entry_id"))
    none = lambda s: spark.createDataFrame([], s)
    have = {"brands": none("normalized string, name string"), "entries": none("id string, name string, normalized_name string"), "aliases": none("id string, alias string"), "products": none("product_id string, brand string, name string, slug string"), "items": none("product_id string, position int, id string")}
    return submissions.apply_submissions(have, subs, t)["states"]


# --------------------------------------------------------------------------- queue


@query(f"WITH {QUEUE} SELECT id, CASE WHEN status = 'submitted' AND id % 3 = 0 THEN 'decision_ready' ELSE status END AS status, CASE WHEN status = 'submitted' AND id % 3 = 0 THEN NULL ELSE 'b' || (id % 4) END AS batch_id FROM q")
def fenced_results(spark, d):
    q = queued(spark, d).withColumn("batch_id", F.concat(F.lit("b"), (F.col("id") % 4).cast("string")))
    right = F.when(F.col("id") % 3 == 0, F.col("batch_id")).otherwise("another")
    return queue.finalize(q, q.select("id", right.alias("batch_id"), F.lit("decision_ready").alias("status"))).select("id", "status", "batch_id")


@query(
    f"""WITH {QUEUE}, x AS (SELECT *, CASE WHEN id % 6 > 0 THEN 'b' || (id % 6) END AS batch FROM q), o AS (SELECT *, CASE WHEN status NOT IN ('verifying', 'submitted') OR batch IS NULL THEN 'idle' WHEN batch = 'b1' THEN 'ready' WHEN batch IN ('b2', 'b3') AND locked_at >= TIMESTAMP '2024-01-20' - INTERVAL 10 DAY THEN 'waiting' ELSE 'failed' END AS outcome FROM x)
    SELECT id, outcome, outcome = 'failed' AND attempt_count >= 2 AS sync, CASE WHEN outcome <> 'failed' THEN batch END AS batch_id FROM o"""
)
def polled_batches(spark, d):
    q = queued(spark, d).withColumn("batch_id", F.when(F.col("id") % 6 > 0, F.concat(F.lit("b"), (F.col("id") % 6).cast("string"))))
    batches = spark.createDataFrame([("b1", "ended"), ("b2", "in_progress"), ("b3", "in_progress"), ("b4", "canceled")], "batch_id string, state string")
    return queue.poll(q, batches, F.lit("2024-01-20 00:00:00").cast("timestamp"), 10 * 24 * 60).select("id", "outcome", "sync", "batch_id")


@query(
    """WITH s AS (SELECT user_id AS id, event_id AS seq, CASE event_type WHEN 'view' THEN 'received' WHEN 'click' THEN 'processing' WHEN 'purchase' THEN 'verifying' ELSE 'submitted' END AS status FROM events), l AS (SELECT *, lag(status) OVER (PARTITION BY id ORDER BY seq) AS before FROM s),
    k(a, b) AS (VALUES ('received', 'processing'), ('processing', 'verifying'), ('processing', 'received'), ('verifying', 'submitted'), ('verifying', 'verifying'), ('submitted', 'verifying')) SELECT id, seq, before, status FROM l WHERE before IS NOT NULL AND NOT EXISTS (SELECT 1 FROM k WHERE a = before AND b = status)"""
)
def illegal_steps(spark, d):
    t = F.col("event_type")
    log = read(spark, d, "events").select(F.col("user_id").alias("id"), F.col("event_id").alias("seq"), F.when(t == "view", "received").when(t == "click", "processing").when(t == "purchase", "verifying").otherwise("submitted").alias("status"))
    return queue.illegal_steps(log).select("id", "seq", "before", "status")


@query(f"WITH {QUEUE}, s AS (SELECT CASE WHEN status = 'verifying' AND attempt_count >= 3 THEN 'failed' WHEN status = 'verifying' THEN 'received' ELSE status END AS status, updated_at FROM q) SELECT status, count(*) AS n FROM s WHERE NOT (status IN ('applied', 'failed') AND updated_at < TIMESTAMP '2024-01-20' - INTERVAL 7 DAY) GROUP BY 1")
def tick_in_order(spark, d):
    now = F.lit("2024-01-20 00:00:00").cast("timestamp")
    stages = {
        "purge": lambda t: {"q": queue.purge(t["q"], now, days=7)},  # in the order of TICK, whatever theirs here
        "poll": lambda t: {"q": queue.fail(t["q"], t["q"].where("status = 'verifying'").select("id", F.lit("no answer").alias("error")), "received")},
    }
    done = queue.run_stages({"q": queued(spark, d)}, stages)["q"]
    # what failed in this tick is purged by it, too, if it is old enough
    return done.groupBy("status").agg(F.count("*").alias("n"))


@query("WITH r AS (SELECT CASE event_id % 5 WHEN 0 THEN repeat('x', 70) WHEN 1 THEN ' ' WHEN 2 THEN 'same' || (event_id % 20) ELSE 'r' || event_id END AS id FROM events), n AS (SELECT id, count(*) AS n FROM r GROUP BY 1) SELECT id AS custom_id, CASE WHEN trim(id) = '' THEN 'blank' WHEN length(id) > 64 THEN 'too long' WHEN n > 1 THEN 'repeated' END AS reason, n FROM n")
def batch_requests(spark, d):
    k = F.col("event_id")
    r = read(spark, d, "events").select(F.when(k % 5 == 0, "x" * 70).when(k % 5 == 1, " ").when(k % 5 == 2, F.concat(F.lit("same"), (k % 20).cast("string"))).otherwise(F.concat(F.lit("r"), k.cast("string"))).alias("custom_id"))
    good, faults = submissions.batch_requests(r)
    both = good.select("custom_id", F.lit(None).cast("string").alias("reason")).unionByName(faults)
    return both.join(r.groupBy("custom_id").agg(F.count("*").alias("n")), "custom_id").select("custom_id", "reason", "n")


@query("SELECT event_id, CASE WHEN event_type = 'error' THEN NULL WHEN user_id % 3 = 0 THEN 'last' WHEN user_id % 3 = 1 THEN 'first' END AS answer FROM events")
def last_answers(spark, d):
    def block(kind: str, text):
        return F.struct(F.lit(kind).alias("type"), text.cast("string").alias("text"))

    m, none = F.col("user_id") % 3, F.lit(None)
    content = F.when(m == 0, F.array(block("text", F.lit("first")), block("tool", F.lit("query")), block("text", F.lit("last")), block("text", F.lit("")))).when(m == 1, F.array(block("text", F.lit("first")), block("tool", none))).otherwise(F.array(block("tool", F.lit("x"))))
    kind = F.when(F.col("event_type") == "error", "errored").otherwise("succeeded")
    return read(spark, d, "events").select("event_id", submissions.answer_text(content, kind).alias("answer"))


@query("SELECT c_mktsegment AS brand, 'n' || (c_custkey % 10) AS name, 'received' AS status, 0::BIGINT AS attempt_count, count(*)::BIGINT AS n, count(*)::BIGINT AS ids FROM customer GROUP BY 1, 2")
def inserted_submissions(spark, d):
    empty = spark.createDataFrame([], "id string, brand string, name string, ingredients string, submitted_by string, status string, attempt_count int, created_at timestamp")
    new = read(spark, d, "customer").select(F.col("c_mktsegment").alias("brand"), F.concat(F.lit("n"), F.col("c_custkey") % 10).alias("name"), F.lit("water").alias("ingredients"), F.lit(None).cast("string").alias("submitted_by"))
    out = submissions.new_submissions(empty, new, F.lit(AGE_NOW).cast("timestamp"))
    return out.groupBy("brand", "name", "status", F.col("attempt_count").cast("long").alias("attempt_count")).agg(F.count("*").alias("n"), F.countDistinct("id").alias("ids"))
