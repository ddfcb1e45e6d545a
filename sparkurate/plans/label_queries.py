"""Label tokenizing over the driver's tables, with its SQL: windows for what precedes, a recursion for greedy merges."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import labels as lb
from ..functions.text import inci_normalize
from .queries import LINES, lines, query, read

S, NOT_W = r"[\t-\r\x1c-\x20\x{85}\p{Z}]", r"[^\p{L}\p{N}_]"  # white space; what no word is made of


def _quoted(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in sorted(values))


def _re(pattern: str) -> str:
    return pattern.replace(lb.S, S).replace("'", "''")


def _name(x: str) -> str:
    return f"trim(regexp_replace(regexp_replace(lower(strip_accents({x})), '[^a-z0-9 ]+', '', 'g'), ' +', ' ', 'g'))"


def _strip(x: str) -> str:
    return f"regexp_replace({x}, '^{S}+|{S}+$', '', 'g')"


def _unmarked(x: str) -> str:
    between = f"(?:{S}*[:\\-]{S}*|{S}+)"
    return f"regexp_replace({x}, '(?i)^(?:{S}*{lb.MARKER}{between})*(?:{S}*{lb.MARKER}(?:{S}*[:\\-]{S}*|{S}+|$|({NOT_W})))?', '\\1')"


def _without(x: str, words: str) -> str:
    return f"regexp_replace({x}, '(?is)(^|{NOT_W})(?:{_re(words)})(?:$|{NOT_W}.*)', '\\1')"


def _clean(x: str, v2: bool) -> str:
    strip = "E' \\t\\r\\n:.-*'" if v2 else "E' \\t\\r\\n:.-'"
    x = f"trim({_unmarked(_strip(x))}, {strip})"
    if v2:
        x = f"replace(regexp_replace({x}, '{_re(lb.CONCENTRATION)}', ''), '\\', '/')"
    return f"regexp_replace({x}, '{S}+', ' ', 'g')"


def _noise(n: str) -> str:
    return f"({n} IN ({_quoted(lb.NOISE)}) OR {n} = '' OR regexp_matches({n}, '^[a-z]$'))"


def _greedy(name: str, source: str, widest: int) -> str:
    """CTEs: rows (id, i, p, n) of source with known names of several rows in a row put together, from left to right."""
    return f"""{name}_l AS (SELECT id, list(p ORDER BY i) AS ps, list(n ORDER BY i) AS ns FROM {source} GROUP BY id),
    {name}_w AS (SELECT id, i, max(w) AS w FROM (SELECT id, i, w, array_to_string(list_filter(ns[i:i + w - 1], lambda x: x <> ''), ' ') AS n FROM (SELECT id, ns, unnest(range(1, len(ns) + 1)) AS i FROM {name}_l), (SELECT unnest(range(2, {widest + 1})) AS w) WHERE i + w - 1 <= len(ns)) JOIN terms ON terms.term = n GROUP BY 1, 2),
    {name}_n AS (SELECT a.id, a.i, a.w, min(b.i) AS next FROM {name}_w a LEFT JOIN {name}_w b ON a.id = b.id AND b.i >= a.i + a.w GROUP BY 1, 2, 3),
    {name}_s AS (SELECT n.id, n.i, n.w, n.next FROM {name}_n n JOIN (SELECT id, min(i) AS i FROM {name}_n GROUP BY 1) USING (id, i) UNION ALL SELECT n.id, n.i, n.w, n.next FROM {name}_s s JOIN {name}_n n ON n.id = s.id AND n.i = s.next),
    {name} AS (SELECT l.id, l.i, coalesce(array_to_string(ps[l.i:l.i + s.w - 1], ' '), ps[l.i]) AS p, coalesce(array_to_string(list_filter(ns[l.i:l.i + s.w - 1], lambda x: x <> ''), ' '), ns[l.i]) AS n FROM (SELECT id, ps, ns, unnest(range(1, len(ps) + 1)) AS i FROM {name}_l) l LEFT JOIN {name}_s s ON s.id = l.id AND s.i = l.i
        WHERE NOT EXISTS (SELECT 1 FROM {name}_s o WHERE o.id = l.id AND l.i > o.i AND l.i < o.i + o.w))"""


def tokens_sql(labels: str, mode: str, terms: str = "") -> str:
    """SQL of (id, tokens joined by |) for labels, a query of (id, label); terms: a query of further known names."""
    v2 = mode == "v2"
    header = f"regexp_replace(coalesce(label, ''), '(?i){_re(lb.HEADER)}', ',', 'g')" if v2 else "coalesce(label, '')"
    separated = f"regexp_matches(t, '[,{lb.SEPARATORS[:3]}\\n]')"
    if v2:
        cut = f"""ch AS (SELECT id, unnest(string_split(t, '')) AS c, generate_subscripts(string_split(t, ''), 1) AS k FROM txt),
    dp AS (SELECT *, sum(CASE c WHEN '(' THEN 1 WHEN ')' THEN -1 ELSE 0 END) OVER (PARTITION BY id ORDER BY k) AS s, lag(c) OVER (PARTITION BY id ORDER BY k) AS b, lead(c) OVER (PARTITION BY id ORDER BY k) AS a FROM ch),
    cm AS (SELECT *, c = ',' AND s - least(0, min(s) OVER (PARTITION BY id ORDER BY k)) = 0 AND NOT (coalesce(regexp_matches(b, '{lb.DIGIT}'), false) AND coalesce(regexp_matches(a, '{lb.DIGIT}'), false)) AS cut FROM dp),
    pn AS (SELECT *, sum(cut::INT) OVER (PARTITION BY id ORDER BY k) AS part FROM cm),
    raw AS (SELECT id, part AS a, 0 AS b, string_agg(c, '' ORDER BY k) AS p FROM pn WHERE NOT cut GROUP BY 1, 2),
    cl AS (SELECT id, a, b, {_clean("p", True)} AS p FROM raw)"""
    else:
        cut = f"""raw AS (SELECT id, unnest(string_split(t, ',')) AS p, generate_subscripts(string_split(t, ','), 1) AS a FROM txt),
    c1 AS (SELECT id, a, string_split_regex({_clean("p", False)}, '[()]') AS l FROM raw), c2 AS (SELECT id, a, unnest(l) AS p, generate_subscripts(l, 1) AS b FROM c1),
    cl AS (SELECT id, a, b, {_clean("p", False)} AS p FROM c2)"""
    in_terms = lambda x: f"({x} IN (SELECT term FROM terms))"
    return f"""WITH RECURSIVE terms(term) AS (SELECT unnest([{_quoted(lb.COMMON_NAMES)}]) {"UNION " + terms if terms else ""}),
    lab AS ({labels}), hd AS (SELECT id, {header} AS t FROM lab),
    mk AS (SELECT id, t, regexp_extract(t, '(?is)(?:^|{NOT_W})({lb.MARKER}(?:$|{NOT_W}).*)', 1) AS m, regexp_matches(t, '(?i)^{S}*(?:{_re(lb.OTHER_SECTION)})(?:$|{NOT_W})') AS o FROM hd),
    sec AS (SELECT id, CASE WHEN m <> '' AND (m = t OR o) THEN m WHEN o THEN '' ELSE t END AS t FROM mk),
    se2 AS (SELECT id, {_without("t", lb.TAIL)} AS t FROM sec), se3 AS (SELECT id, {_without(_unmarked("t"), lb.MAY_CONTAIN)} AS t FROM se2),
    st AS (SELECT id, {separated} AS sep, regexp_matches(t, '[·•]') AS bul FROM se3), txt AS (SELECT id, translate(t, '·•;' || chr(10), ',,,,') AS t FROM se3),
    {cut},
    nm AS (SELECT id, a, b, p, {_name("p")} AS n FROM cl WHERE p <> ''),
    pt AS (SELECT id, row_number() OVER (PARTITION BY id ORDER BY a, b) AS i, p, n FROM nm WHERE NOT {_noise("n")}),
    ld AS (SELECT *, lead(p) OVER w AS q, lead(n) OVER w AS m FROM pt {"SEMI JOIN (SELECT id FROM st WHERE NOT bul) USING (id)" if v2 else ""} WINDOW w AS (PARTITION BY id ORDER BY i)),
    jn AS (SELECT *, coalesce(m IN ({_quoted(lb.SUFFIXES)}) AND (contains(m, ' ') OR NOT {in_terms("n")} OR {in_terms("n || ' ' || m")} OR string_split(n, ' ')[-1] IN ({_quoted(lb.CUT_WORDS)})), false) AS j FROM ld),
    rn AS (SELECT *, i - row_number() OVER (PARTITION BY id, j ORDER BY i) AS g FROM jn),
    sf AS (SELECT *, j AND row_number() OVER (PARTITION BY id, j, g ORDER BY i) % 2 = 1 AS merge FROM rn),
    sg AS (SELECT *, coalesce(lag(merge) OVER (PARTITION BY id ORDER BY i), false) AS gone FROM sf),
    rp AS (SELECT id, row_number() OVER (PARTITION BY id ORDER BY i) AS i, CASE WHEN merge THEN p || ' ' || q ELSE p END AS p, CASE WHEN merge THEN n || ' ' || m ELSE n END AS n FROM sg WHERE NOT gone),
    {_greedy("kn", "rp", 6)},
    al AS (SELECT id, i, p, n FROM kn {"UNION ALL SELECT id, i, p, n FROM pt SEMI JOIN (SELECT id FROM st WHERE bul) USING (id)" if v2 else ""}),
    sh AS (SELECT *, regexp_extract_all(p, '{lb.WORD}') AS ws, regexp_replace(p, '[^\\p{{L}}]', '', 'g') AS lt FROM al),
    ru AS (SELECT *, len(ws) >= 3 AND lt <> '' AND upper(lt) = lt AND NOT regexp_matches(p, '[,{lb.SEPARATORS[:3]}\\n]') {"AND id IN (SELECT id FROM st WHERE NOT sep)" if v2 else ""} AS run FROM sh),
    wd AS (SELECT {{'id': id, 'i': i}} AS id, unnest(range(1, len(ws) + 1)) AS i, unnest(ws) AS p FROM ru WHERE run), wn AS (SELECT *, {_name("p")} AS n FROM wd),
    {_greedy("wk", "wn", 8)},
    fin AS (SELECT id, i, 0 AS k, p, n FROM ru WHERE NOT run UNION ALL SELECT id.id, id.i, i, p, n FROM wk),
    tk AS (SELECT id, string_agg({_strip("p")}, '|' ORDER BY i, k) AS tokens FROM fin WHERE NOT {_noise("n")} GROUP BY 1)
    SELECT id, coalesce(tokens, '') AS tokens FROM lab LEFT JOIN tk USING (id)"""


def _of_documents(mode: str) -> str:
    return f"SELECT id AS doc_id, tokens FROM ({tokens_sql('SELECT doc_id AS id, text AS label FROM documents', mode)})"


@query(_of_documents("v1"))
def tokenize_v1(spark, d):
    return read(spark, d, "documents").select("doc_id", F.array_join(lb.tokenize_label("text", "v1"), "|").alias("tokens"))


@query(_of_documents("v2"))
def tokenize_v2(spark, d):
    return read(spark, d, "documents").select("doc_id", F.array_join(lb.tokenize_label("text", "v2"), "|").alias("tokens"))


#: Lists of parts as labels write them: after a heading, in capitals without separators, cut within names, with bullets.
LABELS = f"""{LINES}, nm AS (SELECT l_orderkey AS id, string_agg(p_name, ', ' ORDER BY position) AS c, string_agg(p_name, ' ' ORDER BY position) AS s, string_agg(p_name || CASE WHEN position % 3 = 0 THEN ' (' || p_brand || ', 2)' ELSE ' 5%' END, ' • ' ORDER BY position) AS b FROM lines JOIN part ON p_partkey = l_partkey GROUP BY 1)
    SELECT id, CASE id % 5 WHEN 0 THEN 'Directions: rub. INGREDIENTS: ' || c || '. Warning: dry' WHEN 1 THEN upper(s) WHEN 2 THEN replace(c, ' ', ', ') WHEN 3 THEN 'Inactive Ingredients (x, y) - ' || replace(c, ',', ';') || ', Shea, Seed, Butter, 1,2-Hexanediol, May contain mica' ELSE b END AS label FROM nm"""


def labels(spark, d):
    met = lines(spark, d).join(read(spark, d, "part"), F.col("p_partkey") == F.col("l_partkey"))
    extra = F.when(F.col("position") % 3 == 0, F.concat(F.lit(" ("), "p_brand", F.lit(", 2)"))).otherwise(" 5%")
    l = met.groupBy(F.col("l_orderkey").alias("id")).agg(F.array_sort(F.collect_list(F.struct("position", "p_name", F.concat("p_name", extra).alias("b")))).alias("l"))
    l = l.select("id", F.array_join("l.p_name", ", ").alias("c"), F.array_join("l.p_name", " ").alias("s"), F.array_join("l.b", " • ").alias("b"))
    kind = F.col("id") % 5
    headed = F.concat(F.lit("Directions: rub. INGREDIENTS: "), "c", F.lit(". Warning: dry"))
    several = F.concat(F.lit("Inactive Ingredients (x, y) - "), F.replace("c", F.lit(","), F.lit(";")), F.lit(", Shea, Seed, Butter, 1,2-Hexanediol, May contain mica"))
    label = F.when(kind == 0, headed).when(kind == 1, F.upper("s")).when(kind == 2, F.replace("c", F.lit(" "), F.lit(", "))).when(kind == 3, several).otherwise(F.col("b"))
    return l.select("id", label.alias("label"))


def _of_labels(mode: str) -> str:
    return tokens_sql(LABELS if not LABELS.startswith("lines") else f"WITH {LABELS}", mode, f"SELECT {_name('p_name')} FROM part")


@query(_of_labels("v1"))
def catalog_tokens_v1(spark, d):
    terms = read(spark, d, "part").select(inci_normalize("p_name").alias("term"))
    return lb.tokenize_labels(labels(spark, d), "label", terms, "v1").select("id", F.array_join("tokens", "|").alias("tokens"))


@query(_of_labels("v2"))
def catalog_tokens_v2(spark, d):
    terms = read(spark, d, "part").select(inci_normalize("p_name").alias("term"))
    return lb.tokenize_labels(labels(spark, d), "label", terms, "v2").select("id", F.array_join("tokens", "|").alias("tokens"))
