"""Tokens by a table of regular expressions or by a catalog, and links of pages, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import web
from ..operators import formulas, lists
from .queries import norm, query, read


@query(
    r"""WITH k AS (SELECT CASE p_size % 3 WHEN 0 THEN '^' || p_name || ' brand#1?[2-5] ' WHEN 1 THEN split_part(p_name, ' ', 2) || ' ' || lower(p_brand) || '\s+(econ|prom)|zz' || split_part(p_name, ' ', 2)
      ELSE substr(p_name, 1, 2) || '[a-z]+ [a-z]+ brand#(7|8) l' END AS pattern, min(p_type) AS reason FROM part GROUP BY 1),
    t AS (SELECT p_name || ' ' || p_brand || ' ' || p_type AS token, count(*) AS n FROM part GROUP BY 1)
    SELECT min(reason) AS reason, 'delete' AS action, token, n FROM t JOIN k ON regexp_matches(token, '(?i)' || pattern) GROUP BY token, n"""
)
def pattern_findings(spark, d):
    """Findings by patterns that are made of the parts' own names, brands and types."""
    p = read(spark, d, "part")
    second, way = F.split_part("p_name", F.lit(" "), F.lit(2)), F.col("p_size") % 3
    pattern = (
        F.when(way == 0, F.concat(F.lit("^"), "p_name", F.lit(" brand#1?[2-5] ")))
        .when(way == 1, F.concat(second, F.lit(" "), F.lower("p_brand"), F.lit(r"\s+(econ|prom)|zz"), second))
        .otherwise(F.concat(F.substring("p_name", 1, 2), F.lit("[a-z]+ [a-z]+ brand#(7|8) l")))
    )
    patterns = p.groupBy(pattern.alias("pattern")).agg(F.min("p_type").alias("reason"))
    return lists.pattern_purge(p.select(F.concat_ws(" ", "p_name", "p_brand", "p_type").alias("token")), "token", patterns)[1]


_ENTRY = "p_name || ' ' || p_brand || ' ' || p_size"
_ALIAS = "p_brand || '-' || p_name || ' ' || p_type || ' ' || p_size"


@query(
    f"""WITH x AS (SELECT DISTINCT {norm(_ENTRY)} AS term, p_partkey AS id FROM part UNION SELECT {norm(_ALIAS)}, p_partkey FROM part WHERE p_partkey % 2 = 0), one AS (SELECT term, min(id) AS id FROM x GROUP BY 1 HAVING count(*) = 1),
    t AS (SELECT p_partkey AS input, 1 AS position, upper({_ENTRY}) AS token FROM part UNION ALL SELECT p_partkey, 2, {_ALIAS} FROM part UNION ALL SELECT p_partkey, 3, p_type FROM part UNION ALL SELECT p_partkey, 4, '!?' FROM part), n AS (SELECT input, position, {norm('token')} AS term FROM t)
    SELECT input, position, id FROM n LEFT JOIN one USING (term) WHERE term <> ''"""
)
def tokens_to_entries(spark, d):
    """Tokens with the only catalog entry of that name or alias; names of two entries resolve to none."""
    p = read(spark, d, "part")
    of = lambda position, token: p.select(F.col("p_partkey").alias("input"), F.lit(position).alias("position"), F.expr(token).alias("token"))
    tokens = of(1, f"upper({_ENTRY})").unionAll(of(2, _ALIAS)).unionAll(of(3, "p_type")).unionAll(of(4, "'!?'"))
    catalog = p.select(F.expr(_ENTRY).alias("name"), F.col("p_partkey").alias("id"))
    return formulas.resolve_tokens(tokens, catalog, p.where("p_partkey % 2 = 0").select(F.expr(_ALIAS).alias("alias"), F.col("p_partkey").alias("id")))


@query("SELECT page_id, regexp_extract(url, '^https?://[^/]+', 0) || nullif(regexp_extract(html, '(?is)<a\\b[^>]*?href\\s*=\\s*[\"'']([^\"'']+)', 1), '') AS link FROM pages")
def page_links(spark, d):
    """The first link of each page as seen from its address; null without one."""
    return read(spark, d, "pages").select("page_id", web.resolved_link("url", web.first_link("html")).alias("link"))
