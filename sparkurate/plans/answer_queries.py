"""Raw answers of services, written from the parts, read back as rows, with the SQL of what they say."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions import web
from ..sources import answers, lookups
from .queries import norm, query, read


@query("SELECT p_partkey // 10 AS request, p_partkey::VARCHAR AS pmid, p_name || ' <' || p_brand || '> & co' AS title, CASE p_partkey % 4 WHEN 0 THEN '' WHEN 1 THEN p_type ELSE p_type || ' of ' || p_size || ' ' || p_name END AS abstract, CASE WHEN p_size % 2 = 0 THEN p_brand END AS journal, CASE WHEN p_size % 3 > 0 THEN 1970 + p_size END AS year FROM part WHERE p_partkey % 7 > 0")
def article_answers(spark, d):
    p, k = read(spark, d, "part"), F.col("p_partkey")
    text = lambda c: F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    tag = lambda name, *inner: F.concat(F.lit(f"<{name}>"), *inner, F.lit(f"</{name.partition(' ')[0]}>"))
    part = lambda c: tag('AbstractText Label="x"', F.lit("\n "), c, F.lit(" "))
    abstract = F.when(k % 4 == 0, "").when(k % 4 == 1, tag("Abstract", part(F.col("p_type")))).otherwise(tag("Abstract", part(F.concat("p_type", F.lit(" of "), F.col("p_size").cast("string"))), part(F.lit("")), part(F.col("p_name"))))
    year = F.when(F.col("p_size") % 3 > 0, tag("Year", (F.col("p_size") + 1970).cast("string"))).otherwise(tag("MedlineDate", F.lit("Spring")))
    journal = tag("Journal", tag("JournalIssue", tag("PubDate", year)), F.when(F.col("p_size") % 2 == 0, tag("Title", "p_brand")).otherwise(""))
    title = F.when(k % 7 > 0, tag("ArticleTitle", text(F.concat("p_name", F.lit(" <"), "p_brand", F.lit("> & co"))))).otherwise("")
    one = tag("PubmedArticle", tag("MedlineCitation Status='x'", tag("PMID Version='1'", k.cast("string")), tag("Article PubModel='Print'", journal, title, abstract)))
    whole = p.groupBy(F.floor(k / 10).alias("request")).agg(tag("PubmedArticleSet", F.array_join(F.collect_list(one), "")).alias("answer"))
    return answers.articles(whole)


@query("SELECT p_partkey // 40 AS request, 'c' || p_partkey AS cas, 'http://x/Q' || p_size AS item, CASE WHEN p_size % 2 = 0 THEN p_brand END AS ec, CASE WHEN p_size % 3 = 0 THEN 'InChI=\"1\"/' || p_name END AS inchi, CASE WHEN p_size % 5 = 0 THEN p_type END AS formula FROM part WHERE p_partkey % 6 > 0")
def binding_answers(spark, d):
    p, k = read(spark, d, "part"), F.col("p_partkey")
    value = lambda c: F.when(c.isNotNull(), F.struct(F.lit("literal").alias("type"), c.alias("value")))
    size = F.col("p_size")
    binding = F.struct(
        value(F.when(k % 6 > 0, F.concat(F.lit("c"), k.cast("string")))).alias("cas"), value(F.concat(F.lit("http://x/Q"), size.cast("string"))).alias("item"), value(F.when(size % 2 == 0, F.col("p_brand"))).alias("ec"),
        value(F.when(size % 3 == 0, F.concat(F.lit('InChI="1"/'), "p_name"))).alias("inchi"), value(F.when(size % 5 == 0, F.col("p_type"))).alias("formula"),
    )
    whole = p.groupBy(F.floor(k / 40).alias("request")).agg(F.to_json(F.struct(F.struct(F.collect_list(binding).alias("bindings")).alias("results"))).alias("answer"))
    return answers.bindings(whole)


_H1 = "nullif(trim(regexp_replace(replace(replace(replace(replace(replace(regexp_replace(regexp_extract(html, '(?is)<h1\\b[^>]*>(.*?)</h1\\s*>', 1), '<[^>]*>', ' ', 'g'), '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&#39;', ''''), '&amp;', '&'), '\\s+', ' ', 'g')), '')"
_SITE = "https://example.org/ingredients/"


@query(
    f"""WITH h AS (SELECT page_id, page_id || ' ' || {_H1} AS h FROM pages), n AS (SELECT page_id AS id, h, {norm('h')} AS name, page_id % 3 AS way, page_id % 5 > 0 AS there FROM h WHERE h IS NOT NULL),
    f AS (SELECT *, way = 0 OR way = 1 AND there AS found FROM n)
    SELECT name, found, CASE WHEN found THEN h END AS canonical, CASE WHEN found THEN 0.92 END::DOUBLE AS confidence,
    CASE WHEN way = 1 THEN '{_SITE}p' || id ELSE '{_SITE}' || trim(regexp_replace(lower(strip_accents(name)), '[^a-z0-9]+', '-', 'g'), '-') END AS url FROM f"""
)
def page_evidence(spark, d):
    """The pages as those of a site: at their name's address, at another one that a search links to, or nowhere."""
    p = read(spark, d, "pages").select(F.col("page_id").alias("id"), F.replace("html", F.lit("<h1>"), F.concat(F.lit("<h1>"), F.col("page_id").cast("string"), F.lit(" "))).alias("html"))
    p = p.withColumn("h", web.element_text("html", "h1")).where("h is not null").withColumn("name", tx.normalize_name("h"))
    address, way, number = F.concat(F.lit(_SITE), tx.slug("name")), F.col("id") % 3, F.col("id").cast("string")
    there = p.where(way == 0).select(address.alias("url"), "html").unionByName(p.where((way == 1) & (F.col("id") % 5 > 0)).select(F.concat(F.lit(_SITE + "p"), number).alias("url"), "html"))
    wrong = p.where((way == 1) & (F.col("id") % 4 == 0)).select(address.alias("url"), F.lit("<title>another</title>").alias("html"))
    link = F.when(F.col("id") % 2 == 0, "../ingredients/p").otherwise("//example.org/ingredients/p")
    answer = F.when(way == 1, F.concat(F.lit('<a href="/about">x</a> <a class="r" href="'), link, number, F.lit('?from=search">y</a>'))).otherwise('<a href="/ingredients/">all</a>')
    out = lookups.page_evidence(p.select("name"), there.unionByName(wrong), p.select("name", answer.alias("html")), _SITE + "{slug}", "https://example.org/find/search")
    return out.select("name", "found", "canonical", "confidence", "url")
