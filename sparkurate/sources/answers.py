"""Requests to literature and compound services as text, and their raw answers as rows: tables of answers are all that is needed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import _col

# The parts of an answer that are read.
ARTICLES = "PubmedArticle array<struct<MedlineCitation struct<PMID string, Article struct<ArticleTitle string, Journal struct<Title string, JournalIssue struct<PubDate struct<Year string>>>, Abstract struct<AbstractText array<string>>>>>>"
BINDING = ("cas", "item", "ec", "inchi", "formula")
BINDINGS = f"results struct<bindings array<struct<{', '.join(f'{b}: struct<value: string>' for b in BINDING)}>>>"


def search_term(name: Column | str, cas: Column | str) -> Column:
    """What to search articles for: the name in title or abstract, or else the registry number, if there is one."""
    own = F.concat(F.lit('"'), _col(name), F.lit('"[tiab]'))
    number = _col(cas)
    return F.when(F.coalesce(number, F.lit("")) != "", F.concat(F.lit("("), own, F.lit(" OR "), number, F.lit("[rn])"))).otherwise(own)


def values_query(numbers: Column | str) -> Column:
    """The query for an array of registry numbers; null and empty ones are left out, and null if none is left."""
    some = F.filter(_col(numbers), lambda n: n.isNotNull() & (n != ""))
    values = F.array_join(F.transform(some, lambda n: F.concat(F.lit('"'), n, F.lit('"'))), " ")
    optional = " ".join(f"OPTIONAL {{ ?item wdt:{p} ?{v} . }}" for p, v in (("P232", "ec"), ("P234", "inchi"), ("P274", "formula")))
    query = F.concat(F.lit(f"SELECT {' '.join('?' + b for b in ('item', 'cas', 'ec', 'inchi', 'formula'))} WHERE {{ VALUES ?cas {{ "), values, F.lit(f" }} ?item wdt:P231 ?cas . {optional} }}"))
    return F.when(F.size(some) > 0, query)


def found_ids(answer: Column | str) -> Column:
    """Ids in the XML answer to a search, in order; an answer that isn't XML has none."""
    listed = F.from_xml(_col(answer), "IdList struct<Id array<string>>")
    return F.coalesce(F.filter(listed["IdList"]["Id"], lambda i: i.isNotNull() & (i != "")), F.array().cast("array<string>"))


def articles(answers: DataFrame, answer: str = "answer") -> DataFrame:
    """The other columns of answers with pmid, title, abstract, journal, year of each article that has an id and a title.

    Parts of an abstract are trimmed and joined by spaces. An answer that isn't XML gives no row; a year that is no number is null.
    """
    rest = [c for c in answers.columns if c != answer]
    cited = answers.select(*rest, F.explode(F.from_xml(answer, ARTICLES)["PubmedArticle"]["MedlineCitation"]).alias("_a"))
    article = F.col("_a.Article")
    parts = F.filter(F.transform(article["Abstract"]["AbstractText"], lambda t: F.btrim(t)), lambda t: t != "")
    rows = cited.select(
        *rest, F.col("_a.PMID").alias("pmid"), article["ArticleTitle"].alias("title"), F.coalesce(F.array_join(parts, " "), F.lit("")).alias("abstract"),
        article["Journal"]["Title"].alias("journal"), article["Journal"]["JournalIssue"]["PubDate"]["Year"].try_cast("int").alias("year"),
    )
    return rows.where("pmid is not null and title is not null")


def bindings(answers: DataFrame, answer: str = "answer") -> DataFrame:
    """The other columns of answers with cas, item, ec, inchi, formula of each binding of a JSON answer; what a binding lacks is null.

    A binding without cas or item, and an answer that isn't JSON, give no row.
    """
    rest = [c for c in answers.columns if c != answer]
    each = answers.select(*rest, F.explode(F.from_json(answer, BINDINGS)["results"]["bindings"]).alias("_b"))
    return each.select(*rest, *[F.col(f"_b.{b}.value").alias(b) for b in BINDING]).where("cas is not null and item is not null")
