"""Requests and raw answers on small texts."""

from urllib.parse import urljoin

from pyspark.sql import functions as F

from sparkurate.functions import web
from sparkurate.sources import answers, lookups


def test_requests(spark):
    df = spark.createDataFrame([("aqua", "7732-18-5", ["1", None, "", "2"]), ("aqua", None, [""]), ("aqua", "", None)], "n string, c string, l array<string>")
    got = df.select(answers.search_term("n", "c"), answers.values_query("l")).collect()
    assert [r[0] for r in got] == ['("aqua"[tiab] OR 7732-18-5[rn])', '"aqua"[tiab]', '"aqua"[tiab]']
    assert 'VALUES ?cas { "1" "2" } ?item wdt:P231 ?cas . OPTIONAL { ?item wdt:P232 ?ec . }' in got[0][1] and got[1][1] is got[2][1] is None


def test_answers(spark):
    found = "<eSearchResult><Count>2</Count><IdList><Id>5</Id><Id></Id><Id>7</Id></IdList></eSearchResult>"
    df = spark.createDataFrame([(1, found), (2, "<eSearchResult><IdList/></eSearchResult>"), (3, None), (4, "no xml")], "i int, a string")
    assert [r[0] for r in df.orderBy("i").select(answers.found_ids("a")).collect()] == [["5", "7"], [], [], []]

    article = "<PubmedArticle><MedlineCitation><PMID>{}</PMID><Article>{}</Article></MedlineCitation></PubmedArticle>"
    several = article.format(1, "<ArticleTitle>A</ArticleTitle><Journal><JournalIssue><PubDate><Year>2001</Year></PubDate></JournalIssue><Title>J</Title></Journal><Abstract><AbstractText> x </AbstractText><AbstractText Label='B'>y</AbstractText></Abstract>") + article.format(2, "<Journal/>") + article.format(3, "<ArticleTitle>C</ArticleTitle><Journal><JournalIssue><PubDate><Year>soon</Year></PubDate></JournalIssue></Journal>")
    df = spark.createDataFrame([(1, f"<PubmedArticleSet>{several}</PubmedArticleSet>"), (2, "<PubmedArticleSet/>"), (3, None), (4, "{}")], "i int, answer string")
    assert sorted(map(tuple, answers.articles(df).collect())) == [(1, "1", "A", "x y", "J", 2001), (1, "3", "C", "", None, None)]

    full = '{"head": {}, "results": {"bindings": [{"cas": {"value": "1"}, "item": {"type": "uri", "value": "q"}}, {"cas": {"value": "2"}}, {"cas": {"value": "3"}, "item": {"value": "r"}, "ec": {"value": "e"}, "formula": {"value": "H"}}]}}'
    df = spark.createDataFrame([(1, full), (2, '{"results": {}}'), (3, "no json"), (4, None)], "i int, answer string")
    assert sorted(map(tuple, answers.bindings(df).collect())) == [(1, "1", "q", None, None, None), (1, "3", "r", "e", None, "H")]
    assert answers.bindings(df.where(F.lit(False))).count() == 0


def test_links_are_resolved_as_seen_from_their_page(spark):
    bases = ["https://a.org/b/c/d?q=1#f", "http://a.org", "https://a.org/", "https://a.org/x/"]
    links = ["g", "./g", "g/", "/g", "//h.org/a", "?y=2", "g?y", "#s", "..", "../g", "../../../g", "../..", "./../g/.", "g/../h", "https://z.org/a?b", "mailto:x@y", "a/b/../../c?d=../e"]
    rows = [(b, x) for b in bases for x in links]
    got = spark.createDataFrame(rows, "b string, l string").select("b", "l", web.resolved_link("b", "l").alias("u")).collect()
    assert {(r["b"], r["l"]): r["u"] for r in got} == {(b, x): urljoin(b, x) for b, x in rows}


def test_page_evidence(spark):
    names = spark.createDataFrame([("aqua",), ("aqua",), ("glycerin",), ("citric acid",), ("talc",), ("mica",), ("lost",), (None,), ("",)], "name string")
    pages = spark.createDataFrame(
        [("https://s.org/i/aqua", "<h1>Aqua</h1><title>no</title>"), ("https://s.org/i/glycerin", "<h1>Other</h1>"), ("https://s.org/i/7", "<title>Glycerol &amp; co</title>"), ("https://s.org/i/citric-acid", "<title> Citric <b>Acid</b></title>"),
         ("https://s.org/i/talc", None), ("https://s.org/i/9", "<p>no heading</p>"), (None, "<h1>x</h1>")],
        "url string, html string",
    )
    searches = spark.createDataFrame([("glycerin", "<a href='/x'>x</a><A class=r HREF='/i/7?a=1'>"), ("talc", '<a href="8">no</a>'), ("mica", '<a href="i/9#t">'), ("lost", "<a href='../../i/none'>"), ("aqua", '<a href="/i/7">'), (None, "x")], "name string, html string")
    got = {r["name"]: (r["found"], r["canonical"], r["url"], r["confidence"]) for r in lookups.page_evidence(names, pages, searches, "https://s.org/i/{slug}", "https://s.org/search", "i/").collect()}
    assert got == {
        "aqua": (True, "Aqua", "https://s.org/i/aqua", 0.92),
        "glycerin": (True, "Glycerol & co", "https://s.org/i/7", 0.92),
        "citric acid": (True, "Citric Acid", "https://s.org/i/citric-acid", 0.92),
        "talc": (False, None, "https://s.org/i/talc", None),
        "mica": (False, None, "https://s.org/i/9", None),
        "lost": (False, None, "https://s.org/i/none", None),
        "": (False, None, "https://s.org/i/", None),
    }
