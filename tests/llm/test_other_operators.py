"""Vectors, archives, pages and the pipeline."""

import hashlib
import html
import random
import re
import time
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from sparkurate.llm import embedding_dedup, html_text, queries, warc

from .conftest import prose


def test_near_duplicates_against_all_pairs(spark):
    r = np.random.default_rng(4)
    x = r.normal(size=(300, 12))
    x[100:180] = x[0] + 0.25 * r.normal(size=(80, 12))
    x[180:200] = x[1] * r.uniform(0.5, 2, (20, 1))
    x[200:220] = x[2]
    rows = [(i, [float(v) for v in e]) for i, e in enumerate(x)]
    odd = [(300, None), (301, []), (302, [0.0] * 12), (303, [None] + [1.0] * 11), (304, [float("nan")] + [1.0] * 11), (305, [float("inf")] + [1.0] * 11), (306, [1.0] * 5)]
    got = {g.vec_id: g for g in embedding_dedup.near_duplicates(spark.createDataFrame([(*y, "n", 1) for y in rows + odd], "vec_id long, embedding array<double>, m string, side int"), 0.9).collect()}
    n = np.linalg.norm(x, axis=1)
    link = (x @ x.T) / np.outer(n, n) >= 0.9
    np.fill_diagonal(link, False)
    label = np.arange(300)
    for _ in range(300):
        new = np.array([min([label[i], *label[link[i]]]) for i in range(300)])
        if (new == label).all():
            break
        label = new
    for i in range(300):
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (link[i].sum(), label[i], label[i] == i)
    for i, _ in odd:
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True)


def test_near_duplicates_of_each_dimension(spark):
    rows = [(1, [1.0, 0.0]), (2, [1.0, 0.01]), (3, [1.0, 0.0, 0.0]), (4, [1.0, 0.0, 0.0]), (5, [1.0, 0.1, 0.0]), (6, [0.0, 1.0, 0.0]), (7, [5.0]), (8, [1.0] * 4)]
    got = {tuple(x) for x in embedding_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert got == {(1, 1, 1, True), (2, 1, 1, False), (3, 2, 3, True), (4, 2, 3, False), (5, 2, 3, False), (6, 0, 6, True), (7, 0, 7, True), (8, 0, 8, True)}


def test_near_duplicates_of_floats_and_nothing(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 3.0]), (None, [1.0, 0.0])], "vec_id long, embedding array<float>")
    got = sorted(embedding_dedup.near_duplicates(df).collect(), key=str)
    assert Counter((r.vec_id, r.n_links, r.component_id, r.kept) for r in got) == Counter({(1, 1, 1, True): 2, (2, 0, 2, True): 1, (None, 0, None, True): 1})
    assert embedding_dedup.near_duplicates(df.where("false")).count() == 0


def test_near_duplicates_of_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "BLOCK", 40 * 12 * 8)
    monkeypatch.setattr(embedding_dedup, "PART", 2)
    test_near_duplicates_against_all_pairs(spark)
    links = embedding_dedup.TaskLinks(limit=3)
    for i in (1, 3, 2, 9, 7):
        links.add(np.array([i, i + 1]), np.array([i, i]), np.array([1, 1]))
    assert list(zip(*map(list, links.rows()), strict=True)) == [(1, 1, 1), (2, 1, 2), (3, 1, 2), (4, 1, 1), (7, 7, 1), (8, 7, 1), (9, 9, 1), (10, 9, 1)]


def test_near_duplicates_copy_no_vectors_for_each_pair_of_blocks(spark):
    """Bytes shuffled stay in proportion to the vectors."""
    written = {}
    shuffled = lambda: spark.sparkContext._jsc.sc().statusStore().executorSummary("driver").totalShuffleWrite()
    for n in (8_000, 64_000):
        df = spark.range(n).select(F.col("id").alias("vec_id"), F.array(*[F.randn(i) for i in range(16)]).alias("embedding"))
        before = shuffled()
        assert embedding_dedup.near_duplicates(df).count() == n
        time.sleep(1)  # figures are brought up to date now and then
        written[n] = shuffled() - before
    assert 0 < written[64_000] < 1.5 * 8 * written[8_000]


PAGES = [(1, "http://a/1", "x" * 2000), (2, "http://a/2\r\nx", "x" * 2000), (3, None, "x" * 2000), (4, "u", "x" * 999), (5, "u", "x" * 999), (6, "u", None), (7, "u", ""), (8, "u", "é" * 50_000), (9, "u", "é" * 50_000), (9, "u", "é" * 50_000), (10, "u", "\r\n\r\nWARC/1.1\r\nContent-Length: 5\r\n\r\n" * 99), (None, "u", "x" * 2000), (None, "u", "only here" * 200)]


def test_archives(spark, tmp_path):
    path = f"file://{tmp_path}/warc"
    warc.write_archives(spark.createDataFrame([(*p, "z") for p in PAGES], "page_id long, url string, html string, digest string").repartition(3), path)
    got = warc.read_archives(spark, path).collect()
    by = defaultdict(list)
    for i, _, h in PAGES:
        by[h or ""].append(i)
    want = Counter()
    for h, ids in by.items():
        top = max((i for i in ids if i is not None), default=None)
        for i in ids:
            again = len(h.encode()) >= 1000 and i is not None and i != top
            want[(i, len(h.encode()), hashlib.sha1(h.encode()).hexdigest(), "revisit" if again else "response", top if again else None, h.encode())] += 1
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, bytes(r.payload)) for r in got) == want
    warc.write_archives(spark.createDataFrame([], "page_id long, url string, html string"), f"file://{tmp_path}/none")
    assert warc.read_archives(spark, f"file://{tmp_path}/none").count() == 0


def test_segments_that_are_missing_are_noticed():
    made = warc.records(1, "u", b"a" * 100_000, hashlib.sha1(b"a" * 100_000).hexdigest(), None, None)
    assert len(made) == 4
    found = list(warc.parse([b"\r\n\r\n".join([*made, b""])]))
    assert [h.get("warc-segment-number") for h, _ in found] == ["1", "2", "3", "4"] and found[0][0]["warc-type"] == "response" and found[3][0]["warc-segment-total-length"] == str(sum(len(b) for _, b in found))
    assert warc.payload_of(b"".join(b for _, b in found)) == b"a" * 100_000
    with pytest.raises(ValueError):
        warc.payload_of(b"".join(b for _, b in found[:3]))
    with pytest.raises(ValueError):
        list(warc.parse([made[0][:-5]]))


def test_main_text_cases():
    t = html_text.main_text
    assert t(None) == "" and t("") == "" and t("<p") == ""
    page = "<body><nav><a href=/>Home</a></nav><article><header><h1>A &amp; B</h1><p>by someone</p></header><p>First\n  &eacute;t&#233;<br>line<p>Second <i>one</i>.<div class='promo ad'>Buy</div><ul><li>x<li>y</ul><script>var a='<p>no</p>'</script><!-- <p>no</p> --><p>Third &lt;b&gt; one</p><section id=comments><p>Nice text here, and more of it!</p></section></article><aside><p>Read also</p></aside><footer>end"
    assert t(page) == "A & B\n\nFirst été line\n\nSecond one.\n\nx\n\ny\n\nThird <b> one"
    for p in html_text.TRAINING:
        inner = p[p.index("[[") + 2 : p.index("]]")]
        want = " ".join(html.unescape(re.sub("<[^>]*>", " ", inner)).split())
        assert " ".join(t(p.replace("[[", "").replace("]]", "")).split()) == want
    assert t("<article><p>" + "word " * 200_000 + "</article>") == ("word " * 200_000).strip()


def test_names_leave_out_notes_only():
    """Names of wrappers and of the article's own sections leave nothing out; those of notes do."""
    t = html_text.main_text
    text = "<h1>Sea</h1><p>One two three four.</p><section id='related-work'><h2 id='search'>Search</h2><p>Five six seven.</p></section><section id='cookies'><p>Eight nine.</p></section><p title='a hidden gem'>Ten.</p>"
    want = "Sea\n\nOne two three four.\n\nSearch\n\nFive six seven.\n\nEight nine.\n\nTen."
    for frame in ("<main class='overflow-hidden'>{}</main>", "<body class='has-sidebar'>{}</body>", "<body class='cookies-not-set'>{}", "<html class=hidden><body style='display:none'><article id=comments class='post tags'>{}</article>", "<div class='content-with-sidebar'>{}</div>", "<div class='hidden md:block'>{}</div>", "<div class='page-sidebar'><main>{}</main></div>", "<div data-id=search>{}</div>"):
        assert t(frame.format(text)) == want, frame
    assert t("<article><div class=header><h1>Sea</h1><p>by one</p></div><p>One two three.</p></article>") == "Sea\n\nOne two three."
    for note in ("class=sidebar", "class='x related-posts'", "class=mainNav", "id=site-search", "role=navigation", "aria-label='cookie consent'", "hidden", "aria-hidden='true'", "style='display: none'"):
        assert t(f"<article>{text}<div {note}><p>No no no.</p></div><p>End.</p></article>") == want + "\n\nEnd.", note


LINKS = "<ul>" + "".join(f"<li><a href='/{i}'>Three words {i}</a></li>" for i in range(20)) + "</ul>"
FRAMES = ["<article>{}</article>", "<main>{}</main>", "<main><article>{}</article><div><h2>More</h2>" + LINKS + "</div></main>", "<div>{}</div>", "<section><div>{}</div></section>", "{}"]


@pytest.mark.parametrize("frame", FRAMES)
def test_links_of_an_article(frame):
    """Bylines, tables of contents, links in tables and lists of sources are the article's; lists around it are not."""
    text = "<p>The sea comes and goes twice a day, as the moon pulls it.</p>"
    more = "<h2>Why</h2><p>So it <a href='/is'>is</a>.</p>"
    for parts in (
        ["<p><a href='/j'>Jane Doe</a></p>", text, more],
        [LINKS, text, more],
        [text, more, "<h2>Sources</h2>", LINKS],
        [text, LINKS, "<p>Few words at the end.</p>"],
        [text, "<table><tr><td><a href='/h'>High</a></td><td>6.10</td></tr></table>", more, "<p><a href='/1'>One</a>, <a href='/2'>two</a></p>"],
    ):
        inner = "<h1>Sea Tides</h1>" + "".join(parts)
        page = f"<body><nav>{LINKS}</nav><div>{LINKS}</div>{frame.format(inner)}<div><a href='/t'>Terms of use</a> <a href='/p'>Privacy</a></div><footer><p>A paper</p></footer></body>"
        want = re.sub(r"\s+", " ", re.sub("<[^>]*>", " ", inner)).split()
        got = html_text.main_text(page).split()
        assert "".join(got) == "".join(want), (parts, " ".join(got))


def test_links_around_an_article():
    """Menus that nothing marks are no part of it, and bare text of div elements is."""
    t = html_text.main_text
    assert t(f"<main>{LINKS}<h1>Title</h1><p>One two.</p></main>") == "Title\n\nOne two."
    got = t(f"<body>{LINKS}<div>Text one two<br><br>Text three <a href=x>link</a> four five six seven eight nine ten eleven.<br>End words.</div><div><a href=/>Terms</a></div>")
    assert got == "Text one two Text three link four five six seven eight nine ten eleven. End words."
    assert t(f"<body><h1><a href=/>Site</a></h1>{LINKS}<div><h2>Title here</h2><p>One two three four five six.</p></div><div><h3>Related</h3>{LINKS}</div>") == "Title here\n\nOne two three four five six."


def test_pages_table(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").withColumn("text", F.lit("old"))
    got = {r.page_id: r for r in html_text.extract(pages).collect()}
    for p in pages.collect():
        inner = re.search("<article>(.*)</article>", p.html, re.S)[1]
        blocks = (" ".join(html.unescape(re.sub("</?b>", "", b.replace("<br>", " "))).split()) for b in re.split("</?(?:p|h1)>", inner))
        want = "\n\n".join(b for b in blocks if b)
        assert (got[p.page_id].text, got[p.page_id].n_chars, got[p.page_id].url) == (want, len(want), p.url)
    assert html_text.extract(pages.where("false")).count() == 0


def test_queries_have_the_columns_of_their_contracts(spark, sf_dir):
    made = queries.queries()
    assert [int(k[2:].split("_")[0]) for k in sorted(made, key=lambda k: int(k[2:].split("_")[0]))] == list(range(1, 11))
    assert set(queries.oracle_sql()) <= set(made)


def test_pipeline_stages(spark, tmp_path):
    """Each stage on a small corpus with planted cases."""
    r = random.Random(2)
    passage = prose(77, 70)
    rows, labels = [], []
    for i in range(120):
        text = prose(1000 + i, 150)
        if i % 6 == 0:
            text = text.replace(" ", " vileword ", 1)
        if i < 100:
            labels.append((i, 1, int(i % 6 == 0)))
        rows.append((i, text, "en", f"s{i % 3}", len(text)))
    near = rows[1][1].split()
    near[75] = "new"
    rows += [(200, rows[1][1], "en", "s0", 0), (201, " ".join(near), "en", "s1", 0), (202, prose(5, 60) + " " + passage, "en", "s2", 0), (203, passage + " " + prose(6, 60), "en", None, 0), (204, None, None, None, None), (204, "  ", "en", "s1", 2)]
    r.shuffle(rows)
    d = str(tmp_path)
    spark.createDataFrame([(*x, "a") for x in rows], "doc_id long, text string, lang string, source string, n_chars long, component_id string").write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    docs = spark.read.parquet(f"{d}/documents.parquet")
    columns, seen = docs.columns, []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, d).write.parquet(f"{d}/stage{i}")
        docs = spark.read.parquet(f"{d}/stage{i}")
        seen.append(docs.collect())
        assert i == 4 or docs.columns == columns
    good, one, cut, mixed, packed = seen
    assert {x.doc_id for x in good} >= {i for i in range(120) if i % 6} | {200, 201, 202, 203} and not {x.doc_id for x in good} & {i for i in range(120) if i % 6 == 0}
    assert {x.doc_id for x in one} == {x.doc_id for x in good} - {200, 201}
    left = {x.doc_id: x for x in cut}
    assert left[202].text.split() == prose(5, 60).split() and left[203].text.split() == prose(6, 60).split() and left[203].n_chars == len(left[203].text)
    words = lambda t: len((t or "").split())
    total = Counter()
    for x in mixed:
        total[x.source] += words(x.text)
    size = Counter()
    for x in cut:
        size[x.source] += words(x.text)
    assert abs(sum(total.values()) - 1.5 * sum(size.values())) <= 4 and all(total[s] <= 2 * size[s] for s in total)
    full = [x.text for x in cut if x.source == "s1"]
    assert all(any(t.startswith(x.text) for t in full) for x in mixed if x.source == "s1")
    assert Counter(x.doc_id for x in packed if x.piece == 0) == Counter(x.doc_id for x in mixed)
    out = corpus_pipeline.run(spark, d)
    assert Counter(tuple(x) for x in out.select("doc_id", "piece", "length", "ids_crc32").collect()) == Counter((x.doc_id, x.piece, x.length, x.ids_crc32) for x in packed)


def test_pipeline_of_nothing_and_of_equal_rows(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/a/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/a/labels.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/a").count() == 0
    rows = [(None, "one two three four", "en", "s", 18)] * 2 + [(7, prose(i, 40), "en", "s", 1) for i in range(3)]
    docs = spark.createDataFrame(rows, schema)
    mixed = corpus_pipeline.mixed(spark, docs, str(tmp_path)).collect()
    assert abs(sum(len(r.text.split()) for r in mixed) - 1.5 * 128) <= 1
    assert sum(r.doc_id is None for r in mixed) <= 4
    one = corpus_pipeline.one_of_each(spark, docs, str(tmp_path)).collect()
    assert sorted((r.doc_id is None, r.text) for r in one) == sorted([(True, rows[0][1]), *((False, r[1]) for r in rows[2:])])


def test_archives_of_one_member_for_each_record(spark, tmp_path):
    """As most archives are made, with records of other kinds, and responses without a digest or chunks."""
    import gzip

    plain = "\r\n".join(["WARC/1.0", "WARC-Type: response", "WARC-Record-ID: <urn:uuid:1>", "WARC-Target-URI: http://x/", "Content-Length: 24", "", ""]).encode() + b"HTTP/1.1 200 OK\r\n\r\nhello"
    info = b"WARC/1.0\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:uuid:0>\r\nContent-Length: 3\r\n\r\nabc"
    body = ("z" * 90_000).encode()
    made = warc.records(5, "http://y/", body, hashlib.sha1(body).hexdigest(), None, None)
    (tmp_path / "w").mkdir()
    (tmp_path / "w" / "a.warc.gz").write_bytes(b"".join(gzip.compress(r + b"\r\n\r\n") for r in [info, plain, *made]))
    got = {r.url: r for r in warc.read_archives(spark, f"file://{tmp_path}/w").collect()}
    assert bytes(got["http://x/"].payload) == b"hello" and got["http://x/"].payload_digest == hashlib.sha1(b"hello").hexdigest()
    assert bytes(got["http://y/"].payload) == body and len(got) == 2
    for size in (1, 7, 1 << 20):
        assert len(list(warc.parse(warc.inflated((tmp_path / "w" / "a.warc.gz").read_bytes(), size)))) == 2 + len(made)
    with pytest.raises(ValueError):
        list(warc.inflated((tmp_path / "w" / "a.warc.gz").read_bytes()[:-9]))


def test_tags_as_browsers_read_them():
    t = html_text.main_text
    assert t("<article><p>If a < b and c <5 then stop.</p><p title=it's>The second one.</p><p>The last one.</p></article>") == "If a < b and c <5 then stop.\n\nThe second one.\n\nThe last one."
    assert t("<article><p class='share-price'>The price rose by two.</p><p data-x=\"a>b\">It fell later.</p></article>") == "The price rose by two.\n\nIt fell later."
    for body in ("<body class='header-fixed nav-open'>", "<body><div class='page with-sidebar'>", "<body><main class='overflow-hidden'>"):
        assert t(f"{body}<h1>Tides</h1><p>The moon pulls the sea, and the sea follows twice each day.</p>") == "Tides\n\nThe moon pulls the sea, and the sea follows twice each day."
    assert t("<article><!-- a <p>no</p> --><p>Yes, this one.</p><!x><?y><p>And this.</p></article></>") == "Yes, this one.\n\nAnd this."
    assert t("<article><table><tr><td>One cell</p></td></tr></table><p>Behind the table.</p></article>") == "One cell\n\nBehind the table."


@pytest.mark.parametrize("page", ["<a " * 120_000 + "'", "<div>" * 30_000 + "</p>" * 30_000, "<p><table>" + "<div>" * 30_000 + "</p>" * 40_000, "<!--" * 90_000, "<script>" * 40_000, "<a b='" * 60_000, "</" * 100_000, "<header>" * 15_000 + "<h1>x</h1>" * 15_000, "<nav>" * 20_000 + "<main></main>" * 12_000])
def test_hostile_pages_take_linear_time(page):
    import time

    began = time.process_time()
    html_text.main_text(page)
    assert time.process_time() - began < 2
