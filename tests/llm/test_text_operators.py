"""Each operator on the odd rows, against a plain version."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkurate.llm import mixing, ngram_join, order_minhash, packing, quality, queries, substring_dedup, token_store
from sparkurate.llm.common import Scratch, components, prefix_sums

from .conftest import LONG, odd_rows, prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, n):
    w = WORD.findall("".join(c.lower() if c.isascii() else c for c in text or ""))
    return frozenset(tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))) if w else frozenset()


def groups(rows, n, num, den):
    """(id -> component) by comparing all pairs; rows with one id are one node."""
    sets = [(i, shingles(t, n)) for i, t in rows if i is not None]
    up = {i: i for i, _ in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, x in sets:
        for b, y in sets:
            k = len(x & y)
            if k and den * k >= num * (len(x) + len(y) - k):
                ra, rb = root(a), root(b)
                up[max(ra, rb)] = min(ra, rb)
    return {i: root(i) for i in up}


@pytest.mark.parametrize("n,num,den", [(4, 85, 100), (5, 80, 100)])
def test_ngram_join_odd(odd, n, num, den):
    rows = [r[:2] for r in odd_rows()]
    want = groups(rows, n, num, den)
    got = ngram_join.ngram_jaccard_components(odd, n, num, den).collect()
    assert Counter((r.doc_id, r.n_shingles) for r in got) == Counter((i, len(shingles(t, n))) for i, t in rows)
    for r in got:
        assert r.component_id == (None if r.doc_id is None else want[r.doc_id])


def all_links(rows, n, num, den):
    """((id, size, least id of an equal set) of each row, linked pairs of such least ids), by comparing all pairs."""
    sets = [(i, shingles(t, n)) for i, t in rows]
    rep = {}
    for i, s in sets:
        if s and i is not None:
            rep[s] = min(i, rep.get(s, i))
    sizes = Counter((i, len(s), None if i is None else rep.get(s, i)) for i, s in sets)
    pairs = set()
    for x, a in rep.items():
        for y, b in rep.items():
            k = len(x & y)
            if a < b and k and den * k >= num * (len(x) + len(y) - k):
                pairs.add((a, b))
    return sizes, pairs


@pytest.mark.parametrize("n,num,den", [(4, 85, 100), (5, 80, 100)])
def test_ngram_join_links_odd(odd, n, num, den):
    sizes, links = ngram_join.ngram_jaccard_links(odd, n, num, den)
    want_sizes, want = all_links([r[:2] for r in odd_rows()], n, num, den)
    assert Counter((r.doc_id, r.n_shingles, r.rep) for r in sizes.collect()) == want_sizes
    assert sorted((r.a, r.b) for r in links.collect()) == sorted(want)


def test_ngram_join_chains_and_frequent_tokens(spark):
    """A large group of near copies with many edits, and unrelated documents that share its passages."""
    import random

    base = prose(11, 120).split()
    r = random.Random(5)
    rows = []
    for i in range(150):
        w = list(base)
        for _ in range(r.randrange(0, 7)):
            w[r.randrange(len(w))] = f"e{r.randrange(10**6)}"
        rows.append((i, " ".join(w)))
    rows += [(1000 + i, " ".join(base[:60]) + " " + prose(100 + i, 60)) for i in range(40)]
    want = groups(rows, 4, 85, 100)
    got = ngram_join.ngram_jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), 4, 85, 100).collect()
    assert {x.doc_id: x.component_id for x in got} == want
    assert len(set(want.values())) < 150
    _, links = ngram_join.ngram_jaccard_links(spark.createDataFrame(rows, "doc_id long, text string"), 4, 85, 100)
    _, want = all_links(rows, 4, 85, 100)
    assert sorted((x.a, x.b) for x in links.collect()) == sorted(want)
    assert len(want) > 150


def test_ngram_join_compares_a_pair_in_one_list(spark, monkeypatch):
    """Near copies share dozens of lists; the pairs that are handed on don't grow with these."""
    import random

    base, r = prose(12, 150).split(), random.Random(6)
    rows = []
    for i in range(60):
        w = list(base)
        for at in r.sample(range(len(w)), r.randrange(1, 9)):
            w[at] = f"e{i}x{at}"
        rows.append((i, " ".join(w)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    made, plain = spark.sparkContext.accumulator(0), ngram_join.arrow_map

    def counting(df, f, schema):
        def counted(batches):
            for b in f(batches):
                made.add(b.num_rows)
                yield b

        return plain(df, counted if f.__name__ == "compare" else f, schema)

    monkeypatch.setattr(ngram_join, "arrow_map", counting)
    _, links = ngram_join.ngram_jaccard_links(docs, 4, 80, 100)
    _, want = all_links(rows, 4, 80, 100)
    assert sorted((x.a, x.b) for x in links.collect()) == sorted(want)
    assert len(want) > 100
    assert made.value <= 60 * 59 // 2 * 1.2
    made.value = 0
    got = ngram_join.ngram_jaccard_components(docs, 4, 80, 100).collect()
    assert {x.doc_id: x.component_id for x in got} == groups(rows, 4, 80, 100)
    assert made.value <= 60 * 59 // 2 * 1.2


def test_pipeline_writes_a_text_once(spark, odd):
    import corpus_pipeline

    rows = corpus_pipeline._numbered(odd, Scratch(spark, "once"))
    assert spark.read.parquet(*rows.inputFiles()).columns == [corpus_pipeline.REST, corpus_pipeline.ROW]
    assert Counter((x.doc_id, x.text) for x in rows.collect()) == Counter(r[:2] for r in odd_rows())


def test_signatures_meet():
    """Linked sets share a signature, whatever is frequent."""
    r = np.random.default_rng(1)
    counts = r.integers(0, 200, 1 << ngram_join.BITS)
    for n in [1, 2, 5, 6, 7, 20, 38, 39, 40, 41, 47, 48, 100, 155, 160, 165, 400, 640, 700, 2000]:
        for frequent in (-1, 100, 10**6):
            for num in (80, 85, 50):
                x = np.unique(r.integers(0, 2**64, n, dtype=np.uint64))
                lose = ngram_join.errors_allowed(len(x), num, 100)
                y = np.unique(np.delete(x, r.choice(len(x), lose, replace=False)))
                if len(y) and 100 * len(y) >= num * len(x):
                    a, b = (ngram_join.signatures(s, counts, frequent, num, 100) for s in (x, y))
                    assert np.intersect1d(a, b).size or len(x) == len(y), (n, frequent, num)


def test_components(spark):
    edges = [(i, i + 1) for i in range(100)] + [(200, i) for i in range(201, 260)] + [(300, 300), (500, 400), (None, 3)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long"), Scratch(spark, "t")).collect()}
    assert got == {**{i: 0 for i in range(101)}, **{i: 200 for i in range(200, 260)}, 400: 400, 500: 400}


@pytest.mark.parametrize("seed", [0, 1])
def test_components_of_random_graphs(spark, seed):
    """Sparse random links over negative and positive ids, and a hub in each of many tasks."""
    import random

    r = random.Random(seed)
    edges = [(r.randrange(-500, 500), r.randrange(-500, 500)) for _ in range(420)] + [(hub, x) for hub in (5000, 1000) for x in range(1001, 1400)]
    up = {x: x for e in edges if e[0] != e[1] for x in e}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        if a != b:
            a, b = root(a), root(b)
            up[max(a, b)] = min(a, b)
    got = components(spark.createDataFrame(edges, "a long, b long").repartition(7), Scratch(spark, "t")).collect()
    assert len(got) == len(up)
    assert {x.node: x.component for x in got} == {x: root(x) for x in up}


def removed(texts, depth):
    """Masks of bytes that a repeated stretch of depth bytes covers."""
    seen = Counter(t[s : s + depth] for t in texts for s in range(len(t) - depth + 1))
    for t in texts:
        mask = np.zeros(len(t), bool)
        for s in range(len(t) - depth + 1):
            if seen[t[s : s + depth]] > 1:
                mask[s : s + depth] = True
        yield mask


@pytest.mark.parametrize("depth", [24, 60, 400])
def test_substring_dedup_odd(odd, depth):
    rows = [((i), (t or "").encode()) for i, t, _ in odd_rows()]
    if depth < 400:  # the plain version keeps every stretch
        rows = [(i, t[:3000]) for i, t in rows]
    want = []
    for (i, t), m in zip(rows, removed([t for _, t in rows], depth), strict=True):
        kept = np.frombuffer(t, np.uint8)[~m].tobytes()
        want.append((i, len(t), int(m.sum()), int((np.diff(np.r_[0, m.astype(int)]) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    docs = odd.withColumn("text", F.expr("substring(text, 1, 3000)")) if depth < 400 else odd
    if depth < 400:  # cut by characters as the rows above, which are cut by bytes, only where all is ASCII
        docs = odd.withColumn("text", F.expr("cast(substring(cast(text as binary), 1, 3000) as string)"))
    got = [tuple(r) for r in substring_dedup.removed_spans(docs, depth).collect()]
    assert Counter(got) == Counter(want)


@pytest.mark.parametrize("depth", [24, 60, 400])
def test_substring_dedup_periodic(spark, depth):
    """Periodic texts of one union: only what starts at two places is repeated."""
    reach = max(1, depth // 3 // substring_dedup.STEP * substring_dedup.STEP)
    texts = []
    for k, n in enumerate([depth, depth + 1, depth + reach // 2, depth + reach - 1, depth + reach, depth + 2 * reach + 1]):
        for j, period in enumerate([1, 2, 3, 7, depth // 2, depth - 1, depth + 1]):
            at = 200 + 97 * (7 * k + j)  # letters of its own for each text
            texts.append(("".join(chr(at + i) for i in range(min(period, 97))) * n)[:n])
        run = "".join(chr(9000 + 200 * k + i) for i in range(60))
        texts.append((run[:10] + " -"[k % 2] * (n - 15) + run[10:15])[:n])
    texts += [texts[1], "x" * depth + "y" * reach, "y" + "x" * depth]
    rows = [(i, t.encode()) for i, t in enumerate(texts)]
    want = [(i, len(t), int(m.sum())) for (i, t), m in zip(rows, removed([t for _, t in rows], depth), strict=True)]
    got = substring_dedup.removed_spans(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), depth).select("doc_id", "n_bytes", "n_removed").collect()
    assert sorted(map(tuple, got)) == want
    alone = [(0, "a" * depth), (1, "bc" * (depth // 2)), (2, "#" * 5 + "-" * (depth - 2) + "=" * 3)]
    assert [r.n_removed for r in substring_dedup.removed_spans(spark.createDataFrame(alone, "doc_id long, text string"), depth).collect()] == [0, 0, 0]


def test_substring_dedup_words(spark):
    shared = prose(1, 60)
    rows = [(1, prose(20, 30) + " " + shared + "  " + prose(21, 30)), (2, shared), (3, prose(22, 80)), (4, None)]
    got = {r.doc_id: r.kept for r in substring_dedup.removed_spans(spark.createDataFrame(rows, "doc_id long, text string"), 50, "words", keep_text=True).collect()}
    assert got[1].split() == (prose(20, 30) + " " + prose(21, 30)).split()
    assert got[2] == "" and got[3] == rows[2][1] and got[4] == ""


def test_substring_dedup_words_of_one_window(spark):
    once = [(1, "the " * 50 + "end"), (2, "so on " * 25)]
    assert {r.doc_id: r.kept for r in substring_dedup.removed_spans(spark.createDataFrame(once, "doc_id long, text string"), 50, "words", keep_text=True).collect()} == dict(once)


def test_substring_dedup_query_counts_bytes_not_words(spark, tmp_path):
    """Of passages of 57 words the query leaves one of 399 bytes and removes one of 400; the operator on 50 words removes both."""
    short, long = (" ".join(f"{k}{i:05d}" for i in range(57)) + "x" * (n - 398) for k, n in (("p", 399), ("q", 400)))
    parts = [(prose(90 + i, 40) + "([<{"[i], passage, ")]>}"[i] + prose(190 + i, 40)) for i, passage in enumerate([short, short, long, long])]
    texts = ["".join(x) for x in parts] + [prose(290, 150), None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    want = texts[:2] + [a + b for a, _, b in parts[2:]] + [texts[4], ""]
    got = queries.op2_suffix_array_dedup(spark, str(tmp_path)).orderBy("doc_id").collect()
    sizes = [len((t or "").encode()) for t in texts]
    assert [tuple(r) for r in got] == [(i, n, 400 * (i in (2, 3)), int(i in (2, 3)), hashlib.sha256(t.encode()).hexdigest(), len(t), t) for i, (n, t) in enumerate(zip(sizes, want, strict=True))]
    by_words = {r.doc_id: r.kept for r in substring_dedup.removed_spans(docs, 50, "words", keep_text=True).collect()}
    assert not any(f"{k}00028" in by_words[i] for k in "pq" for i in range(4)) and by_words[4] == texts[4]


def test_quality_keeps_clean_and_drops_toxic(spark):
    rows, labels = [], []
    for i in range(400):
        t = prose(i, 80)
        toxic = i % 4 == 0
        rows.append((i, t.replace(" ", " vileword ", 1) if toxic else t + " ###" * (20 if i % 4 == 1 else 0)))
        if i < 300:
            labels.append((i, 0 if i % 4 == 1 else 1, int(toxic)))
    docs, marks = spark.createDataFrame([*rows, (900, None), (None, "x")], "doc_id long, text string"), spark.createDataFrame([*labels, (None, 1, 0), (5, None, None)], "doc_id long, quality int, toxic int")
    model = quality.fit_on_labels(docs, marks, quality.safe_grade(), 3)
    assert (np.diff(model.thresholds) > 0).all()
    got = {r.doc_id: r for r in quality.graded(docs, model, 2).collect()}
    assert len(got) == 402
    for i in range(300, 400):  # held out
        assert got[i].keep == (i % 4 in (2, 3)), i
        assert 0 <= got[i].p_tail <= 1 and 0 <= got[i].expected_grade <= 2
    assert quality.fit_on_labels(docs, marks.where("false"), quality.safe_grade(), 3) is None
    assert all(r.keep for r in quality.graded(docs, None, 2).collect())


def test_plan_is_tight():
    r = np.random.default_rng(3)
    for size, most in ((500, 2048), (300, 100), (40, 2048), (0, 5)):
        n = np.bincount(r.integers(1, most + 1, size), minlength=2049)
        made = packing.plan(n, 2048)
        used = Counter()
        for many, content in made:
            assert sum(k * t for k, t in content) <= 2048
            for k, t in content:
                used[k] += many * t
        assert used == Counter({i: int(c) for i, c in enumerate(n) if c})
        total, bins = int((n * np.arange(2049)).sum()), sum(m for m, _ in made)
        assert bins <= max(-(-total // 2048), int(n[1025:].sum())) * 11 // 9 + 1


def ids_of(text, end):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(queries.tokenizer_path())
    return np.array([*t.encode(text or "", add_special_tokens=False).ids, end], dtype="<u4")


def test_packing_odd(odd):
    got = packing.packed_sequences(odd, queries.tokenizer_path(), 2048, 0).collect()
    want = Counter()
    for i, t, _ in odd_rows():
        ids = ids_of(t, 0)
        for p, s in enumerate(range(0, len(ids), 2048)):
            want[(i, p, s, len(ids[s : s + 2048]), zlib.crc32(ids[s : s + 2048].tobytes()))] += 1
    assert Counter(tuple(r)[:5] for r in got) == want
    places = defaultdict(list)
    for r in got:
        places[r.sequence_id].append((r.offset, r.length))
    for x in places.values():
        x.sort()
        assert [o for o, _ in x] == list(np.cumsum([0] + [n for _, n in x])[:-1]) and sum(n for _, n in x) <= 2048


def test_token_store_odd(spark, odd, tmp_path):
    path = f"file://{tmp_path}/store"
    token_store.write_store(odd, path, queries.tokenizer_path(), 2)
    got = sorted(token_store.read_store(spark, path).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted((i for i, _, _ in odd_rows()), key=lambda i: (i is not None, i))
    assert [r.start for r in got] == list(np.cumsum([0] + [r.n_tokens for r in got])[:-1])
    assert Counter((r.doc_id, bytes(r.ids)) for r in got) == Counter((i, ids_of(t, 2).tobytes()) for i, t, _ in odd_rows())
    chunks = spark.read.parquet(f"{path}/objects/kind=chunk")
    assert chunks.count() == chunks.select("address").distinct().count()


def test_token_store_notices_damage(spark, tmp_path):
    path = f"file://{tmp_path}/store"
    token_store.write_store(spark.createDataFrame([(1, "a few words"), (2, "other words")], "doc_id long, text string"), path, queries.tokenizer_path(), 2)
    good = spark.read.parquet(f"{path}/objects/kind=chunk").withColumn("payload", F.first("payload").over(__import__("pyspark").sql.Window.orderBy(F.lit(1))))
    good.write.parquet(f"file://{tmp_path}/bad")
    spark.read.parquet(f"file://{tmp_path}/bad").write.mode("overwrite").parquet(f"{path}/objects/kind=chunk")
    with pytest.raises(Exception, match="differs"):
        token_store.read_store(spark, path).collect()


def test_chunks_are_content_defined():
    r = np.random.default_rng(0)
    a = r.integers(0, 50_000, 20_000)
    b = np.concatenate([r.integers(0, 50_000, 333), a])
    cut = lambda x: {x[s:e].tobytes() for s, e in zip([0, *token_store.chunk_ends(x)], token_store.chunk_ends(x), strict=False)}
    assert token_store.chunk_ends(a)[-1] == len(a) and len(cut(a) & cut(b)) > 0.8 * len(cut(a))
    assert token_store.chunk_ends(a[:0]) == [] and token_store.chunk_ends(np.zeros(9000, int))[-1] == 9000


def test_mixing_odd(odd):
    got = mixing.mix_sources(odd, [3, 1, 2], 1.5, 2.0).collect()
    rows = odd_rows()
    assert Counter((r.doc_id, r.size) for r in got) == Counter((i, len(WORD.findall(t or ""))) for i, t, _ in rows)
    for s in {r[2] for r in rows}:
        own = [r for r in got if r.source == s]
        assert sum(r.size for r in own) == own[0].source_size and abs(sum(r.taken for r in own) - own[0].target) <= 1
        assert all(0 <= r.taken <= 2 * r.size for r in own) and own[0].target <= 2 * own[0].source_size
    again = mixing.mix_sources(odd.repartition(7), [3, 1, 2], 1.5, 2.0).collect()
    assert Counter(tuple(r) for r in got) == Counter(tuple(r) for r in again)


def test_targets():
    t = mixing.targets({"a": 100, "b": 100, None: 10}, [3, 1, 2], 1.5, 2.0)
    assert t["a"] == 200 and t[None] == 20 and abs(sum(t.values()) - 315) < 1e-9
    assert mixing.targets({}, [3, 1, 2], 1.5, 2.0) == {} and mixing.targets({"a": 0}, [1], 1.5, 2.0) == {"a": 0}


def test_order_minhash_odd(odd):
    rows = sorted(((i, t or "") for i, t, _ in odd_rows()), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode()))
    want = []
    for (i, t), (_, n) in zip(rows, [*rows[1:], rows[0]], strict=True):
        e = t[: len(t) - len(t) // 2] + n[: len(t) // 2]
        a, b, c = (order_minhash.sketch(x.encode()) for x in (t, e, n))
        want.append((i, len(t), hashlib.sha256(e.encode()).hexdigest(), a.astype(">u4").tobytes().hex(), b.astype(">u4").tobytes().hex(), float((a == b).mean()), float((a == c).mean())))
    assert Counter(tuple(r) for r in order_minhash.edit_comparison(odd).collect()) == Counter(want)


def test_order_minhash_large_ids(spark):
    """Ids beyond 2**53, which doubles don't hold, lose no document."""
    ids = sorted({int(x) for x in np.random.default_rng(3).integers(-(2**63), 2**63, 398)} | {2**63 - 1, 2**63 - 2})
    rows = [(i, f"text {i}") for i in ids]
    got = {r.doc_id: r.edited_sha256 for r in order_minhash.edit_comparison(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()}
    assert got == {i: hashlib.sha256(order_minhash.edited(t, n).encode()).hexdigest() for (i, t), (_, n) in zip(rows, [*rows[1:], rows[0]], strict=True)}


def test_order_minhash_sees_order():
    a = prose(1, 200).split()
    b = a[100:] + a[:100]
    c = sorted(a)
    x, y, z = (order_minhash.sketch(" ".join(t).encode()) for t in (a, b, c))
    assert order_minhash.likeness(x, x) == 1 and order_minhash.likeness(x, z) < order_minhash.likeness(x, y) < 1
    # a tuple tells one occurrence from two, not two from many of the one k-mer there is
    assert len({order_minhash.sketch(t).tobytes() for t in (b"", b"a", b"aaaaaaaa", b"aaaaaaaaa")}) == 4
    assert (order_minhash.sketch(b"a" * 9) == order_minhash.sketch(b"a" * 5000)).all()


def test_prefix_sums(spark):
    rows = [(g, i, i % 5) for g in ("a", None, "b") for i in range(200)]
    df = spark.createDataFrame(rows, "g string, i long, x long").withColumn("before", F.lit(0).cast("long"))
    got = prefix_sums(df, [F.col("g"), F.col("i")], {"before": F.col("x")}, Scratch(spark, "t"), "p", ["g"]).collect()
    assert {(r.g, r.i): r.before for r in got} == {(g, i): sum(k % 5 for k in range(i)) for g, i, _ in rows}


def test_empty_tables(spark, none):
    empty = lambda df: df.count() == 0
    assert empty(ngram_join.ngram_jaccard_components(none, 4, 85, 100))
    assert all(map(empty, ngram_join.ngram_jaccard_links(none, 4, 85, 100)))
    assert empty(substring_dedup.removed_spans(none, 400))
    assert empty(packing.packed_sequences(none, queries.tokenizer_path()))
    assert empty(order_minhash.edit_comparison(none)) and empty(order_minhash.fingerprints(none))
    assert empty(mixing.mix_sources(none))
    path = Scratch(spark, "t").path("empty")
    token_store.write_store(none, path, queries.tokenizer_path(), 2)
    assert empty(token_store.read_store(spark, path))


def test_word_ids_equal_whole_texts():
    from hypothesis import given, settings
    from hypothesis import strategies as st

    from sparkurate.llm.tokens import word_ids

    ids = word_ids(queries.tokenizer_path())
    assert ids.by_word
    pieces = st.one_of(st.text(max_size=6), st.sampled_from(["Don't", "it's,", "<|endoftext|>", "<|ENDOFTEXT|>", "ΑΣ", "éte", "K", "x—,", "9.5%", "İ", "ﬁ!"]))

    @settings(max_examples=300, deadline=None)
    @given(st.lists(pieces, max_size=8), st.sampled_from([" ", "\n", "\t ", " ", "\x0b"]))
    def check(parts, space):
        text = space.join(parts).encode("utf-8", "ignore").decode()
        assert ids.document(text.encode()) == ids.encode(text.encode()), text

    check()
    assert ids.document(LONG.encode()) == ids.encode(LONG.encode())


def test_full_bins_lose_no_link():
    """A bin of more tokens than it counts says nothing about how many two sets share."""
    many = np.arange(ngram_join.FULL + 5_000, dtype=np.uint64) * np.uint64(ngram_join.BINS)
    h = np.frombuffer(ngram_join.histogram(many), "<u2")[None, :]
    assert ngram_join.most_common(h, h)[0] >= len(many)
    few = np.frombuffer(ngram_join.histogram(many[:100]), "<u2")[None, :]
    assert ngram_join.most_common(h, few)[0] == 100


def test_substring_dedup_tells_rows_without_ids_apart(spark):
    """Texts whose 32-bit hashes are equal, with null ids, or 0 and null: only what occurs again goes."""
    import xxhash

    texts = [{xxhash.xxh32_intdigest(t): t for i in range(200_000) for t in [base + b"%d" % i]} for base in (prose(61, 120).encode()[:600], prose(62, 120).encode()[:600])]
    a, b = next((texts[0][h], texts[1][h]) for h in texts[0] if h in texts[1])
    c = prose(63, 40).encode() + b" " + a[:550]
    for ids in ((None, None, 5), (0, None, None), (0, 0, 0)):
        rows = [(i, t.decode()) for i, t in zip(ids, (a, b, c), strict=True)]
        got = substring_dedup.removed_spans(spark.createDataFrame(rows, "doc_id long, text string"), 400).collect()
        want = [(i, len(t), n) for i, t, n in zip(ids, (a, b, c), (550, 0, 550), strict=True)]
        assert Counter((r.doc_id, r.n_bytes, r.n_removed) for r in got) == Counter(want)


def test_substring_dedup_keeps_columns_with_clashing_names(odd):
    got = substring_dedup.removed_spans(odd.withColumn("n_bytes", F.lit("old")), 60, keep_text=True)
    assert got.columns == ["doc_id", "source", "n_chars", *[c for c in odd.columns[4:]], "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
    assert all(r.tag == r.doc == r.s0 == "x" and r.n_bytes == len((r.kept or "").encode()) + r.n_removed for r in got.collect())


def test_ordinal_model_equals_a_plain_fit():
    """Probabilities of the fit against gradient descent with numeric derivatives on a few dense rows."""
    r = np.random.default_rng(8)
    n, k, first = 60, 3, quality.SIZE - quality.DENSE
    x = r.normal(size=(n, quality.DENSE))
    grades = np.clip((x[:, 0] * 1.5 + r.normal(size=n) > -0.5).astype(int) + (x[:, 1] + r.normal(size=n) > 0.7), 0, 2)
    slots, rows = np.tile(np.arange(quality.DENSE) + first, n), np.repeat(np.arange(n), quality.DENSE)
    model = quality.fit(slots, x.ravel(), rows, grades, k, steps=3000, rate=0.05, ridge=0.01)

    def loss(p):
        cut = np.array([-np.inf, p[0], p[0] + np.exp(p[1]), np.inf])
        s = x @ p[2:]
        below = 1 / (1 + np.exp(s[:, None] - cut[None, :]))
        return -np.log(below[np.arange(n), grades + 1] - below[np.arange(n), grades]).mean() + 0.01 * (p[2:] ** 2).sum() / 2

    p = np.zeros(2 + quality.DENSE)
    for _ in range(4000):
        p -= 0.3 * np.array([(loss(p + e) - loss(p - e)) / 2e-5 for e in np.eye(len(p)) * 1e-5])
    plain = 1 - 1 / (1 + np.exp((x @ p[2:])[:, None] - np.array([p[0], p[0] + np.exp(p[1])])[None, :]))
    assert np.abs(model.tails(x @ model.weights[first:]) - plain).max() < 0.01


def test_quality_fits_one_document_of_an_id(spark):
    docs = spark.createDataFrame([(i % 40, prose(i, 30) + (" vileword" if i % 40 % 2 else "")) for i in range(400)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(40)], "doc_id long, quality int, toxic int")
    one, two = (quality.fit_on_labels(d, labels, quality.safe_grade(), 3, sample=30) for d in (docs, docs.repartition(5)))
    assert (one.weights == two.weights).all() and (one.thresholds == two.thresholds).all()
    assert quality.graded(docs.where("false"), one, 2).count() == 0


def test_sketch_by_definition():
    """Of each bin the least numbered k-mers, in text order, in plain Python."""
    import xxhash

    from sparkurate.llm.common import mix

    one = lambda x: int(mix(np.array([x % 2**64], np.uint64))[0])

    def plain(text, sketches=64, size=2):
        k = order_minhash.K
        parts = [int.from_bytes(text[i : i + k], "little") + 1 for i in range(len(text) - k + 1)]
        kmers = [one(p) for p in parts] or [xxhash.xxh3_64_intdigest(text)]
        seen, marks = Counter(), []
        for x in kmers:
            marks.append(one(x + seen[x] * 0x9E3779B97F4A7C15))
            seen[x] += 1
        order = sorted(range(len(marks)), key=marks.__getitem__)
        out = []
        for b in range(sketches):
            start = next((j for j, i in enumerate(order) if marks[i] >> 58 >= b), len(order))
            chosen = sorted(order[(start + j) % len(order)] for j in range(min(size, len(order))))
            h = min(size, len(order))
            for i in chosen:
                h = one(h * 0x9E3779B97F4A7C15 + kmers[i])
            out.append(h >> 32)
        return out

    for text in (b"", b"abc", b"abcdefgh", b"ab" * 40, prose(3, 40).encode(), prose(4, 2000).encode()):
        assert order_minhash.sketch(text).tolist() == plain(text), text[:20]


def test_mixing_targets_by_hand(odd):
    """Targets of the sources a, b, c and null at weights 3, 1, 2 and 3, by sharing out what is above twice a source's size."""
    size = Counter()
    for _, t, s in odd_rows():
        size[s] += len(WORD.findall(t or ""))
    weight, left, target = dict(zip(["a", "b", "c", None], [3, 1, 2, 3], strict=True)), 1.5 * sum(size.values()), {}
    while weight:
        share = {s: left * w / sum(weight.values()) for s, w in weight.items()}
        over = [s for s in share if share[s] > 2 * size[s]]
        for s in over or list(share):
            target[s] = 2.0 * size[s] if over else share[s]
            left -= target[s] if over else 0
            del weight[s]
    got = {r.source: r.target for r in mixing.mix_sources(odd, [3, 1, 2], 1.5, 2.0).select("source", "target").distinct().collect()}
    assert got.keys() == target.keys() and all(abs(got[s] - target[s]) < 1e-6 for s in got)


def test_scratch_needs_a_shared_folder_on_a_cluster():
    from types import SimpleNamespace

    conf = SimpleNamespace(get=lambda k, d=None: None if k == "spark.checkpoint.dir" else "1m", set=lambda k, v: None)
    with pytest.raises(ValueError):
        Scratch(SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(environment={}, master="spark://host:7077")), "t")
