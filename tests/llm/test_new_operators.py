"""Clustering, collocations and decontamination against plain versions."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkurate.llm import collocations, decontamination, sort_means

from .conftest import LONG, odd_rows, prose

# --------------------------------------------------------------------------- sort-means


def first():
    return F.sha2(F.concat(F.lit("2:"), F.col("vec_id").cast("string")), 256)


def plain_means(rows, k, rounds):
    """((id, vector, cluster, distance), centroids) by looking at every centroid."""
    digest = lambda i: hashlib.sha256(f"2:{i}".encode()).hexdigest()
    centers = [list(v) for _, v in sorted((digest(i), v) for i, v in rows if i is not None)[:k]]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), j) for j, c in enumerate(centers))
    for _ in range(rounds):
        own = defaultdict(list)
        for _, v in rows:
            own[near(v)[1]].append(v)
        centers = [[sum(x) // len(own[j]) for x in zip(*own[j], strict=True)] if own[j] else c for j, c in enumerate(centers)]
    return [(i, v, near(v)[1], near(v)[0]) for i, v in rows], centers


def vector_rows(dim, n, seed):
    r = random.Random(seed)
    return [(i, [r.choice([-1, 1]) * r.randrange(6) / 256 + 0.001 for _ in range(dim)]) for i in range(n)]


@pytest.mark.parametrize("dim,k,seed", [(2, 9, 1), (3, 7, 2), (5, 40, 3)])
def test_sort_means(spark, dim, k, seed):
    """Small integers in few dimensions: many ties, repeated vectors, centroids that lose all theirs."""
    rows = vector_rows(dim, 150, seed) + [(3, [0.0] * dim), (None, [0.01] * dim), (7, None), (8, []), (9, [1.0] * (dim + 1)), (10, [math.nan] + [0.0] * (dim - 1)), (11, [math.inf] * dim), (12, [None] + [0.0] * (dim - 1))]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<double>, v string, cluster int").repartition(3)
    whole = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if v and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]
    want, want_centers = plain_means(whole, k, 3)
    got, centers = sort_means.sort_means(sort_means.integer_vectors(df, dim), first(), k=k, rounds=3)
    assert centers == want_centers
    assert Counter((r.vec_id, tuple(r.v), r.cluster, r.distance) for r in got.collect()) == Counter((i, tuple(v), c, d) for i, v, c, d in want)
    out = sort_means.with_inertia(got, centers).collect()
    assert {r.inertia for r in out} == {sum(d for *_, d in want)}
    for r in out:
        assert r.cluster_inertia == sum(d for _, _, c, d in want if c == r.cluster)
        assert r.centroid_sha256 == hashlib.sha256(",".join(map(str, want_centers[r.cluster])).encode()).hexdigest()


def test_sort_means_stops_early_and_none_is_lost():
    r = np.random.default_rng(4)
    x = np.concatenate([r.integers(-9, 9, (300, 8)) + c for c in r.integers(-900, 900, (12, 8))])
    c = sort_means.Centers([[int(y) for y in row] for row in x[::300]])
    before = np.repeat(np.arange(12), 300)
    at, best, computed = c.nearest(x, before)
    full = ((x[:, None] - c.c[None]) ** 2).sum(2)
    assert (at == full.argmin(1)).all() and (best == full.min(1)).all()
    assert computed < 2 * len(x)
    assert (c.nearest(x, np.zeros(len(x), int))[0] == at).all()


def test_sort_means_wide_numbers():
    """Products that pass 64 bits are exact, too."""
    c = sort_means.Centers([[10**12, 0], [0, 10**12]])
    at, best, _ = c.nearest(np.array([[1, 2], [2, 1], [5, 5]]), np.array([1, 1, 1]))
    assert at.tolist() == [1, 0, 0] and best.tolist() == [(10**12 - 2) ** 2 + 1, (10**12 - 2) ** 2 + 1, (10**12 - 5) ** 2 + 25]


def test_sort_means_empty(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    got, centers = sort_means.sort_means(sort_means.integer_vectors(df), first())
    assert centers == [] and sort_means.with_inertia(got, centers).collect() == []
    df = spark.createDataFrame([(None, [0.5] * 64)], "vec_id long, embedding array<float>")
    (row,) = sort_means.with_inertia(*sort_means.sort_means(sort_means.integer_vectors(df), first())).collect()
    assert (row.vec_id, row.cluster, row.distance, row.inertia) == (None, None, None, None)


# --------------------------------------------------------------------------- collocations


def lower(text):
    return "".join(c.lower() if c.isascii() else c for c in text or "")


def plain_collocations(rows, max_n, least, top, covered):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", lower(text)):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            f.update((lang, tuple(w[i : i + m])) for m in range(1, max_n + 1) for i in range(len(w) - m + 1))
    out = defaultdict(list)
    longer = Counter()
    for (lang, q), b in f.items():
        for s in range(len(q)):
            for e in range(s + 2, len(q) + (s > 0)):
                longer[lang, q[s:e]] = max(longer[lang, q[s:e]], b)
    for (lang, p), a in f.items():
        if len(p) < 2 or a < least:
            continue
        if longer[lang, p] >= least and 100 * longer[lang, p] >= covered * a:
            continue
        score, _, l, r = min(((2_000_000 * a) // (f[lang, p[:k]] + f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p)))
        out[lang].append((-score, -a, " ".join(p).encode(), l, r))
    return {(lang, i + 1, p.decode(), -a, l, r, n[lang], -s) for lang, rows in out.items() for i, (s, a, p, l, r) in enumerate(sorted(rows)[:top])}


def phrase_rows():
    r = random.Random(9)
    vocabulary = ["stone", "River", "es", "en", "été", "x-y", "a", "A", "\x01b", "日本"]
    rows = []
    for i in range(160):
        text = " ".join(r.choice(vocabulary) + r.choice(["", "", "", ",", "\t", ".", "\r\n"]) for _ in range(r.randrange(40)))
        rows.append((r.choice(["en", "es", None, "und", ""]), text + " hot pair here now" * (i % 3)))
    return rows + [(None, None), ("en", ""), ("en", " .\n "), ("es", LONG), ("de", "one two " * 400)] + [(s, t) for _, t, s, *_ in odd_rows()]


@pytest.mark.parametrize("max_n,least,top,bits", [(4, 4, 25, 20), (3, 2, 10**6, 17), (4, 300, 50, 17), (2, 3, 40, 20)])
def test_collocations(spark, max_n, least, top, bits):
    rows = phrase_rows()
    df = spark.createDataFrame([(*r, "n", 1.0) for r in rows], "lang string, text string, phrase string, k0 double").repartition(5)
    got = collocations.collocations(df, max_n=max_n, least=least, top=top, covered=80, bits=bits).collect()
    assert {tuple(r) for r in got} == plain_collocations(rows, max_n, least, top, 80)
    assert len({tuple(r) for r in got}) == len(got)


def test_collocations_full_counters_and_slices(spark, monkeypatch):
    """Counters that rule nothing out, slices and strides of a few words: the same phrases."""
    rows = phrase_rows()
    df = spark.createDataFrame(rows, "lang string, text string")
    monkeypatch.setattr(collocations, "_frequent_pairs", lambda seen, bits, least: np.full((1 << bits) // 8, 255, np.uint8))
    got = collocations.collocations(df, least=4, top=100, bits=17).collect()
    assert {tuple(r) for r in got} == plain_collocations(rows, 4, 4, 100, 80)
    text = b"one two, three " * 50
    parts = list(collocations.slices(text, 40))
    assert len(parts) > 10 and b"".join(parts) == text and b" ".join(p.strip() for p in parts).split() == text.split()


def test_prefix_counts_over_ranges(spark):
    """One pair with nearly all suffixes is in many ranges, and a prefix over two ranges is counted once."""
    r = random.Random(2)
    rows = [(5, 6, r.randrange(1, 9), r.randrange(9), r.randrange(1, 4)) for _ in range(3000)] + [(r.randrange(1, 4), 7, 0, 0, 1) for _ in range(50)]
    rows = [(a, b, c, d if c else 0, n) for a, b, c, d, n in rows]
    df = spark.createDataFrame(rows, "k0 long, k1 long, k2 long, k3 long, n long")
    want = Counter()
    for *k, n in rows:
        for m in range(2, 5):
            if k[m - 1]:
                want[(*k[:m], *[0] * (4 - m))] += n
    for least in (1, 60):
        got = {tuple(x)[:4]: x.f for x in collocations.prefix_counts(df, 4, least).collect()}
        assert got == {k: n for k, n in want.items() if n >= least}


def test_collocations_empty(spark):
    assert collocations.collocations(spark.createDataFrame([], "lang string, text string")).collect() == []


# --------------------------------------------------------------------------- decontamination


def tokens(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower(text))


def plain_hits(text, items, window):
    w, hit, found = tokens(text), set(), set()
    for i, t in items:
        v = tokens(t)
        k = min(window, len(v))
        windows = {tuple(v[s : s + k]) for s in range(len(v) - k + 1)} if v else ()
        for p in range(len(w) - k + 1) if v else ():
            if tuple(w[p : p + k]) in windows:
                hit |= set(range(p, p + k))
                found |= {str(i)} if i is not None else set()
    return len(w), hit, sorted(found)


def item_rows():
    shared = prose(1, 120)
    return [(2, shared), (10, prose(2, 12)), (3, "w5x5! w6x6-w7x7"), (4, None), (5, ""), (6, "... --"), (7, "ONE"), (7, "ab ab ab ab ab ab ab ab ab ab ab"), (8, prose(77, 40)), (None, prose(5, 25)), (9, prose(2, 12)), (11, "a b c d")]


@pytest.mark.parametrize("window,block", [(10, 1 << 20), (10, 300), (3, 1 << 20), (7, 500)])
def test_contamination(spark, odd, window, block):
    items = item_rows()
    df = spark.createDataFrame([(*i, "x") for i in items], "item_id long, text string, doc_id string")
    want = Counter((i, *(lambda h: (h[0], tuple(sorted(h[1])), tuple(h[2])))(plain_hits(t, items, window))) for i, t, *_ in odd_rows())
    rows = decontamination.contamination(odd, df, window, block=block)
    assert rows.columns[: len(odd.columns)] == odd.columns and rows.columns[len(odd.columns) :] == list(decontamination.HITS)
    got = rows.collect()
    assert Counter((r.doc_id, r.n_words, tuple(x for s in r.spans for x in range(s.start, s.end)), tuple(r["items"])) for r in got) == want
    clean = decontamination.decontaminated(odd, df, window, block=block).collect()
    assert Counter(r.doc_id for r in clean) == Counter(k[0] for k in want.elements() if not k[2])
    assert Counter(r.text for r in clean) == Counter(r.text for r in got if not r.spans)


def test_contamination_empty(spark, odd, none):
    items = spark.createDataFrame(item_rows(), "item_id long, text string")
    assert decontamination.contamination(none, items).collect() == []
    got = decontamination.contamination(odd, items.where("false")).collect()
    assert len(got) == len(odd_rows()) and not any(r.spans or r["items"] for r in got)


def test_suffix_arrays():
    """Suffixes are in order, and every occurrence is found, over shards of a few words, too."""
    r = random.Random(3)
    text = " ".join(r.choice("abc") for _ in range(400)).encode()
    items = [("1", b"a b a c"), ("2", b"c c c c c c"), ("3", b"b"), ("4", text[100:140])]
    w = decontamination.Windows(items, 4)
    x = decontamination.words(text)
    s = decontamination.SuffixArray(x, w.width)
    upper = lambda i: tuple(int(y) >> 32 for y in s.x[i : i + w.width])
    keys = [upper(i) for i in s.order]
    assert keys == sorted(keys) and sorted(s.order) == list(range(len(x)))
    names = text.split()
    want = {(p, tuple(g)) for _, t in items for v in [t.split()] for k in [min(4, len(v))] for g in [v[i : i + k] for i in range(len(v) - k + 1)] for p in range(len(names) - k + 1) if names[p : p + k] == g}
    for size in (1 << 20, 50, 7):
        got = set()
        for part, row, place in decontamination._shards([x], 4, size):
            at, which = decontamination.SuffixArray(part, w.width).places(w)
            got |= {(p, tuple(names[p : p + w.length[q]])) for p, q in zip(place[at].tolist(), which, strict=True)}
            assert not row.any()
        assert got == want


@pytest.mark.parametrize("block", [1 << 20, 400])
def test_longest_matches(spark, odd, block):
    items, window = item_rows(), 5
    want = {}
    docs = [(i, tokens(t)) for i, t, *_ in odd_rows()]
    for name, text in items:
        v = tokens(text)
        k = min(window, len(v))
        for s in range(len(v)):
            for i, w in docs:
                for p in [p for p, x in enumerate(w) if x == v[s]]:
                    n = 0
                    while s + n < len(v) and p + n < len(w) and v[s + n] == w[p + n]:
                        n += 1
                    if n and n >= k:
                        key = (None if name is None else str(name), s)
                        row = (-n, i is None, i or 0, p)
                        want[key] = min(want.get(key, row), row)
    got = decontamination.longest_matches(odd, spark.createDataFrame(items, "item_id long, text string"), window, block=block).collect()
    assert {(r.item_id, r.start): (-r.n_words, r.doc_id is None, r.doc_id or 0, r.place) for r in got} == want
