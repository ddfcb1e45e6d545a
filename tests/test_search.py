"""Best matches by index against plain versions over all pairs: bags, typed queries, patterns, batches."""

import random
from collections import Counter

import pytest

from sparkurate.operators import formulas, lists, matching


def nearest(left, right, least, others):
    out = {}
    for g, a in left.items():
        found = []
        for h, b in right.items():
            x, y = (Counter(v for v in z if v is not None) for z in (a, b))
            common = sum((x & y).values())
            score = common / max(len(a), len(b)) if common else 0
            if common and score >= least and not (others and g == h):
                found.append((-score, h))
        if found:
            out[g] = (min(found)[1], round(-min(found)[0], 9))
    return out


@pytest.mark.parametrize(("seed", "least", "rounds"), [(1, 0.0, (0.5,)), (2, 0.3, (0.8, 0.5)), (3, 0.0, ()), (4, 0.0, (0.5, 0.2))])
def test_nearest_bags_against_all_pairs(spark, seed, least, rounds):
    r = random.Random(seed)
    entry = lambda: 1 if r.random() < 0.3 else None if r.random() < 0.05 else r.randrange(2, 40)  # noqa: E731  one entry is in most bags
    bags = {g: [entry() for _ in range(r.choice([1, 2, 3, 5, 8, 14]))] for g in range(70)}
    bags |= {70: list(bags[3]), 71: list(bags[3]), 72: [None], 73: [1, 1, 1], 74: [1]}
    rows = lambda x, name: spark.createDataFrame([(g, v) for g, b in x.items() for v in b], f"{name} int, v int")
    got = {x["g"]: (x["h"], round(x["similarity"], 9)) for x in formulas.nearest_bags(rows(bags, "g"), None, ("g", "h"), "v", least, rounds).collect()}
    assert got == nearest(bags, bags, least, others=True)
    other = {g + 5: [entry() for _ in range(r.choice([1, 4, 9]))] for g in range(40)}
    got = {x["g"]: (x["h"], round(x["similarity"], 9)) for x in formulas.nearest_bags(rows(other, "g"), rows(bags, "h"), ("g", "h"), "v", least, rounds).collect()}
    assert got == nearest(other, bags, least, others=False)


def test_nearest_bags_of_empty_tables_and_rows_without_group(spark):
    none = spark.createDataFrame([], "g int, v int")
    some = spark.createDataFrame([(None, 1), (1, 1), (1, 1)], "h int, v int")
    assert formulas.nearest_bags(none, some, ("g", "h"), "v").count() == 0
    assert formulas.nearest_bags(some.withColumnRenamed("h", "g"), some, ("g", "h"), "v").collect() == [(1, 1, 1.0)]


def plain_score(q, c):
    if not q or not c:
        return None
    if q == c:
        return 1.0
    if c.startswith(q):
        return 0.95
    if q in c:
        return 0.9
    at, places = 0, []
    for x in q:
        i = c.find(x, at)
        if i < 0:
            return None
        places.append(i)
        at = i + 1
    edge = places[0] == 0 or c[places[0] - 1] == " "
    return min(0.89, 0.45 + len(q) / (places[-1] - places[0] + 1) * 0.25 + len(q) / len(c) * 0.1 + (0.08 if edge else 0))


def test_rank_matches_against_all_names(spark):
    r = random.Random(5)
    word = lambda: "".join(r.choice("aaabcde2") for _ in range(r.randrange(1, 9)))
    names = {i: " ".join(word() for _ in range(r.randrange(1, 4))) for i in range(120)} | {200: "", 201: "!?", 202: "ab" * 30_000, 203: "aab cab", 204: "aab cab"}
    queries = ["a", "aa", "ac", "a c", "ba2", "eeee", "zz", "", " ", "d b", names[7], names[9][1:]] + [word() for _ in range(20)]
    catalog = spark.createDataFrame([*names.items(), (300, None)], "id int, name string")
    typed = spark.createDataFrame([(q,) for q in [*queries, None]], "q string")
    got = {(x["query"], x["rank"]): (x["id"], round(x["confidence"], 9)) for x in matching.rank_matches(catalog, typed, 5).collect()}
    want = {}
    for q in set(queries):
        scored = [(-round(s, 9), n, i) for i, n in names.items() if (s := plain_score(q.strip(), n)) is not None and n != "!?"]
        want |= {(q, k): (i, -s) for k, (s, _, i) in enumerate(sorted(scored)[:5], 1)}
    assert got == want

PATTERNS = ["utm_|ref=", "a{2,}b+c", "x?yz", "^$", "[0-9]{3}", "(foo|bar)baz", "foo(?=bar)", "f\\.o|o\\+", "(?i)ABC", "qu+?x*z", "a.c$", "\\bcab\\b", "\\p{L}9", "\\x41b", "(a)\\1c", "caf\u00e9s", "[\\]a]bc", "((a(b))c)d", "\\Qa.b\\E", "B|", "[a-c&&[^b]]z", "a*+b", "z\\?y"]


def test_patterns_by_literals_against_every_token(spark):
    r = random.Random(6)
    tokens = ["", "utm_x", "REF=1", "aabbc", "abc", "yz", "123", "a12", "barBAZ", "foobar", "f.o", "o+", "quuxxz", "a-c", "cab", "x cab y", "\u00e99", "Ab", "aac", "CAF\u00c9S", "caf\u00e9s", "abcd", "a.b", "cz", "]bc", "a" * 20_000 + "ab", "z?y", "\u0130bc\u212a"]
    tokens += ["".join(r.choice("abcfoxyz 9.") for _ in range(r.randrange(1, 12))) for _ in range(150)]
    rows = spark.createDataFrame([(t,) for t in [*set(tokens), None]], "token string")
    patterns = spark.createDataFrame([(p,) for p in [*PATTERNS, None]], "pattern string")
    literals = {x["pattern"]: x["l"] for x in patterns.where("pattern is not null").select("pattern", lists.required_literals(patterns["pattern"]).alias("l")).collect()}
    assert literals["utm_|ref="] == ["utm_", "ref="] and literals["x?yz"] == ["yz"] and literals["qu+?x*z"] == ["qu"] and literals["(foo|bar)baz"] == ["baz"]
    assert all(literals[p] is None for p in ("^$", "[0-9]{3}", "\\x41b", "(a)\\1c", "\\Qa.b\\E", "B|", "[a-c&&[^b]]z"))
    got = sorted((x["token"], x["pattern"]) for x in lists.pattern_hits(rows, "token", patterns).collect())
    want = rows.join(patterns, how="cross").where("token rlike concat('(?i)', pattern)")
    assert got == sorted((x["token"], x["pattern"]) for x in want.collect()) and len(got) > 100


def test_pattern_purge_keeps_what_no_pattern_finds(spark):
    rows = spark.createDataFrame([(1, "call 555"), (2, "aqua"), (3, None), (4, "aqua"), (5, "AQUA call")], "n int, token string")
    patterns = spark.createDataFrame([("call", "b"), ("call", "a"), ("[0-9]+", "c"), (None, "d")], "pattern string, reason string")
    left, found = lists.pattern_purge(rows.select("token"), "token", patterns)
    assert sorted(x["token"] or "" for x in left.collect()) == ["", "aqua", "aqua"]
    assert sorted(tuple(x) for x in found.collect()) == [("a", "delete", "AQUA call", 1), ("a", "delete", "call 555", 1)]
    none = spark.createDataFrame([], "pattern string, reason string")
    assert lists.pattern_purge(rows.select("token"), "token", none)[0].count() == 5


def plain_batches(sizes, most_rows, most_bytes):
    out, count, total = [], 0, 0
    for n in sizes:
        n = n or 0
        if count and (count >= most_rows or total + n > most_bytes):
            count, total, out = 0, 0, [*out, (out[-1] if out else 0) + 1]
        else:
            out.append(out[-1] if out else 0)
        count, total = count + 1, total + n
    return out


@pytest.mark.parametrize(("most_rows", "most_bytes"), [(1, 5), (3, 10), (7, 40), (50, 1000), (4, 0)])
def test_batches_by_pointers_against_a_fold(spark, most_rows, most_bytes):
    r = random.Random(most_rows)
    groups = {"a": 400, "b": 1, None: 30, "c": most_rows, "zeros": 60}
    rows = [(g, i // 2, 0 if g == "zeros" else r.choice([0, 1, 2, 3, 5, 9, 30, None])) for g, n in groups.items() for i in range(n)]
    df = spark.createDataFrame(rows, "g string, i int, n long").repartition(5)
    got = sorted(((x["g"], x["i"], x["n"], x["batch"]) for x in lists.fill_groups(df, ["i"], "n", most_rows, most_bytes, "g").collect()), key=str)
    want = []
    for g in groups:
        own = sorted((i, -1 if n is None else n) for h, i, n in rows if h == g)
        sizes = [None if n < 0 else n for _, n in own]
        want += [(g, i, n, b) for (i, _), n, b in zip(own, sizes, plain_batches(sizes, most_rows, most_bytes), strict=True)]
    assert got == sorted(want, key=str)
    assert lists.fill_groups(df.where("false"), ["i"], "n", most_rows, most_bytes, "g").count() == 0
