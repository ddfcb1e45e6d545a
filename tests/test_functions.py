"""Literal cases of names, labels and similarities."""

import random

import pytest
from pyspark.sql import functions as F

from sparkurate.functions import similarity as sim
from sparkurate.functions import text as tx
from sparkurate.functions import web
from sparkurate.functions.labels import list_section, tokenize_label, tokenize_labels

from .plain_labels import Tokenizer


@pytest.fixture(scope="module")
def one(spark):
    def values(*columns):
        return tuple(spark.range(1).select(*[c.alias(f"c{i}") for i, c in enumerate(columns)]).first())

    return values


L = F.lit


def test_names(one):
    cases = {"Salicylic-Acid (USP)": "salicylicacid usp", "Tocophérol": "tocopherol", "  Aloe   Barbadensis  ": "aloe barbadensis", "Beurre de Karité": "beurre de karite", "Parfum / Fragrance": "parfum fragrance", "D-Panthenol": "dpanthenol", " /:% ": "", "  Água / WATER™  ": "agua watertm"}
    assert one(*[tx.normalize_name(L(k)) for k in cases]) == tuple(cases.values())
    assert one(tx.inci_normalize(L(None).cast("string")), tx.normalize_name(L(None).cast("string"))) == (None, "")
    assert one(tx.inci_normalize(L("Straße œuf"), transliterate=True)) == ("strasse oeuf",)
    assert one(tx.slug(L("Beta-Hydroxy Acid (BHA)")), tx.brand_key(L("  CeraVe   ")), tx.brand_key(L(None).cast("string"))) == ("beta-hydroxy-acid-bha", "CERAVE", "")
    assert one(tx.first_brand(L(" ; The Lab, Other")), tx.diff_key(L("Água 5 A")), tx.title_case(L("PEG-40 CASTOR/OIL"))) == ("The Lab", "gua5a", "Peg-40 Castor/Oil")


def test_sql_function(spark):
    tx.register_sql_functions(spark)
    assert spark.sql("SELECT inci_normalize('Tocophérol  (X)')").first()[0] == "tocopherol x"


def test_fingerprints(one):
    f = lambda *t: tx.fingerprint(F.array(*map(L, t)))
    a, b, c, d = one(f("Aqua", "Glycerin"), f("Glycerin", "Aqua"), f(" aqua ", "GLYCERIN"), f("Aqua", "", "Glycerin"))
    assert a != b and a == c == d


def test_unique_slugs(spark):
    rows = spark.createDataFrame([(1, "A b"), (2, "a-b"), (3, "c")], "i int, name string")
    got = {r.i: r.slug for r in tx.unique_slugs(rows, "name", ["i"]).collect()}
    assert got[1] == "a-b" and got[2].startswith("a-b-") and len(got[2]) == 10 and got[3] == "c"


def test_alternatives_and_renames(one):
    assert "water" in one(tx.overlap_alternatives(L("Water (Aqua/Eau)")))[0]
    got = set(one(tx.overlap_alternatives(L("Shea (Butyrospermum/Parkii) Butter")))[0])
    assert {"butyrospermum", "parkii", "shea butter"} <= got
    assert one(tx.is_rename(L("Cream"), L("CeraVe Cream™"), L("CeraVe")), tx.is_rename(L("Cream"), L("Night Cream"), L("x")), tx.is_rename(L("Rich Night Cream"), L("Night Cream"), L("x")), tx.is_rename(L("Cream"), L(""), L("x"))) == (False, True, False, False)


def test_similarities(one):
    a, b = L("salycilic acid"), L("salicylic acid")
    assert tuple(round(x, 4) for x in one(F.levenshtein(a, b), sim.trgm_dice(a, b), sim.trgm_jaccard(a, b))) == (2, 0.6897, 0.5263)
    assert round(one(sim.token_jaccard(L("sodium hyaluronate"), L("hydrolyzed sodium hyaluronate")))[0], 4) == 0.6667
    assert one(sim.trgm_dice(L(""), L("")), sim.trgm_dice(L("a"), L("")), sim.token_jaccard(L(""), L(""))) == (1.0, 0.0, 1.0)
    assert one(*[sim.confidence_bucket(L(x)) for x in (0.92, 0.9199, 0.80, 0.7999)]) == ("keep", "review", "review", "reject")
    assert one(sim.modifiers_differ(L("sodium x"), L("x")), sim.modifiers_differ(L("seed oil"), L("oil seed"))) == (True, False)


def test_spelling_merge(one):
    m = lambda s, t, k, d, o, g: sim.is_spelling_merge(L(s), L(t), L(k), L(d), L(o), L(g).cast("double"))
    cases = [(("salycilic acid", "salicylic acid", 0.94, 2, 0.3, 0.2), True), (("salycilic acid", "salicylic acid", 0.94, 2, 0.3, 0.04), False), (("salycilic acid", "salicylic acid", 0.94, 2, 0.3, None), True), (("sodium x", "x", 1.0, 0, 1.0, 1.0), False), (("aqus", "aqua", 0.79, 1, 0.0, 1.0), False), (("a" * 25, "b" * 25, 0.9, 1, 0.5, 1.0), False)]
    assert one(*[m(*c) for c, _ in cases]) == tuple(w for _, w in cases)


def test_search_score(one):
    s = lambda q, c: sim.search_score(L(q), L(c))
    exact, prefix, within, loose, none, empty = one(s("water", "Water"), s("wat", "water"), s("ate", "water"), s("watr", "water"), s("water", "candelilla wax"), s("", "x"))
    assert (exact, prefix, within, none, empty) == (1.0, 0.95, 0.9, None, None) and 0.7 < loose <= 0.89
    assert abs(loose - min(0.89, 0.45 + 4 / 5 * 0.25 + 4 / 5 * 0.1 + 0.08)) < 1e-9


V1 = [
    ("Ingredients: Aqua, Glycerin, may contain CI 77891", (), ["Aqua", "Glycerin"]),
    ("AQUA/WATER/EAU GLYCERIN BUTYLENE GLYCOL", (), ["AQUA/WATER/EAU", "GLYCERIN", "BUTYLENE GLYCOL"]),
    ("Castor seed, oil", (), ["Castor seed oil"]),
    ("Soybean, seed extract", (), ["Soybean seed extract"]),
    ("Glycerin, water", ("glycerin", "water"), ["Glycerin", "water"]),
    ("Aqua, F, I, L, Glycerin", (), ["Aqua", "Glycerin"]),
    ("LOT 31689A", (), []),
    ("Directions: apply daily", (), []),
    ("PEG-40, HYDROGENATED, CASTOR OIL", (), ["PEG-40 HYDROGENATED CASTOR OIL"]),
    ("Aqua (Water), Glycerin", (), ["Aqua", "Water", "Glycerin"]),
    (None, (), []),
    ("", (), []),
]
V2 = [
    ("Water (Aqua, Eau), 1,2-Hexanediol, CI 77891 (Titanium, Dioxide)", (), ["Water (Aqua, Eau)", "1,2-Hexanediol", "CI 77891 (Titanium, Dioxide)"]),
    ("**Active Ingredients:** Avobenzone 3% Inactive Ingredients: Water, Glycerin. Warnings: for external use only", ("avobenzone",), ["Avobenzone", "Water", "Glycerin"]),
    ("• Castor seed • oil", (), ["Castor seed", "oil"]),
    ("Aqua\\Water, Glycerin*", (), ["Aqua/Water", "Glycerin"]),
    ("Usage: daily. Ingredients: Aqua; Niacinamide", (), ["Aqua", "Niacinamide"]),
]


@pytest.mark.parametrize("mode,cases", [("v1", V1), ("v2", V2)])
def test_labels(spark, mode, cases):
    for terms in {t for _, t, _ in cases}:
        own = [(label, want) for label, t, want in cases if t == terms]
        got = spark.createDataFrame([(i, x) for i, (x, _) in enumerate(own)], "i int, l string").select("i", tokenize_label("l", mode, terms).alias("t")).collect()
        assert {r.i: r.t for r in got} == {i: want for i, (_, want) in enumerate(own)}


BITS = ["Aqua", "water", "Seed", "leaf", "seed oil", "fruit extract", "Oil", "C12-15 ALKYL BENZOATE", "1,2-Hexanediol", "(", "(CI 77891, CI 77491)", ")", "SHEA BUTTER", "glycerin", "Inactive Ingredients (shade x): ", "Active ingredients - ", "Ingredients:", "INCI ", "may contain x", "peut contenir: y", "Directions: rub", "°é ñ", "Ácido cítrico 5%", "Zinc 3.5 %", "\\ slash", "CETEARYL ALCOHOL GLYCERIN PARFUM", "a", "and", "Bañinci", "2,3", "citric", "acid", "* star", " -x-", "CAPRYLIC", "CAPRIC", "TRIGLYCERIDE", "lot 5", "\u00a0nb\u00a0sp", "\ufdd0", "日本"]


@pytest.mark.parametrize("mode", ["v1", "v2"])
def test_tokens_by_expression_and_token_by_token(spark, mode):
    """Random labels: with a list of names, with a table of names, and one token after the other."""
    r = random.Random(5)
    seps = [", ", ",", ";", " · ", "•", "\n", " ", "\t", ". "]
    labels = ["".join(r.choice(BITS) + r.choice(seps if i % 3 else [" ", ", "]) for _ in range(r.randrange(1, 14))) for i in range(1500)]
    terms = ["zinc", "citric acid", "baninci", "aqua seed", "seed oil glycerin", "parfum", "water oil", "a b c d e f g h i"]
    df = spark.createDataFrame([(x, i) for i, x in enumerate([*labels, None, "", *labels[:5]])], "t string, tokens int").repartition(4)
    met = tokenize_labels(df.withColumnRenamed("tokens", "i"), "t", spark.createDataFrame([(x,) for x in [*terms, terms[0], "", None]], "n string"), mode)
    plain = Tokenizer(mode, terms)
    rows = met.select("t", "tokens", tokenize_label("t", mode, terms).alias("listed"), F.coalesce(list_section("t", mode), F.lit("")).alias("s")).collect()
    assert len(rows) == len(labels) + 7
    for x in rows:
        assert x.tokens == x.listed == plain(x.s), x.t


def test_tokens_of_a_long_label(spark):
    """100,000 parts in one label: no step is quadratic in them."""
    text = "seed, oil, " * 25_000 + "niacinamide, citric, acid, " * 25_000
    assert spark.createDataFrame([(text,)], "t string").select(F.size(tokenize_label("t"))).first()[0] == 75_000
    assert spark.createDataFrame([("How to use: x. INCI: Aqua",)], "l string").select(list_section("l")).first()[0] == "Aqua"


def test_web(one):
    ok = ["https://www.sephora.com/p", "https://a.sephora.com.", "http://sephora.com", "https://u:p@sephora.com", "nonsense", None]
    assert one(*[web.host(L(u).cast("string")) for u in ok]) == ("sephora.com", "a.sephora.com", None, None, None, None)
    assert one(*[web.matches_domain(L(h), L("WWW.Sephora.com.")) for h in ("sephora.com", "x.sephora.com", "sephora.com.example.org", "notsephora.com")]) == (True, True, False, False)
    assert one(web.element_text(L("<h1 class=x>A <b>b</b>\n&amp; c</h1>"), "h1"), web.element_text(L("<p>"), "h1"), web.first_link(L("<a class=b href='/x'>"))) == ("A b & c", None, "/x")
    a, b = one(web.end_of_day(L("2026-06-30"), end=True), web.end_of_day(L("2026-06-30")))
    assert (str(a), str(b)) == ("2026-07-01 00:00:00", "2026-06-30 00:00:00")
    now = L("2024-01-10 00:00:00").cast("timestamp")
    assert one(*[web.age_bucket(L(t).cast("timestamp"), now) for t in ("2024-01-09 23:30:00", "2024-01-09 19:00:00", "2024-01-06 00:00:00")]) == ("< 1 hour", "5 hours", "4 days")


def test_ages_count_whole_hours(spark):
    now = L("2024-02-01 00:00:00").cast("timestamp")
    ages = [web.age_bucket(L(t).cast(kind), now) for kind in ("timestamp", "timestamp_ntz") for t in ("2024-01-31 23:00:00", "2024-01-31 23:00:00.000001", "2024-01-30 03:00:00.4", "2024-01-30 00:00:00.999999", "2024-01-28 00:00:00", "2024-01-28 00:00:00.5")]
    want = ("1 hours", "< 1 hour", "44 hours", "47 hours", "4 days", "3 days")
    assert spark.range(1).select(*[a.alias(f"c{i}") for i, a in enumerate(ages)]).first() == want + want
