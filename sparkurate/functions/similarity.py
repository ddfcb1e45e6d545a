"""Similarity and scores of pairs of names as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import _col, normalize_name

# Words that make two names different things.
MODIFIERS = "acetyl crosspolymer extract ferment flower glucoside hydrolyzed leaf lysate magnesium oil palmitate phosphate potassium root seed sodium".split()


def words(c: Column | str) -> Column:
    return F.filter(F.split(_col(c), "\\s+"), lambda w: w != "")


def trigrams(c: Column | str) -> Column:
    """Distinct trigrams of each word, with two blanks before and one after it."""
    grams = F.transform(words(c), lambda w: F.transform(F.sequence(F.lit(1), F.length(w) + 1), lambda i: F.substr(F.concat(F.lit("  "), w, F.lit(" ")), i, F.lit(3))))
    return F.array_distinct(F.flatten(grams))


def _share(common: Column, whole: Column, left: Column, right: Column) -> Column:
    """common / whole; of two empty sets 1, of one empty set 0."""
    none = (F.size(left) == 0).cast("int") + (F.size(right) == 0).cast("int")
    return F.when(none == 2, 1.0).when(none == 1, 0.0).otherwise(common / whole)


def set_jaccard(a: Column, b: Column) -> Column:
    common = F.size(F.array_intersect(a, b))
    return _share(common, F.size(a) + F.size(b) - common, a, b)


def set_dice(a: Column, b: Column) -> Column:
    return _share(2.0 * F.size(F.array_intersect(a, b)), F.size(a) + F.size(b), a, b)


def trgm_jaccard(a: Column | str, b: Column | str) -> Column:
    return set_jaccard(trigrams(a), trigrams(b))


def trgm_dice(a: Column | str, b: Column | str) -> Column:
    return set_dice(trigrams(a), trigrams(b))


def token_jaccard(a: Column | str, b: Column | str) -> Column:
    return set_jaccard(F.array_distinct(words(a)), F.array_distinct(words(b)))


def modifiers_differ(a: Column | str, b: Column | str) -> Column:
    of = lambda c: F.array_sort(F.array_intersect(F.array(*map(F.lit, MODIFIERS)), words(c)))
    return of(a) != of(b)


def is_spelling_merge(source: Column, target: Column, similarity: Column, distance: Column, overlap: Column, margin: Column) -> Column:
    """Whether a source name is a misspelling of a target; margin may be null."""
    n = F.length(target)
    close = F.when(n <= 8, (distance <= 1) & (similarity >= 0.80)).when(n <= 20, (distance <= 2) | (similarity >= 0.92)).otherwise((similarity >= 0.88) & (overlap >= 0.60))
    return ~modifiers_differ(source, target) & (F.coalesce(margin, F.lit(1.0)) >= 0.05) & close


def confidence_bucket(c: Column | str) -> Column:
    c = _col(c)
    return F.when(c >= 0.92, "keep").when(c >= 0.80, "review").otherwise("reject")


def search_score(query: Column | str, candidate: Column | str) -> Column:
    """How well a typed query fits a name: 1, .95 for a prefix, .9 within; else by how dense its letters stand in order; null if they don't."""
    q, c = normalize_name(query), normalize_name(candidate)
    start = F.struct(F.lit(0).alias("first"), F.lit(0).alias("last"))

    def step(state, letter):
        at = F.call_function("locate", letter, c, state["last"] + 1)
        lost = (state["last"] < 0) | (at == 0)
        first = F.when(state["first"] == 0, at).otherwise(state["first"])
        return F.struct(F.when(lost, state["first"]).otherwise(first).alias("first"), F.when(lost, F.lit(-1)).otherwise(at).alias("last"))

    found = F.aggregate(F.filter(F.split(q, ""), lambda x: x != ""), start, step)
    first, last = found["first"], found["last"]
    edge = (first == 1) | (F.substr(c, F.greatest(first - 1, F.lit(1)), F.lit(1)) == " ")
    loose = 0.45 + F.length(q) / (last - first + 1) * 0.25 + F.length(q) / F.length(c) * 0.1 + F.when(edge, 0.08).otherwise(0.0)
    scored = F.when(last > 0, F.least(F.lit(0.89), loose))
    return F.when((q == "") | (c == ""), None).when(q == c, 1.0).when(F.startswith(c, q), 0.95).when(F.contains(c, q), 0.9).otherwise(scored)
