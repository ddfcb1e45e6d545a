"""Mixing of sources to target weights by hash-random keys and distributed prefix sums.

Each document has a key from a hash of its id. The table is range-sorted by source and key, so a
source of any size is spread over many tasks; prefix sums of the sizes number the words of each
source in that order. A source's target is its weight's share of the total, at most `most` times its
own size; what is cut off is shared out again by weight. A target of several times the source takes
all of it that often (epochs), and the rest from the start of the order, to the exact word: the
document at the cut gives part of its words.

Null texts have size 0, a null source is a source of its own and comes last, and rows that repeat an
id are documents of their own. Sources without words have target 0. The result depends on the rows
only, not on how they are dealt out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, prefix_sums


def targets(sizes: dict[str | None, int], weights: list[float], share: float, most: float) -> dict[str | None, float]:
    """Words to take of each source; sizes in the sources' order, weights repeat along it."""
    weight = {s: weights[i % len(weights)] for i, s in enumerate(sizes)}
    total = share * sum(sizes.values())
    fixed: dict[str | None, float] = {}
    free = list(sizes)
    while free:
        rest, w = total - sum(fixed.values()), sum(weight[s] for s in free)
        over = [s for s in free if rest * weight[s] / w > most * sizes[s]]
        if not over:
            return {s: fixed.get(s, rest * weight[s] / w) for s in sizes}
        fixed |= {s: most * float(sizes[s]) for s in over}
        free = [s for s in free if s not in fixed]
    return {s: fixed[s] for s in sizes}


def words(text: Column) -> Column:
    """Number of [^\\x20\\x09-\\x0D]+ in a text."""
    squeezed = F.regexp_replace(F.trim(F.translate(F.coalesce(text, F.lit("")), "\t\n\x0b\f\r", "     ")), " +", " ")
    return F.when(squeezed == "", F.lit(0)).otherwise(F.length(squeezed) - F.length(F.replace(squeezed, F.lit(" "))) + 1).cast("long")


def mix_sources(docs: DataFrame, weights: list[float] = (3, 1, 2), share: float = 1.5, most: float = 2.0, seed: int = 17, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", carry: list[str] = ()) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken, text_key) of each row, and the columns of docs to carry; text_key tells rows that repeat an id apart."""
    scratch = Scratch(docs.sparkSession, "mixing")
    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"), words(text).alias("size"), F.xxhash64(text).alias("text_key"), *carry)
    rows = scratch.keep(rows, "rows")
    totals = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    names = totals.collect()  # one row per source: sources are kinds of documents, some thousands at most
    of = {r.source: r.source_size for r in names}
    order = sorted((s for s in of if s is not None), key=lambda s: [ord(c) for c in s]) + ([None] if None in of else [])
    target = targets({s: of[s] for s in order}, list(weights), share, most)
    table = docs.sparkSession.createDataFrame([(s, int(of[s]), float(target[s])) for s in order], "source string, source_size long, target double")
    key = F.xxhash64("doc_id", F.lit(seed))
    placed = prefix_sums(rows.withColumn("key", key).withColumn("before", F.lit(0).cast("long")), [F.col("source"), F.col("key"), F.col("doc_id"), F.col("text_key")], {"before": F.col("size")}, scratch, "placed", ["source"])
    placed = placed.withColumnRenamed("source", "_s").join(F.broadcast(table) if len(order) <= 100_000 else table, F.col("_s").eqNullSafe(F.col("source")))
    # ties (rows equal in every column) share a key and order: they are alike, so which one is cut first doesn't matter
    budget = F.round("target").cast("long")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0).cast("long")
    rest = budget - epochs * F.col("source_size")
    taken = epochs * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("before")))
    return placed.select("doc_id", "source", "size", "source_size", "target", taken.cast("long").alias("taken"), "text_key", *carry)
