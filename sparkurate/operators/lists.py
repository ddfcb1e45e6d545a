"""Repairs of ordered lists, kept as rows (group, position, token, ...)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.labels import let
from .matching import first_by
from .scratch import written


def _by(group: str, *order: str | Column) -> Window:
    return Window.partitionBy(group).orderBy(*order)


def renumber(rows: DataFrame, group: str, order: list[str | Column], position: str = "position") -> DataFrame:
    """Positions 1, 2, 3, ... in order."""
    return rows.withColumn(position, F.row_number().over(_by(group, *order)))


def gaps(rows: DataFrame, group: str, order: list[str], position: str = "position") -> DataFrame:
    """Rows whose position is not their place, with `expected`."""
    return rows.withColumn("expected", F.row_number().over(_by(group, *order))).where(F.col("expected") != F.col(position))


def keep_best(rows: DataFrame, group: str, key: str, best: list[Column], position: str = "position") -> DataFrame:
    """One row per group and key, the first by `best`, at the key's first position; renumbered."""
    first = rows.groupBy(group, key).agg(F.min(position).alias("_first"))
    kept = first_by(rows, [group, key], best).drop(position).join(first, [group, key]).withColumnRenamed("_first", position)
    return renumber(kept, group, [position, key], position)


def shift_after_deletions(rows: DataFrame, group: str, deleted: Column, position: str = "position") -> DataFrame:
    """What is left, each position less the deletions before it."""
    n = F.sum(deleted.cast("int")).over(_by(group, position).rowsBetween(Window.unboundedPreceding, 0))
    return rows.withColumn(position, F.col(position) - n).where(~deleted)


def truncate_at_marker(rows: DataFrame, group: str, marker: Column, position: str = "position") -> DataFrame:
    """Rows before the group's first marker row; all where it has none."""
    first = rows.where(marker).groupBy(group).agg(F.min(position).alias("_cut"))
    return rows.join(first, group, "left").where(F.col("_cut").isNull() | (F.col(position) < F.col("_cut"))).drop("_cut")


def merge_pairs(rows: DataFrame, group: str, token: str, joins: Column, position: str = "position") -> DataFrame:
    """Adjacent rows joined where `joins` holds (a condition on `token` and `next_token`), pairs of a chain left alone.

    A pair that starts or ends in another pair is in doubt, so neither is merged.
    """
    w = _by(group, position)
    marked = rows.withColumn("next_token", F.lead(token).over(w)).withColumn("_pair", F.coalesce(joins, F.lit(False)))
    marked = marked.withColumn("_before", F.coalesce(F.lag("_pair").over(w), F.lit(False))).withColumn("_after", F.coalesce(F.lead("_pair").over(w), F.lit(False)))
    marked = marked.withColumn("_merge", F.col("_pair") & ~F.col("_before") & ~F.col("_after"))
    marked = marked.withColumn("_gone", F.coalesce(F.lag("_merge").over(w), F.lit(False)))
    marked = marked.withColumn(token, F.when(F.col("_merge"), F.concat_ws(" ", token, "next_token")).otherwise(F.col(token)))
    return shift_after_deletions(marked, group, F.col("_gone"), position).drop("next_token", "_pair", "_before", "_after", "_merge", "_gone")


def find_sequences(rows: DataFrame, group: str, value: str, sequences: DataFrame, position: str = "position") -> DataFrame:
    """(group, start, name, length): places where a known sequence(name, parts array) stands, longest first, without overlaps.

    A candidate gives way to a longer one that it overlaps, and to an earlier one of the same length.
    Lists are arrays of a group; sequences meet them on their first part.
    """
    lists = rows.groupBy(group).agg(F.array_sort(F.collect_list(F.struct(position, F.col(value).alias("v")))).alias("l"))
    starts = lists.select(group, F.col("l.v").alias("v"), F.posexplode("l").alias("i", "first")).select(group, "v", "i", F.col(f"first.{position}").alias("start"), F.col("first.v").alias("head"))
    known = sequences.select("name", "parts", F.size("parts").alias("length"), F.get("parts", F.lit(0)).alias("head"))
    hits = starts.join(known, "head").where(F.slice("v", F.col("i") + 1, F.col("length")) == F.col("parts")).select(group, F.col("i").alias("at"), "start", "name", "length")
    other = hits.select(F.col(group).alias("_g"), F.col("at").alias("_at"), F.col("length").alias("_n"), F.col("name").alias("_name"))
    overlap = (F.col(group) == F.col("_g")) & (F.col("at") < F.col("_at") + F.col("_n")) & (F.col("_at") < F.col("at") + F.col("length"))
    better = (F.col("_n") > F.col("length")) | ((F.col("_n") == F.col("length")) & ((F.col("_at") < F.col("at")) | ((F.col("_at") == F.col("at")) & (F.col("_name") < F.col("name")))))
    return hits.join(other, overlap & better, "left_anti").select(group, "start", "name", "length")


def classify(rules: list[tuple[str, str]], c: Column | str, default: str | None = None) -> Column:
    """The label of the first pattern (Java regex, ignoring case) that is found in c."""
    c = F.col(c) if isinstance(c, str) else c
    out = F.lit(default)
    for pattern, label in reversed(rules):
        out = F.when(c.rlike(f"(?i){pattern}"), label).otherwise(out)
    return out


_BREAK = "\x01"


def required_literals(pattern: Column) -> Column:
    """For each alternative of a Java regex its longest run of characters that a match must contain, in lower case; null where one has none or can't be read.

    A run ends at escapes, classes, groups, quantifiers and anchors, so it may be shorter than what is required,
    never longer. References, codes, quotations, and the flags x, u and U make a pattern unreadable.
    """
    p = F.regexp_replace(pattern, r"(?s)\\[pP](\{[^}]*\}|.)|\\.", _BREAK)
    odd = pattern.rlike(r"\\[QExu0cNk1-9]|\(\?[a-zA-Z-]*[xuU]|[\x01]") | p.rlike(r"\[\^?\]")
    p = F.regexp_replace(p, r"\[[^\[\]]*\]", _BREAK)
    for _ in range(6):  # groups within groups
        p = F.regexp_replace(p, r"\([^()]*\)", _BREAK)
    odd = odd | p.rlike(r"[\[\]()]")
    p = F.regexp_replace(p, r"\+[?+]?", _BREAK)
    p = F.regexp_replace(p, r"(?s).(\?|\*|\{[^}]*\})[?+]?", _BREAK)
    p = F.lower(F.regexp_replace(p, r"[.^$]|[^ -~]", _BREAK))
    runs = lambda x: F.array_sort(F.filter(F.split(x, _BREAK), lambda r: r != ""), lambda u, v: F.length(v) - F.length(u))
    longest = F.transform(F.split(p, r"\|", -1), lambda x: F.get(runs(x), 0))
    return F.when(~odd & F.forall(longest, lambda x: x.isNotNull()), longest)


def _grams(text: Column, sizes: tuple[int, ...]) -> Column:
    """Distinct stretches of so many characters, in linear time."""
    of = lambda c, n: F.transform(F.filter(c, lambda x, i: i <= F.size(c) - n), lambda x, i: F.concat(x, *[F.get(c, i + j) for j in range(1, n)]))
    return let(F.filter(F.split(text, ""), lambda x: x != ""), lambda c: F.array_distinct(F.concat(*[of(c, n) for n in sizes])))


def pattern_hits(tokens: DataFrame, c: str, patterns: DataFrame) -> DataFrame:
    """(token, pattern): what of distinct tokens is found by which of patterns(pattern), Java regexes that ignore case.

    A pattern is tried on the tokens only that have, of a literal of one of its alternatives, the three
    characters (or as many as there are) that the fewest tokens have. Patterns without a literal are tried on
    every token, which their few rows are joined with as they are. Null tokens and patterns find nothing.
    """
    given = patterns.select("pattern").where("pattern is not null").distinct().withColumn("_runs", required_literals(F.col("pattern")))
    parts = given.where("_runs is not null").select("pattern", F.posexplode("_runs").alias("_i", "_run"))
    size = F.length("_run")
    cut = F.when(size >= 3, _grams(F.col("_run"), (3,))).when(size == 2, _grams(F.col("_run"), (2,))).otherwise(_grams(F.col("_run"), (1,)))
    parts = parts.select("pattern", "_i", F.explode(cut).alias("_gram"))
    held = tokens.select(c, F.explode(_grams(F.lower(F.col(c)), (1, 2, 3))).alias("_gram")).join(parts.select("_gram").distinct(), "_gram", "left_semi")
    counts = held.groupBy("_gram").agg(F.count("*").alias("_n"))
    rarest = parts.join(counts, "_gram", "left").groupBy("pattern", "_i").agg(F.min(F.struct(F.coalesce("_n", F.lit(0)).alias("n"), "_gram")).alias("_g"))
    tried = held.join(rarest.select("pattern", F.col("_g._gram").alias("_gram")).distinct(), "_gram").select(c, "pattern").distinct()
    found = F.expr(f"`{c}` rlike concat('(?i)', pattern)")
    return tried.where(found).unionByName(tokens.select(c).join(given.where("_runs is null").select("pattern"), found))


def pattern_purge(rows: DataFrame, c: str, patterns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows that match none, findings(reason, action, token, n)) of patterns(pattern, reason); each different token is tried once."""
    tokens = rows.groupBy(c).agg(F.count("*").alias("n"))
    hits = pattern_hits(tokens, c, patterns).join(patterns.distinct(), "pattern")
    bad = hits.groupBy(c).agg(F.min("reason").alias("reason")).join(tokens, c)
    findings = bad.select("reason", F.lit("delete").alias("action"), F.col(c).alias("token"), "n")
    return rows.join(bad.select(c), c, "left_anti"), findings


def priority_candidates(rows: DataFrame, key: str, candidates: list[Column], index: DataFrame) -> DataFrame:
    """(key, candidate, id): the first of several cleaned spellings that the index(term, id) knows."""
    tried = rows.select(key, F.posexplode(F.array(*candidates)).alias("priority", "candidate")).where("candidate is not null and candidate <> ''")
    known = tried.join(index.select(F.col("term").alias("candidate"), "id"), "candidate")
    return first_by(known, [key], [F.col("priority"), F.col("candidate"), F.col("id")]).select(key, "candidate", "id")


def _numbered(rows: DataFrame, group: str, order: list[str], size: str) -> DataFrame:
    """rows(group, order, size) with _g (the group as text), _i (place in the group, from 0) and _s (sizes of the rows before); sums of ranges, so that one group may fill many tasks."""
    by = ["_g", *order, size]
    rows = rows.select(group, *order, F.col(size).cast("long").alias(size)).withColumn("_g", F.to_json(F.struct(F.col(group).alias("g"))))
    rows = written(rows.repartitionByRange(*by).withColumn("_range", F.spark_partition_id()))  # written, as ranges are drawn by a sample
    sums = rows.groupBy("_g", "_range").agg(F.count("*").alias("_rows"), F.coalesce(F.sum(size), F.lit(0)).alias("_bytes"))
    before = Window.partitionBy("_g").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range
    starts = sums.select("_g", "_range", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(c) for c in ("_rows", "_bytes")])
    inside = Window.partitionBy("_g", "_range").orderBy(*order, size)
    place = F.row_number().over(inside) - 1
    sofar = F.coalesce(F.sum(size).over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rows = rows.withColumn("_at", place).withColumn("_sofar", sofar).join(starts, ["_g", "_range"])
    return rows.select(group, *order, size, "_g", (F.col("_at") + F.col("_rows")).alias("_i"), (F.col("_sofar") + F.col("_bytes")).alias("_s"))


def fill_groups(rows: DataFrame, order: list[str], size: str, most_rows: int, most_bytes: int, group: str) -> DataFrame:
    """rows(group, order, size) with `batch`: filled in order per group, each batch up to so many rows and bytes.

    A row over the limit has a batch of its own; equal rows may change places; a null size counts as 0, and sizes
    are not negative. Each row learns which row would start the next batch if it started one: of the rows within
    most_rows, in blocks of that many, by sorting the sums. Pointers are doubled from each group's first row on,
    so a group of n batches takes about log2(n) joins, and no task holds a group.
    """
    numbered = written(_numbered(rows, group, order, size))
    end = F.col("_s") + F.coalesce(F.col(size), F.lit(0))
    ends = numbered.select("_g", F.floor(F.col("_i") / most_rows).alias("_block"), end.alias("_v"), F.lit(0).alias("_kind"), "_i")
    asks = numbered.select("_g", F.floor(F.col("_i") / most_rows).alias("_block"), (F.col("_s") + most_bytes).alias("_v"), F.lit(1).alias("_kind"), "_i")
    asks = asks.unionAll(asks.withColumn("_block", F.col("_block") + 1))
    sorted_ = Window.partitionBy("_g", "_block").orderBy("_v", "_kind", "_i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = F.max(F.when(F.col("_kind") == 0, F.col("_i"))).over(sorted_)  # the last row that still fits
    fits = ends.unionAll(asks).withColumn("_last", last).where("_kind = 1").groupBy("_g", "_i").agg(F.max("_last").alias("_last"))
    follow = written(fits.select("_g", "_i", F.least(F.col("_i") + most_rows, F.greatest(F.col("_i"), F.coalesce("_last", "_i")) + 1).alias("_to")))

    jump, step = follow, 1
    reached = follow.where("_i = 0").select("_g", "_i", F.lit(0).cast("long").alias("batch"))
    while True:
        new = written(reached.join(jump, ["_g", "_i"]).select("_g", F.col("_to").alias("_i"), (F.col("batch") + step).alias("batch")).join(follow.select("_g", "_i"), ["_g", "_i"], "left_semi"))
        if new.isEmpty():
            break
        reached = reached.unionAll(new)
        jump = written(jump.join(jump.select("_g", F.col("_i").alias("_to"), F.col("_to").alias("_after")), ["_g", "_to"]).select("_g", "_i", F.col("_after").alias("_to")))
        step *= 2
    places = reached.join(follow, ["_g", "_i"]).select("_g", F.explode(F.sequence(F.col("_i"), F.col("_to") - 1)).alias("_i"), "batch")
    return numbered.join(places, ["_g", "_i"]).select(group, *order, size, "batch")


def merge_sequences(rows: DataFrame, group: str, value: str, found: DataFrame, position: str = "position") -> DataFrame:
    """rows with each place of found(group, start, name, length), as from find_sequences(), as one row of that name; renumbered.

    Places do not overlap, so a row belongs to the last one that starts at or before it.
    """
    marked = rows.join(found.select(group, F.col("start").alias(position), F.col("name").alias("_name"), F.col("length").alias("_n")), [group, position], "left")
    w = _by(group, position).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = F.last(F.when(F.col("_name").isNotNull(), F.col(position) + F.col("_n")), ignorenulls=True).over(w)
    marked = marked.withColumn("_end", last).withColumn(value, F.coalesce("_name", value))
    inside = F.col("_name").isNull() & F.coalesce(F.col(position) < F.col("_end"), F.lit(False))
    return renumber(marked.where(~inside).drop("_name", "_n", "_end"), group, [position], position).select(rows.columns)
