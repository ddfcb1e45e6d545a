"""What changed between two snapshots of a table, what follows from it, and a lossless split in two tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _struct(columns: list[str], alias: str) -> Column:
    return F.struct(*[F.col(f"`{c}`") for c in columns]).alias(alias)


def _comparable(c: Column, kind: str) -> Column:
    """Maps have no order and no equality: their entries, sorted, do."""
    return F.array_sort(F.map_entries(c)) if kind.startswith("map") else c


def change_feed(old: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """(key, op, before, after, changed): rows that were inserted, deleted or updated, and which columns an update changed.

    A key is in one row of each snapshot; null keys match each other. Columns are compared null-safe, those
    that only one snapshot has as null in the other.
    """
    columns = [c for c in dict.fromkeys([*old.columns, *new.columns]) if c not in key]
    kinds = dict(old.dtypes) | dict(new.dtypes)
    side = lambda df, name: df.select(*[(F.col(f"`{c}`") if c in df.columns else F.lit(None).cast(kinds[c])).alias(c) for c in [*key, *columns]]).select(*[F.col(f"`{k}`").alias(f"_{name}{i}") for i, k in enumerate(key)], _struct(columns, name), F.lit(True).alias(f"_has_{name}"))
    same_key = F.lit(True)
    for i in range(len(key)):
        same_key = same_key & F.col(f"_before{i}").eqNullSafe(F.col(f"_after{i}"))
    both = side(old, "before").join(side(new, "after"), same_key, "full_outer")
    op = F.when(F.col("_has_before").isNull(), "insert").when(F.col("_has_after").isNull(), "delete").otherwise("update")
    differs = lambda c: ~_comparable(F.col(f"before.`{c}`"), kinds[c]).eqNullSafe(_comparable(F.col(f"after.`{c}`"), kinds[c]))
    changed = F.when(op == "update", F.array_compact(F.array(*[F.when(differs(c), F.lit(c)) for c in columns]))).otherwise(F.array().cast("array<string>"))
    keys = [F.when(F.col("_has_after").isNull(), F.col(f"_before{i}")).otherwise(F.col(f"_after{i}")).alias(k) for i, k in enumerate(key)]
    before, after = (F.when(F.col(f"_has_{x}"), F.col(x)).alias(x) for x in ("before", "after"))
    return both.select(*keys, op.alias("op"), before, after, changed.alias("changed")).where((F.col("op") != "update") | (F.size("changed") > 0))


def _null_safe(keys: list[str], left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    a, b = left.alias("a"), right.alias("b")
    on = F.lit(True)
    for k in keys:
        on = on & F.col(f"a.`{k}`").eqNullSafe(F.col(f"b.`{k}`"))
    return a.join(b, on, how)


def apply_feed(table: DataFrame, feed: DataFrame, key: list[str]) -> DataFrame:
    """The table after the changes of a feed."""
    kept = _null_safe(key, table, feed.select(*key), "left_anti").select(table.columns)
    new = feed.where("op <> 'delete'").select(*key, "after.*")
    return kept.unionByName(new.select(table.columns))


def refresh(derived: DataFrame, feed: DataFrame, key: list[str], make: Callable[[DataFrame], DataFrame], watched: list[str] | None = None) -> DataFrame:
    """Derived rows after a feed: make(rows) again for new rows and for those whose watched columns (all, if none are named) changed, and none of deleted rows.

    make gets the key and the columns after the change, and gives rows with the key; it runs over changed rows only.
    """
    hit = F.col("op") != "update"
    hit = hit | (F.arrays_overlap("changed", F.array(*map(F.lit, watched))) if watched else F.lit(True))
    some = feed.where(hit)
    kept = _null_safe(key, derived, some.select(*key), "left_anti").select(derived.columns)
    return kept.unionByName(make(some.where("op <> 'delete'").select(*key, "after.*")).select(derived.columns))


class LostRows(AssertionError):
    """A migration that doesn't give back what it was given."""


def assert_same_rows(before: DataFrame, after: DataFrame, what: str) -> None:
    """Stop with LostRows unless both have the same rows, as often; rows are compared by all columns (maps by their text)."""
    plain = lambda df: df.select(*[(F.to_json(F.array_sort(F.map_entries(f"`{c}`"))) if kind.startswith("map") else F.col(f"`{c}`")).alias(c) for c, kind in before.dtypes])
    count = lambda df, n: plain(df).groupBy(*[F.col(f"`{c}`") for c in before.columns]).agg(F.count("*").alias("_n")).withColumn("_n", F.col("_n") * n)
    rest = count(before, 1).unionAll(count(after, -1)).groupBy(*[F.col(f"`{c}`") for c in before.columns]).agg(F.sum("_n").alias("_n"))
    lost, made = rest.agg(F.coalesce(F.sum(F.greatest("_n", F.lit(0))), F.lit(0)), F.coalesce(F.sum(F.greatest(-F.col("_n"), F.lit(0))), F.lit(0))).first()
    if lost or made:
        raise LostRows(f"{what}: {lost} rows are lost and {made} are new")


def split_table(rows: DataFrame, key: list[str], columns: list[str], foreign: str) -> tuple[DataFrame, DataFrame]:
    """(rows without the columns but with a foreign key, table of the columns' different values by that key).

    The key is a hash of the values, so equal values are one row and a second run makes the same keys; rows
    whose values are all null refer to nothing. Hashes are 128 bits of SHA-256 over JSON, which tells null
    from the empty text.
    """
    clash = {foreign} & set(rows.columns)
    if clash or set(key) & set(columns):
        raise ValueError(f"columns that can't be split off: {sorted(clash | (set(key) & set(columns)))}")
    some = F.lit(False)
    for c in columns:
        some = some | F.col(f"`{c}`").isNotNull()
    made = F.when(some, F.substring(F.sha2(F.to_json(_struct(columns, "v"), {"ignoreNullFields": "false"}), 256), 1, 32))
    keyed = rows.withColumn(foreign, made)
    own = keyed.select(*[c for c in keyed.columns if c not in columns])
    other = keyed.where(F.col(foreign).isNotNull()).groupBy(foreign).agg(F.min(_struct(columns, "v")).alias("v")).select(foreign, "v.*")
    return own, other


def joined_back(own: DataFrame, other: DataFrame, foreign: str, columns: list[str]) -> DataFrame:
    """What split_table was given, with its columns in this order."""
    return own.join(other, foreign, "left").select(*[F.col(f"`{c}`") for c in columns])


def migrate_split(rows: DataFrame, key: list[str], columns: list[str], foreign: str) -> tuple[DataFrame, DataFrame]:
    """split_table, stopped by LostRows if joining back doesn't give the rows, or if a foreign key refers to nothing or to two rows."""
    own, other = split_table(rows, key, columns, foreign)
    assert_same_rows(rows, joined_back(own, other, foreign, rows.columns), "split")
    assert_same_rows(own.where(F.col(foreign).isNotNull()).select(foreign).distinct(), other.select(foreign), "foreign keys")
    return own, other
