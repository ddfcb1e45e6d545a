"""Changes of tables as new DataFrames: upserts, updates, deletes, merges of duplicates, checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .matching import first_by


def insert_missing(table: DataFrame, new: DataFrame, key: list[str], order: list[str] | None = None) -> DataFrame:
    """table and the rows of new whose key it lacks; of several new rows with a key the first in `order`. Null keys never conflict."""
    some = new.where(" and ".join(f"`{k}` is not null" for k in key))
    one = first_by(some, key, [F.col(c) for c in order]) if order else some.dropDuplicates(key)
    rest = new.where(" or ".join(f"`{k}` is null" for k in key))
    return table.unionByName(one.select(table.columns).join(table.select(*key).distinct(), key, "left_anti").select(table.columns)).unionByName(rest.select(table.columns))


def upsert(table: DataFrame, new: DataFrame, key: list[str], maps: tuple[str, ...] = (), arrays: tuple[str, ...] = ()) -> DataFrame:
    """table updated and extended by new, one row per key in each.

    New values that are not null win; a map is overlaid with its new entries that are not null; an
    array is replaced by one that is not empty.
    """
    rest = [c for c in table.columns if c not in key]
    old = table.select(*key, F.struct(*rest).alias("_old"), F.lit(True).alias("_has"))
    both = old.join(new.select(*key, F.struct(*rest).alias("_new")), key, "full_outer")

    def merged(c: str) -> Column:
        a, b = F.col(f"_old.{c}"), F.col(f"_new.{c}")
        if c in maps:
            b = F.map_filter(b, lambda _, v: v.isNotNull())
            kept = F.map_filter(a, lambda k, _: ~F.coalesce(F.map_contains_key(b, k), F.lit(False)))
            return F.coalesce(F.map_concat(kept, b), b, a).alias(c)
        if c in arrays:
            return F.when(F.size(b) > 0, b).otherwise(F.coalesce(a, b)).alias(c)
        return F.coalesce(b, a).alias(c)

    return both.select(*key, *map(merged, rest)).select(table.columns)


def update_from(table: DataFrame, changes: DataFrame, key: list[str], columns: list[str]) -> DataFrame:
    """table with the columns of changes (one row per key) where it has the key, nulls included."""
    new = changes.select(*key, *[F.col(c).alias(f"_{c}") for c in columns], F.lit(True).alias("_hit"))
    met = table.join(new, key, "left")
    return met.select(*[F.when(F.col("_hit"), F.col(f"_{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c) for c in table.columns])


def delete_using(table: DataFrame, gone: DataFrame, key: list[str]) -> DataFrame:
    return table.join(gone.select(*key).distinct(), key, "left_anti").select(table.columns)


def full_outer_backfill(left: DataFrame, right: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """One row per key of either, each column from left, else from right."""
    return left.alias("l").join(right.alias("r"), key, "full_outer").select(key, *[F.coalesce(f"l.{c}", f"r.{c}").alias(c) for c in columns])


def parity(left: DataFrame, right: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """One row: rows of each, keys that only one has, and keys whose columns differ (nulls are equal)."""
    a, b = (d.select(key, F.struct(*columns).alias("v"), F.lit(1).alias("has")) for d in (left, right))
    both = a.alias("a").join(b.alias("b"), key, "full_outer")
    differ = F.col("a.has").isNotNull() & F.col("b.has").isNotNull() & ~F.col("a.v").eqNullSafe(F.col("b.v"))
    return both.agg(F.count("a.has").alias("n_left"), F.count("b.has").alias("n_right"), F.count_if(F.col("b.has").isNull()).alias("only_left"), F.count_if(F.col("a.has").isNull()).alias("only_right"), F.count_if(differ).alias("different"))


def backup(table: DataFrame, gone: DataFrame, key: list[str], kept: DataFrame | None = None, label: str = "") -> DataFrame:
    """(label, key as JSON, row as JSON, kept row as JSON) of rows about to be deleted."""
    rows = table.join(gone.select(*key).distinct(), key, "left_semi").select(F.lit(label).alias("label"), F.to_json(F.struct(*key)).alias("key"), F.to_json(F.struct(*table.columns)).alias("row"))
    if kept is None:
        return rows
    return rows.join(kept.select(F.to_json(F.struct(*key)).alias("key"), F.to_json(F.struct(*kept.columns)).alias("kept_row")), "key", "left")


def findings(rows: DataFrame, label: str, reason: Column, action: str, token: str) -> DataFrame:
    """(label, reason, action, token, n): a log of what a repair found, by token."""
    return rows.groupBy(reason.alias("reason"), F.col(token).alias("token")).agg(F.count("*").alias("n")).select(F.lit(label).alias("label"), "reason", F.lit(action).alias("action"), "token", "n")


def winners(entries: DataFrame, aliases: DataFrame, key: str) -> DataFrame:
    """(id, winner): for entries(id, created_at, key): of those with one key the one with most aliases, then the oldest, then the smallest id."""
    n = aliases.groupBy("id").agg(F.count("*").alias("n"))
    counted = entries.join(n, "id", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    best = first_by(counted.select(key, "n", "created_at", "id"), [key], [-F.col("n"), F.col("created_at"), F.col("id")]).select(key, F.col("id").alias("winner"))
    return entries.join(best, key).select("id", "winner")


def merge_duplicates(tables: dict[str, DataFrame], key: str = "normalized_name", scalars: tuple[str, ...] = ()) -> dict[str, DataFrame]:
    """Entries with one key become one, for all keys at once.

    tables: entries(id, name, created_at, key, scalars...), aliases(id, alias, ...), and any others with
    an `id` column that refers to an entry. The winner takes the losers' scalars where it has none
    (from the smallest loser that has), all their children, and their names as aliases.
    """
    entries, aliases = tables["entries"], tables["aliases"]
    to = winners(entries, aliases, key)
    moved = to.where("id <> winner")
    given = entries.join(moved, "id").groupBy("winner").agg(*[F.min_by(c, F.when(F.col(c).isNotNull(), F.col("id"))).alias(f"_{c}") for c in scalars], F.count("*").alias("_n"))
    left = entries.join(moved.select("id"), "id", "left_anti").join(given, F.col("id") == F.col("winner"), "left")
    out = {"entries": left.select(*[F.coalesce(c, f"_{c}").alias(c) if c in scalars else F.col(c) for c in entries.columns])}
    for name, child in tables.items():
        if name != "entries":
            out[name] = child.join(moved, "id", "left").withColumn("id", F.coalesce("winner", "id")).select(child.columns)
    names = entries.join(moved, "id").select(F.col("winner").alias("id"), F.col("name").alias("alias"))
    out["aliases"] = out["aliases"].unionByName(names, allowMissingColumns=True).dropDuplicates(["id", "alias"])
    return out


def chain_ends(moves: DataFrame) -> DataFrame:
    """(id, end, stuck) for pointers moves(id, target_id), one of each id: where a chain of them ends; stuck: in a circle, which ends nowhere.

    Pointers are doubled, so a chain of n takes about log2(n) joins; each step is read from a checkpoint.
    """
    now, most = moves.select("id", F.col("target_id").alias("end")), 1
    n = now.count()
    while True:
        onward = now.join(moves.select(F.col("id").alias("end"), F.lit(True).alias("stuck")), "end", "left").select("id", "end", F.coalesce("stuck", F.lit(False)).alias("stuck"))
        if most > n or not onward.where("stuck").take(1):  # no chain has more steps than there are pointers
            return onward
        after = now.select(F.col("id").alias("end"), F.col("end").alias("after"))
        now = cut_lineage(now.join(after, "end", "left").select("id", F.coalesce("after", "end").alias("end")))
        most *= 2


def cut_lineage(df: DataFrame) -> DataFrame:
    """df as a checkpoint in the folder of spark.checkpoint.dir; as it is where none is set."""
    spark = df.sparkSession
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        return df
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint()


def apply_decisions(tables: dict[str, DataFrame], decisions: DataFrame) -> dict[str, DataFrame]:
    """Decisions(id, decision, target_id, canonical, aliases) applied to entries, aliases and items, with an audit.

    merge_into_existing and alias_to_existing move what refers to the source to the target, make its
    name an alias (a typo or a synonym), add the decision's aliases and delete the source; keep renames;
    the rest changes nothing. Where a target is moved itself, all goes to the end of the chain. Decisions
    in a circle, and those whose source or target isn't there, are left to a human. Of several moves
    of one entry the one with the smallest target is taken, the others are left to a human.
    """
    entries, aliases, items = tables["entries"], tables["aliases"], tables["items"]
    there = entries.select("id")
    asked = decisions.where(F.col("decision").isin("merge_into_existing", "alias_to_existing") & (F.col("id") != F.col("target_id")))
    asked = asked.join(there, "id", "left_semi").join(there.select(F.col("id").alias("target_id")), "target_id", "left_semi")
    one = first_by(asked.select("id", "target_id", "decision", "canonical", "aliases"), ["id"], [F.col("target_id"), F.col("decision"), F.col("canonical")])
    ends = chain_ends(one.select("id", "target_id"))
    to = ends.where("not stuck").select("id", "end")
    moves = one.join(to, "id")
    keeps = decisions.where((F.col("decision") == "keep") & F.col("canonical").isNotNull()).select("id", F.col("canonical").alias("name"))
    rename = update_from(entries, keeps, ["id"], ["name"])
    kind = F.when(F.col("decision") == "merge_into_existing", "typo").otherwise("synonym")
    own = entries.join(moves.select("id", "end", kind.alias("alias_type")), "id").select(F.col("end").alias("id"), F.col("name").alias("alias"), "alias_type")
    given = moves.select(F.col("end").alias("id"), F.explode("aliases").alias("alias")).withColumn("alias_type", F.lit("synonym"))
    moved = aliases.join(to, "id", "left").withColumn("id", F.coalesce("end", "id")).select(aliases.columns)
    taken = moves.select("id", "target_id", "decision", F.lit("applied").alias("_s")).distinct()
    status = F.coalesce("_s", F.when(F.col("decision") == "keep", "kept").otherwise("pending_human"))
    audit = decisions.join(taken, ["id", "target_id", "decision"], "left").join(entries.select("id", F.col("name").alias("before")), "id", "left")
    audit = audit.select("id", "decision", status.alias("status"), F.to_json(F.struct("before")).alias("before"), F.to_json(F.struct("target_id", "canonical")).alias("after"))
    return {
        "entries": delete_using(rename, moves, ["id"]),
        "aliases": insert_missing(first_by(moved, ["id", "alias"], [F.col("alias_type")]).select(aliases.columns), own.unionByName(given), ["id", "alias"], ["alias_type"]),
        "items": items.join(to, "id", "left").withColumn("id", F.coalesce("end", "id")).select(items.columns),
        "audit": audit,
    }


def latest(log: DataFrame, key: str, order: list[str], value: str) -> DataFrame:
    """(key, value) of the newest row of an append-only log."""
    return log.groupBy(key).agg(F.max_by(value, F.struct(*order)).alias(value))


def visible(rows: DataFrame, published: Column, owner: Column | None = None, user: str | None = None, curators: DataFrame | None = None) -> DataFrame:
    """Rows that are published, the user's own, or all for a curator."""
    if curators is not None and curators.where(F.col("user") == user).take(1):
        return rows
    own = owner == F.lit(user) if owner is not None and user is not None else F.lit(False)
    return rows.where(F.coalesce(published, F.lit(False)) | F.coalesce(own, F.lit(False)))


def with_positions_checked(rows: DataFrame, group: str, position: str = "position") -> DataFrame:
    """(group, ok): positions are 1, 2, 3, ... without gaps or repeats."""
    return rows.groupBy(group).agg(((F.min(position) == 1) & (F.max(position) == F.count("*")) & (F.count_distinct(position) == F.count("*"))).alias("ok"))


def running_first(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Rows without later repeats of a key."""
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where("_n = 1").drop("_n")


def json_lists(rows: DataFrame, group: str, order: list[str], columns: list[str]) -> DataFrame:
    """(group, items): each group's rows in order, as a JSON array of objects."""
    parts = F.array_sort(F.collect_list(F.struct(*[F.col(o).alias(f"_{i}") for i, o in enumerate(order)], F.struct(*columns).alias("_v"))))
    return rows.groupBy(group).agg(F.to_json(parts["_v"]).alias("items"))


def beside(rows: DataFrame, one: DataFrame) -> DataFrame:
    """rows with the columns of a table of one row, as a grand total; more rows are an error."""
    whole = one.agg(F.count("*").alias("_n"), F.first(F.struct("*")).alias("_one"))  # one row by its nature
    checked = whole.select(F.when(F.col("_n") <= 1, F.col("_one")).otherwise(F.raise_error(F.lit("more than one row")).cast(whole.schema["_one"].dataType)).alias("_one"))
    return rows.crossJoin(F.broadcast(checked)).select(*rows.columns, "_one.*")


def detach(tables: dict[str, DataFrame], gone: DataFrame) -> dict[str, DataFrame]:
    """entries(id), aliases(id) and items(id) without gone(id): items stay with no entry, aliases and entries go."""
    lost = gone.select("id", F.lit(True).alias("_gone")).distinct()
    items = tables["items"].join(lost, "id", "left").withColumn("id", F.when(F.col("_gone").isNull(), F.col("id"))).select(tables["items"].columns)
    return {"items": items, "aliases": delete_using(tables["aliases"], gone, ["id"]), "entries": delete_using(tables["entries"], gone, ["id"])}
