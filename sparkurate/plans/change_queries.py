"""Changes between two snapshots and a split of a table, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import inci_normalize
from ..operators import changes
from .queries import norm, query, read

#: The day after: some customers are gone, some renamed, some moved, some new.
_NEW = """a AS (SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment, CASE WHEN c_custkey % 4 > 0 THEN c_nationkey END AS nation FROM customer),
    b AS (SELECT id, CASE WHEN id % 5 = 0 THEN name || ' & Co' ELSE name END AS name, CASE WHEN id % 6 = 0 THEN NULL ELSE segment END AS segment, CASE WHEN id % 8 = 0 THEN 1 ELSE nation END AS nation FROM a WHERE id % 7 > 0 UNION ALL SELECT id + 1000000, name, segment, NULL FROM a WHERE id % 11 = 0)"""


def _snapshots(spark, d):
    k = F.col("c_custkey")
    old = read(spark, d, "customer").select(k.alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"), F.when(k % 4 > 0, F.col("c_nationkey")).alias("nation"))
    i = F.col("id")
    name = F.when(i % 5 == 0, F.concat("name", F.lit(" & Co"))).otherwise(F.col("name"))
    there = old.where(i % 7 > 0).select("id", name.alias("name"), F.when(i % 6 > 0, F.col("segment")).alias("segment"), F.when(i % 8 == 0, 1).otherwise(F.col("nation")).cast(old.schema["nation"].dataType).alias("nation"))
    return old, there.unionAll(old.where(i % 11 == 0).select(i + 1000000, "name", "segment", F.lit(None).cast(old.schema["nation"].dataType)))


@query(
    f"""WITH {_NEW}, j AS (SELECT coalesce(b.id, a.id) AS id, CASE WHEN a.id IS NULL THEN 'insert' WHEN b.id IS NULL THEN 'delete' ELSE 'update' END AS op, a.name AS old_name, b.name AS new_name, a.name IS DISTINCT FROM b.name AS n, a.segment IS DISTINCT FROM b.segment AS s, a.nation IS DISTINCT FROM b.nation AS m FROM a FULL JOIN b ON a.id = b.id)
    SELECT id, op, old_name, new_name, CASE WHEN op = 'update' THEN concat_ws(',', CASE WHEN n THEN 'name' END, CASE WHEN s THEN 'segment' END, CASE WHEN m THEN 'nation' END) ELSE '' END AS changed FROM j WHERE op <> 'update' OR n OR s OR m"""
)
def change_feed(spark, d):
    old, new = _snapshots(spark, d)
    feed = changes.change_feed(old, new, ["id"])
    return feed.select("id", "op", F.col("before.name").alias("old_name"), F.col("after.name").alias("new_name"), F.array_join("changed", ",").alias("changed"))


@query(f"WITH {_NEW}, w AS (SELECT id, unnest(list_distinct(string_split({norm('name')}, ' '))) AS term FROM b) SELECT id, term FROM w WHERE term <> ''")
def refreshed_terms(spark, d):
    """Search terms of the new snapshot, made again for rows whose name changed only."""
    old, new = _snapshots(spark, d)
    make = lambda rows: rows.select("id", F.explode(F.array_distinct(F.filter(F.split(inci_normalize("name"), " "), lambda t: t != ""))).alias("term"))
    return changes.refresh(make(old), changes.change_feed(old, new, ["id"]), ["id"], make, watched=["name"])


@query("SELECT p_partkey, p_name, p_brand, p_type, p_size, count(*) OVER (PARTITION BY p_brand, p_type, p_size)::BIGINT AS sharing FROM (SELECT p_partkey, p_name, CASE WHEN p_partkey % 9 > 0 THEN p_brand END AS p_brand, CASE WHEN p_partkey % 9 > 0 THEN p_type END AS p_type, CASE WHEN p_partkey % 9 > 0 THEN p_size END AS p_size FROM part)")
def split_and_joined(spark, d):
    """Parts split into names and kinds with keys between them, checked, and joined back; with how many parts share a kind."""
    p = read(spark, d, "part").select("p_partkey", "p_name", *[F.when(F.col("p_partkey") % 9 > 0, F.col(c)).alias(c) for c in ("p_brand", "p_type", "p_size")])
    own, other = changes.migrate_split(p, ["p_partkey"], ["p_brand", "p_type", "p_size"], "kind_id")
    sharing = own.groupBy("kind_id").agg(F.count("*").alias("sharing"))
    counted = own.join(sharing, own.kind_id.eqNullSafe(sharing.kind_id)).select(own["*"], "sharing")
    return changes.joined_back(counted, other, "kind_id", ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "sharing"])
