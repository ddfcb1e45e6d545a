"""Change feeds and splits on small tables."""

import random

import pytest
from pyspark.sql import functions as F

from sparkurate.operators import changes

ROWS = "k int, j string, name string, tags array<string>, info map<string,string>"


def snapshot(seed):
    r = random.Random(seed)
    keys = r.sample([(k, j) for k in (None, 1, 2, 3, 4) for j in (None, "a", "b")], 10)
    return [(*k, r.choice([None, "x", "y"]), r.choice([None, [], ["t"]]), r.choice([None, {"a": "1", "b": None}, {"a": "2"}])) for k in keys]


@pytest.mark.parametrize("seed", range(3))
def test_change_feed(spark, seed):
    one, two = snapshot(seed), snapshot(seed + 50)
    old, new = (spark.createDataFrame(x, ROWS).repartition(2) for x in (one, two))
    feed = changes.change_feed(old, new, ["k", "j"])
    a, b = ({x[:2]: x[2:] for x in s} for s in (one, two))
    names = ["name", "tags", "info"]
    want = {k: ("insert", []) for k in b.keys() - a.keys()} | {k: ("delete", []) for k in a.keys() - b.keys()}
    want |= {k: ("update", [n for n, x, y in zip(names, a[k], b[k], strict=True) if x != y]) for k in a.keys() & b.keys() if a[k] != b[k]}
    assert {(r.k, r.j): (r.op, r.changed) for r in feed.collect()} == want
    assert sorted(map(tuple, changes.apply_feed(old, feed, ["k", "j"]).collect()), key=str) == sorted(two, key=str)
    make = lambda rows: rows.where("name is not null").select("k", "j", F.upper("name").alias("d"))
    fresh = changes.refresh(make(old), feed, ["k", "j"], make, watched=["name"])
    assert sorted(map(tuple, fresh.collect()), key=str) == sorted(map(tuple, make(new).collect()), key=str)
    assert changes.change_feed(old, old, ["k", "j"]).count() == 0
    assert changes.change_feed(old.where("false"), new, ["k", "j"]).where("op = 'insert'").count() == len(two)


def test_split(spark):
    rows = spark.createDataFrame([(1, "a", "x", 1), (2, "b", "x", 1), (3, "c", "", None), (4, "d", None, None), (4, "d", None, None), (None, "e", None, 1)], "id int, name string, kind string, size int")
    own, other = changes.migrate_split(rows, ["id"], ["kind", "size"], "kind_id")
    assert own.columns == ["id", "name", "kind_id"] and own.count() == 6 and other.count() == 3
    assert own.where("kind_id is null").count() == 2
    back = changes.joined_back(own, other, "kind_id", rows.columns)
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, rows.collect()), key=str)
    # a planted loss, a row too many, and a value that went
    for wrong in (back.where("id <> 1 or id is null"), back.unionAll(rows.limit(1)), back.withColumn("size", F.when(F.col("id") != 2, F.col("size")))):
        with pytest.raises(changes.LostRows):
            changes.assert_same_rows(rows, wrong, "planted")
    with pytest.raises(ValueError):
        changes.split_table(rows, ["id"], ["id"], "kind_id")
    none = changes.migrate_split(rows.where("false"), ["id"], ["kind"], "kind_id")
    assert none[0].count() == none[1].count() == 0
