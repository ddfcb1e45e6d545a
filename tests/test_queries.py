"""Every query with SQL against the SQL, over whole tables; the others run and have rows."""

import math

import duckdb
import pytest

import __spark_entry__ as entry_points
from sparkurate.plans import queries, stage_queries  # noqa: F401

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con(sf_dir):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return c


def plain(v):
    v = float(v) if type(v).__name__ == "Decimal" else v
    return None if v is None or (isinstance(v, float) and math.isnan(v)) else round(v, 6) if isinstance(v, float) else v


@pytest.mark.parametrize("name", list(queries.QUERIES))
def test_query(spark, sf_dir, con, name):
    df = queries.QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    rows = sorted([tuple(plain(r[c]) for c in columns) for r in df.collect()], key=str)
    if name not in queries.SQL:
        assert rows
        return
    made = con.execute(queries.SQL[name])
    names = [d[0] for d in made.description]
    assert sorted(names) == columns
    assert rows == sorted([tuple(plain(x[names.index(c)]) for c in columns) for x in made.fetchall()], key=str)


def test_entry(spark):
    assert entry_points.entry(spark).columns == ["input", "product_id", "similarity"]
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())
