"""The log of runs as a query: stages over the tables, their counters as Spark observed them, and the newest success of each."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..streaming.state import work_folder
from . import submissions
from .queries import query, read


@query(
    """WITH r(stage, status, rows_in, rows_ok) AS (SELECT 'orders', 'success', count(*), count(*) FILTER (WHERE o_totalprice > 1000) FROM orders UNION ALL SELECT 'orders', 'success', count(*), count(*) FILTER (WHERE o_totalprice > 200000) FROM orders
        UNION ALL SELECT 'events', 'success', count(*), count(*) FILTER (WHERE event_type <> 'error') FROM events UNION ALL SELECT 'events', 'failed', NULL, NULL UNION ALL SELECT 'part', 'failed', NULL, NULL)
    SELECT stage, status, rows_in, rows_ok, status = 'success' AND NOT (stage = 'orders' AND rows_ok = (SELECT max(rows_ok) FROM r WHERE stage = 'orders') AND rows_ok > (SELECT min(rows_ok) FROM r WHERE stage = 'orders')) AS newest FROM r"""
)
def run_log(spark, d):
    """Two runs of one stage, one that fails after a success, and one that never succeeds."""
    path = f"{work_folder(spark, 'runs')}/log"
    runs = [("orders", F.col("o_totalprice") > 1000), ("events", F.col("event_type") != "error"), ("orders", F.col("o_totalprice") > 200000), ("events", None), ("part", None)]
    for stage, good in runs:
        try:
            with submissions.recorded_run(spark, path, stage) as counters:
                if good is None:
                    raise RuntimeError("the source is away")
                rows, seen = submissions.counted(read(spark, d, stage), "rows", rows_in=F.count("*"), rows_ok=F.count_if(good))
                rows.write.format("noop").mode("overwrite").save()
                counters |= seen.get
        except RuntimeError as e:
            assert str(e) == "the source is away"
    log, newest = spark.read.schema(submissions.RUNS).parquet(path), submissions.last_success(spark, path)
    flagged = log.join(newest.select("run_id", F.lit(True).alias("n")), "run_id", "left")
    return flagged.select("stage", "status", F.col("counters")["rows_in"].alias("rows_in"), F.col("counters")["rows_ok"].alias("rows_ok"), F.coalesce("n", F.lit(False)).alias("newest"))
