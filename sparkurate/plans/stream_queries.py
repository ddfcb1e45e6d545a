"""Streams over the events, each run to its end, with the SQL of what a batch finds."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..streaming import state
from .queries import query, read

_STATUS = "CASE event_type WHEN 'view' THEN 'received' WHEN 'click' THEN 'processing' WHEN 'purchase' THEN 'verifying' ELSE 'submitted' END"


def _stream(spark, d):
    """The events table as a stream; its files come in one batch or several."""
    path = f"{d}/events.parque[t]"  # a pattern may stand for a file or a folder
    return spark.readStream.schema(read(spark, d, "events").schema).parquet(path)


def _changes(spark, events):
    root = state.work_folder(spark, "queue")
    state.run_to_table(state.queue_changes(events), f"{root}/changes", f"{root}/checkpoint")
    return spark.read.schema(state.CHANGES).parquet(f"{root}/changes")


@query(
    f"""WITH s AS (SELECT user_id AS id, event_id AS seq, {_STATUS} AS status FROM events), l AS (SELECT *, lag(status) OVER (PARTITION BY id ORDER BY seq) AS before FROM s),
    k(a, b) AS (VALUES ('received', 'processing'), ('processing', 'verifying'), ('processing', 'received'), ('verifying', 'submitted'), ('verifying', 'verifying'), ('submitted', 'verifying')) SELECT id, seq, before, status FROM l WHERE before IS NOT NULL AND NOT EXISTS (SELECT 1 FROM k WHERE a = before AND b = status)"""
)
def stream_illegal_steps(spark, d):
    """What illegal_steps finds in the whole log, told as steps arrive."""
    events = _stream(spark, d).select(F.col("user_id").alias("id"), F.col("event_id").alias("seq"), F.col("ts").alias("at"), F.expr(_STATUS).alias("status"), F.lit(0).alias("attempt_count"), F.lit(None).cast("string").alias("error"))
    return _changes(spark, events).where("kind = 'illegal'").select("id", "seq", "before", "status")


@query(
    """WITH q AS (SELECT event_id AS id, ts, event_type, (value::INT % 5)::INT AS attempt_count FROM events), m AS (SELECT epoch_ms(max(ts)) AS now FROM events)
    SELECT id, CASE WHEN event_type = 'click' AND epoch_ms(ts) + 1800000 <= now THEN CASE WHEN attempt_count >= 3 THEN 'failed' ELSE 'received' END WHEN event_type = 'click' THEN 'verifying' WHEN event_type = 'error' THEN CASE WHEN attempt_count >= 3 THEN 'failed' ELSE 'received' END ELSE 'submitted' END AS status FROM q, m"""
)
def stream_released(spark, d):
    """Locks released by timers and failures sent back or given up: what stale_release and retry_dead_letter do to the rows at the newest event's time."""
    e = _stream(spark, d)
    tries = (F.bround("value").cast("int") % 5).cast("int")
    status = F.when(F.col("event_type") == "click", "verifying").otherwise("submitted")
    base = e.select(F.col("event_id").alias("id"), F.col("ts").alias("at"), "event_type", status.alias("status"), tries.alias("attempt_count"))
    step = F.struct(F.lit(0).cast("long").alias("seq"), F.lit(None).cast("string").alias("error"))
    failure = F.struct(F.lit(1).cast("long").alias("seq"), F.lit("no answer").alias("error"))
    steps = F.explode(F.when(F.col("event_type") == "error", F.array(step, failure)).otherwise(F.array(step)))
    events = base.select("id", "at", "status", "attempt_count", steps.alias("s")).select("id", "s.seq", "at", "status", "attempt_count", "s.error")
    return state.current_rows(_changes(spark, events)).select("id", "status")


@query(
    """WITH q AS (SELECT c_custkey AS id, 'b' || (c_custkey % 4) AS batch_id FROM customer), r AS (SELECT user_id AS id, 'b' || (event_id % 5) AS batch_id, min(event_id) AS seq FROM events GROUP BY 1, 2),
    m AS (SELECT q.id, event_type FROM q JOIN r USING (id, batch_id) JOIN events ON event_id = seq)
    SELECT q.id, CASE WHEN m.id IS NULL THEN 'submitted' WHEN event_type = 'error' THEN 'pending_human' ELSE 'decision_ready' END AS status, CASE WHEN m.id IS NULL THEN batch_id END AS batch_id FROM q LEFT JOIN m ON m.id = q.id"""
)
def stream_drained(spark, d):
    """Results that are delivered twice, late, and for other batches: each row takes the first one of the batch that it waits for."""
    first = read(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.lit("submitted").alias("status"), F.concat(F.lit("b"), (F.col("c_custkey") % 4).cast("string")).alias("batch_id"))
    status = F.when(F.col("event_type") == "error", "pending_human").otherwise("decision_ready")
    sent = _stream(spark, d).select(F.col("user_id").alias("id"), F.concat(F.lit("b"), (F.col("event_id") % 5).cast("string")).alias("batch_id"), status.alias("status"), F.col("event_id").alias("seq"), F.col("ts").alias("at"))
    twice = sent.withColumn("n", F.explode(F.array(F.lit(1), F.lit(2)))).drop("n")
    root = state.work_folder(spark, "drain")
    state.drain(twice, f"{root}/rows", first, f"{root}/checkpoint", delay="30 days")
    return state.newest_version(spark, f"{root}/rows", first)
