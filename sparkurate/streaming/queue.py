"""A review queue as a table of states, advanced in batches or by a stream of files.

One writer job owns the table (Spark has no row locks): a claim is a batch's own rows, and results carry the
id of the batch that asked for them, so that late ones are rejected.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# States, and which may follow which.
TRANSITIONS = {
    "received": ("processing", "failed"), "processing": ("verifying", "pending_human", "duplicate", "received", "failed"), "verifying": ("submitted", "verifying", "failed"),
    "submitted": ("decision_ready", "pending_human", "verifying", "failed"), "pending_human": ("decision_ready", "rejected"), "decision_ready": ("applying",),
    "applying": ("applied", "decision_ready", "failed"), "duplicate": (), "applied": (), "rejected": (), "failed": (),
}
TERMINAL = tuple(s for s, n in TRANSITIONS.items() if not n)


def claim(rows: DataFrame, source: str, target: str, n: int, now: Column) -> DataFrame:
    """The n oldest rows in a state, locked in the next one, with an attempt more."""
    oldest = rows.where(F.col("status") == source).orderBy("created_at", "id").limit(n)
    return oldest.withColumns({"status": F.lit(target), "locked_at": now, "attempt_count": F.col("attempt_count") + 1})


def fail(rows: DataFrame, errors: DataFrame, back_to: str, max_attempts: int = 3) -> DataFrame:
    """rows with errors(id, error): back to a state, or failed after so many attempts."""
    met = rows.join(errors.select("id", F.substring("error", 1, 2000).alias("_error")), "id", "left")
    hit, dead = F.col("_error").isNotNull(), F.col("attempt_count") >= max_attempts
    new = {"status": F.when(hit & dead, "failed").when(hit, back_to).otherwise(F.col("status")), "locked_at": F.when(~hit, F.col("locked_at")), "last_error": F.coalesce("_error", "last_error")}
    return met.withColumns(new).select(rows.columns)


def release_stale(rows: DataFrame, state: str, back_to: str, now: Column, minutes: int = 30, max_attempts: int = 3) -> DataFrame:
    """rows, those locked for longer than so many minutes released, or failed after so many attempts."""
    stale = F.coalesce((F.col("status") == state) & (F.col("locked_at") < now - F.make_dt_interval(mins=F.lit(minutes))), F.lit(False))
    return rows.withColumns({"status": F.when(stale & (F.col("attempt_count") >= max_attempts), "failed").when(stale, back_to).otherwise(F.col("status")), "locked_at": F.when(~stale, F.col("locked_at"))})


def finalize(rows: DataFrame, results: DataFrame) -> DataFrame:
    """rows with results(id, batch_id, status), one of each id and batch: only those of the batch that a row waits for, so a second delivery changes nothing."""
    met = rows.join(results.select("id", "batch_id", F.col("status").alias("_status"), F.lit(True).alias("_met")), ["id", "batch_id"], "left")
    ok = F.coalesce(F.col("_met") & (F.col("status") == "submitted"), F.lit(False))
    return met.withColumns({"status": F.when(ok, F.col("_status")).otherwise(F.col("status")), "batch_id": F.when(~ok, F.col("batch_id"))}).select(rows.columns)


def purge(rows: DataFrame, now: Column, days: int = 30, states: tuple[str, ...] = TERMINAL) -> DataFrame:
    """rows without finished ones older than so many days."""
    old = F.coalesce("processed_at", "updated_at") < now - F.make_dt_interval(days=F.lit(days))
    return rows.where(~(F.col("status").isin(*states) & F.coalesce(old, F.lit(False))))


def illegal_steps(log: DataFrame) -> DataFrame:
    """Steps of log(id, seq, status) that TRANSITIONS lacks."""
    steps = log.withColumn("before", F.lag("status").over(Window.partitionBy("id").orderBy("seq"))).where("before is not null")
    allowed = F.create_map(*[x for k, v in TRANSITIONS.items() for x in (F.lit(k), F.array(*map(F.lit, v)).cast("array<string>"))])
    return steps.where(~F.coalesce(F.array_contains(F.try_element_at(allowed, F.col("before")), F.col("status")), F.lit(False)))


def window_enqueue(rows: DataFrame, time: str, start: Column, end: Column) -> DataFrame:
    """Rows of a half-open time window."""
    return rows.where((F.col(time) >= start) & (F.col(time) < end))


def review_queue(rows: DataFrame, log: DataFrame, tokens: DataFrame) -> DataFrame:
    """Pending rows with their newest trigger and the number of tokens that wait: log(id, at, trigger), tokens(id, resolution)."""
    newest = log.where("trigger is not null").groupBy("id").agg(F.max_by("trigger", "at").alias("trigger"))
    waiting = tokens.groupBy("id").agg(F.count_if(F.col("resolution") == "pending_human").alias("n_waiting"))
    return rows.where("status = 'pending_human'").join(newest, "id", "left").join(waiting, "id", "left").fillna({"n_waiting": 0})


def run_ticks(spark: SparkSession, source: str, schema: str, checkpoint: str, step: Callable[[DataFrame, int], None], files_per_tick: int = 25) -> None:
    """Hand each batch of new files of a folder to step(rows, batch id), until all are read.

    The checkpoint keeps what has been read; step must take a batch id it has seen as done, as a batch is
    given again after a failure.
    """
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_tick).parquet(source)
    rows.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


#: The stages of a tick, in order.
TICK = ("poll", "intake", "submit", "apply", "describe", "purge")


def run_stages(tables: dict[str, DataFrame], stages: dict[str, Callable[[dict[str, DataFrame]], dict[str, DataFrame]]], only: str | None = None) -> dict[str, DataFrame]:
    """tables after the stages of a tick in their order, or after one; a stage gives the tables it changes."""
    unknown = {*stages, *([only] if only else [])} - set(TICK)
    if unknown:
        raise ValueError(f"unknown stages: {sorted(unknown)}")
    for name in TICK:
        if name in stages and only in (None, name):
            tables = tables | stages[name](tables)
    return tables


def poll(rows: DataFrame, batches: DataFrame, now: Column, deadline_minutes: int = 24 * 60, last_attempt: int = 2) -> DataFrame:
    """rows(id, status, batch_id, attempt_count, locked_at, ...) with `outcome` and `sync`, from batches(batch_id, state).

    Rows of a batch that has ended are ready for its results; those of one in progress wait until the
    deadline. A batch that failed, that nobody knows, or that is late is given up: its rows lose it
    and, after `last_attempt` attempts, are to be asked about one by one (sync). Nothing is kept between
    polls, so a poll that is broken off is simply run again.
    """
    met = rows.join(batches.select("batch_id", F.col("state").alias("_state")), "batch_id", "left")
    mine = F.col("status").isin("verifying", "submitted") & F.col("batch_id").isNotNull()
    late = F.coalesce(F.col("locked_at") < now - F.make_dt_interval(mins=F.lit(deadline_minutes)), F.lit(False))
    waits = F.coalesce(F.col("_state") == "in_progress", F.lit(False)) & ~late
    outcome = F.when(~mine, "idle").when(F.col("_state") == "ended", "ready").when(waits, "waiting").otherwise("failed")
    met = met.withColumn("outcome", outcome)
    gone = F.col("outcome") == "failed"
    met = met.withColumns({"sync": gone & (F.col("attempt_count") >= last_attempt), "batch_id": F.when(~gone, F.col("batch_id"))})
    return met.select(*rows.columns, "outcome", "sync")
