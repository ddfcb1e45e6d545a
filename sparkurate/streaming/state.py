"""The review queue as streams: keyed state with timers, and steps that may be given again.

`QueueState` keeps the last state of each row, by buckets of ids: an illegal step is told as it arrives, a failure sends a
row back or, after so many attempts, to the failed ones, and a timer releases a lock that nobody renews.
`drain` hands micro-batches to a step that makes version n of a table from version n - 1, so a batch that
is given again makes the same version again.
"""

from __future__ import annotations

import os
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.matching import first_by
from ..operators.scratch import work_folder
from .queue import TRANSITIONS, finalize

EVENTS = "id long, seq long, at timestamp, status string, attempt_count int, error string"
CHANGES = "id long, seq long, kind string, before string, status string, attempt_count int"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package when it was found through the driver's sys.path only."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *paths])


def _frame(changes: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame({c: pd.Series(v, dtype=object) for c, v in zip(("id", "seq", "kind", "before", "status", "attempt_count"), zip(*changes, strict=True), strict=True)})


class QueueState(StatefulProcessor):
    """Rows of CHANGES for the ids of a bucket: `step` (taken over), `illegal` (told, and remembered as logged), `retried`, `dead`, `released`.

    Steps of a batch are taken in the order of seq; a row that was there before, with a seq that isn't greater than the last one's, changes nothing.
    A step to `locked` sets a timer; another step takes it away. A bucket's states are read and written at once, as each call
    of the store takes far longer than a step; of its ids' timers only the next one is the store's, its alarm.
    """

    def __init__(self, locked: str = "verifying", back_to: str = "received", minutes: int = 30, max_attempts: int = 3, event_time: bool = True):
        self.locked, self.back_to, self.ms, self.max_attempts, self.event_time = locked, back_to, minutes * 60_000, max_attempts, event_time

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("bucket", "id array<long>, seq array<long>, status array<string>, attempt_count array<int>, timer array<long>, alarm long")

    def _given_up(self, attempts: int) -> str:
        return "failed" if attempts >= self.max_attempts else self.back_to

    def _read(self) -> tuple[dict, int | None]:
        """(seq, status, attempt_count, timer) by id, and the alarm."""
        got = self.state.get()
        if got is None:
            return {}, None
        *columns, alarm = got
        return {i: x for i, *x in zip(*columns, strict=True)}, alarm

    def _write(self, states: dict, alarm: int | None) -> None:
        """Write the states with an alarm for the first of their timers; alarm: what is set."""
        first = min((x[3] for x in states.values() if x[3] is not None), default=None)
        if first != alarm:
            if alarm is not None:
                self.handle.deleteTimer(alarm)
            if first is not None:
                self.handle.registerTimer(first)
        seq, status, attempts, timer = (list(c) for c in zip(*states.values(), strict=True))
        self.state.update((list(states), seq, status, attempts, timer, first))

    def handleInputRows(self, key, rows, timerValues):
        states, alarm = self._read()
        now = None if self.event_time else timerValues.getCurrentProcessingTimeInMs()
        got = pd.concat(list(rows))
        steps = zip(*[got[c].tolist() for c in ("no_seq", "seq", "no_id", "id", "status", "attempt_count", "failed", "ms")], strict=True)
        out = []
        for no_seq, at, no_id, i, to, tries, failed, ms in sorted(steps, key=lambda r: (not r[0], r[1])):
            i, at = None if no_id else i, None if no_seq else at
            seq, before, attempts, timer = states.get(i, (None, None, 0, None))
            if seq is not None and (at is None or at <= seq):
                continue
            if failed:
                status = self._given_up(attempts)
                kind = "dead" if status == "failed" else "retried"
            else:
                kind = "step" if before is None or to in TRANSITIONS.get(before, ()) else "illegal"
                status, attempts = to, int(tries) if tries == tries else None  # pandas has NaN for null
            timer = (int(ms) if self.event_time else now) + self.ms if status == self.locked and not failed else None
            states[i] = (at, status, attempts, timer)
            out.append((i, at, kind, before, status, attempts))
        if out:
            self._write(states, alarm)
            yield _frame(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        states, alarm = self._read()
        if alarm != expiredTimerInfo.getExpiryTimeInMs():
            return
        now = timerValues.getCurrentWatermarkInMs() if self.event_time else timerValues.getCurrentProcessingTimeInMs()
        out = []
        for i, (seq, before, attempts, timer) in states.items():
            if timer is not None and timer <= max(now, alarm):
                status = self._given_up(attempts)
                states[i] = (seq, status, attempts, None)
                out.append((i, seq, "released", before, status, attempts))
        self._write(states, None)  # an alarm that went off is gone
        if out:
            yield _frame(out)

    def close(self) -> None:
        pass


#: Ids are dealt out into so many buckets. A checkpoint goes on only with the number that it began with.
BUCKETS = 4096


def queue_changes(events: DataFrame, event_time: bool = True, delay: str = "0 seconds", **rules) -> DataFrame:
    """A stream of CHANGES from a stream of EVENTS; the session needs the RocksDB state store.

    Releases follow the watermark of `at`, or else the clock: then the query asks the clock for ever, so it
    wants a trigger by time and doesn't end by itself (run_to_table is for event time).
    """
    importable(events.sparkSession)
    rows = events.withColumn("at", F.col("at").cast("timestamp")).withColumns({"ms": F.unix_millis("at"), "bucket": F.pmod(F.xxhash64("id"), F.lit(BUCKETS))})
    rows = rows.withWatermark("at", delay) if event_time else rows
    known = [x for c in ("id", "seq") for x in (F.coalesce(c, F.lit(0)).alias(c), F.col(c).isNull().alias(f"no_{c}"))]  # pandas would make doubles of integers beside a null
    rows = rows.select("bucket", "at", *known, "status", "attempt_count", F.col("error").isNotNull().alias("failed"), "ms")
    return rows.groupBy("bucket").transformWithStateInPandas(QueueState(event_time=event_time, **rules), CHANGES, "Append", "EventTime" if event_time else "ProcessingTime")


def current_rows(changes: DataFrame) -> DataFrame:
    """(id, status, attempt_count) after all changes: a release comes after the step that it ends."""
    return first_by(changes.select("id", "status", "attempt_count", (-F.col("seq")).alias("s"), (F.col("kind") != "released").alias("k")), ["id"], [F.col("s"), F.col("k")]).select("id", "status", "attempt_count")


def run_to_table(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Append all that a stream has now to a Parquet table, once, wherever an earlier run was broken off."""
    spark = stream.sparkSession
    key, before = "spark.sql.streaming.stateStore.providerClass", spark.conf.get("spark.sql.streaming.stateStore.providerClass", None)
    spark.conf.set(key, ROCKS)
    try:
        stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start().awaitTermination()
    finally:
        spark.conf.set(key, before) if before else spark.conf.unset(key)


def version_step(path: str, apply: Callable[[DataFrame, DataFrame], DataFrame], first: DataFrame) -> Callable[[DataFrame, int], None]:
    """A step for foreachBatch: version n + 1 of the table at path is apply(version n, batch n); version 0 is first.

    A version is written before the batch counts as done. A batch that is given again overwrites its own
    version with the same rows, and versions before it stay as they are.
    """

    def step(batch: DataFrame, n: int) -> None:
        spark = batch.sparkSession
        rows = first if n == 0 else spark.read.schema(first.schema).parquet(f"{path}/version={n}")
        apply(rows, batch).select(first.columns).write.mode("overwrite").parquet(f"{path}/version={n + 1}")

    return step


def drain(results: DataFrame, path: str, first: DataFrame, checkpoint: str, time: str = "at", delay: str = "1 day") -> None:
    """Take a stream of results(id, batch_id, status, seq, at) into the rows of `first`, until none is left.

    Deliveries that are repeated within the delay are dropped as they come; of several for one row and
    batch the one with the least seq counts; those of a batch that a row doesn't wait for are refused.
    """
    unique = results.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, delay).dropDuplicatesWithinWatermark(["id", "batch_id", "seq"])
    one = lambda b: first_by(b.select("id", "batch_id", "seq", "status"), ["id", "batch_id"], [F.col("seq")])
    step = version_step(path, lambda rows, batch: finalize(rows, one(batch)), first)
    unique.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def newest_version(spark: SparkSession, path: str, first: DataFrame) -> DataFrame:
    """The table at path after the last batch; `first` if there was none."""
    fs = spark.sparkContext._jvm.org.apache.hadoop.fs
    found = fs.Path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(fs.Path(f"{path}/version=*/_SUCCESS"))
    versions = [int(str(f.getPath().getParent().getName()).partition("=")[2]) for f in found or []]
    return spark.read.schema(first.schema).parquet(f"{path}/version={max(versions)}") if versions else first
