"""Streams with state over small files, broken off and started again."""

from datetime import datetime, timedelta

import pandas as pd

from sparkurate.streaming import queue, state

T0 = datetime(2026, 1, 1)
DONE = "id long, status string, batch_id string"
RESULTS = "id long, batch_id string, status string, seq long, at timestamp"


def at(minutes):
    return T0 + timedelta(minutes=minutes)


def changes(spark, path):
    stream = spark.readStream.schema(state.EVENTS).option("maxFilesPerTrigger", 1).parquet(f"{path}/in")
    state.run_to_table(state.queue_changes(stream), f"{path}/out", f"{path}/checkpoint")
    return spark.read.schema(state.CHANGES).parquet(f"{path}/out")


def test_state_survives_a_restart(spark, tmp_path):
    path = f"file://{tmp_path}"

    def add(*rows):
        spark.createDataFrame(rows, state.EVENTS).coalesce(1).write.mode("append").parquet(f"{path}/in")

    add((1, 1, at(0), "received", 0, None), (1, 2, at(1), "processing", 1, None), (1, 3, at(2), "verifying", 1, None), (2, 1, at(0), "received", 0, None), (2, 2, at(1), "applied", 0, None), (3, 1, at(3), "verifying", 3, None), (4, 1, at(4), "verifying", 1, None), (None, 1, at(4), "received", 0, None))
    changes(spark, path)
    # a step again, a failure, a step that takes the lock away, and time for the others
    add((1, 3, at(5), "verifying", 1, None), (4, 2, at(6), "submitted", 1, None), (2, 3, at(6), "received", 2, "no answer"), (2, 4, at(7), "received", 3, None), (2, 5, at(8), "received", 3, "again"), (9, 1, at(60), "received", 0, None))
    got = {(r.id, r.seq, r.kind, r.before, r.status) for r in changes(spark, path).collect()}
    assert got == {
        (1, 1, "step", None, "received"), (1, 2, "step", "received", "processing"), (1, 3, "step", "processing", "verifying"), (1, 3, "released", "verifying", "received"),
        (2, 1, "step", None, "received"), (2, 2, "illegal", "received", "applied"), (2, 3, "retried", "applied", "received"), (2, 4, "illegal", "received", "received"), (2, 5, "dead", "received", "failed"),
        (3, 1, "step", None, "verifying"), (3, 1, "released", "verifying", "failed"), (4, 1, "step", None, "verifying"), (4, 2, "step", "verifying", "submitted"), (None, 1, "step", None, "received"), (9, 1, "step", None, "received"),
    }
    now = {r.id: r.status for r in state.current_rows(changes(spark, path)).collect()}
    assert now == {1: "received", 2: "failed", 3: "failed", 4: "submitted", 9: "received", None: "received"}


def test_state_of_one_bucket(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(state, "BUCKETS", 1)
    test_state_survives_a_restart(spark, tmp_path)


class Store:
    """A bucket's state and timers, with the number of calls."""

    def __init__(self):
        self.value, self.timers, self.calls = None, set(), 0

    def __getattr__(self, name):
        def call(x=None):
            self.calls += 1
            if name == "update":
                self.value = x
            elif name == "registerTimer":
                self.timers.add(x)
            elif name == "deleteTimer":
                self.timers.remove(x)
            return self.value

        return call

    def getValueState(self, name, schema):
        return self

    def getCurrentWatermarkInMs(self):
        return self.now

    def getExpiryTimeInMs(self):
        return min(self.timers)


def test_calls_of_the_store_are_few_for_many_ids():
    store, q = Store(), state.QueueState()
    q.init(store)
    steps = lambda *rows: iter([pd.DataFrame(rows, columns="id no_id seq no_seq ms status attempt_count failed".split())])
    told = lambda frames: list(pd.concat(frames).itertuples())
    rows = steps(*[(i, False, 0, False, 1000 * i, "verifying", i % 5, False) for i in range(900)])
    assert len(told(q.handleInputRows((7,), rows, store))) == 900 and store.timers == {1_800_000} and store.calls <= 4
    again = steps((0, False, 1, False, 0, "submitted", 0, False), (0, False, 0, False, 0, "verifying", 0, False))
    assert [(r.kind, r.before, r.status) for r in told(q.handleInputRows((7,), again, store))] == [("step", "verifying", "submitted")] and store.timers == {1_801_000}
    store.now, store.calls = 1_802_500, 0
    gone = told(q.handleExpiredTimer((7,), store, store))
    store.timers.remove(1_801_000)  # as Spark does when an alarm has gone off
    assert [(r.id, r.seq, r.kind, r.status) for r in gone] == [(1, 0, "released", "received"), (2, 0, "released", "received")] and store.timers == {1_803_000} and store.calls <= 4
    store.now = 1_803_000
    assert [(r.id, r.status) for r in told(q.handleExpiredTimer((7,), store, store))] == [(3, "failed")] and 1_804_000 in store.timers


def test_a_batch_given_again_changes_nothing(spark, tmp_path):
    path = f"file://{tmp_path}/rows"
    first = spark.createDataFrame([(1, "submitted", "b1"), (2, "submitted", "b2"), (3, "applied", "b3"), (None, "submitted", None)], DONE)
    batch = spark.createDataFrame([(1, "b1", "decision_ready"), (2, "b1", "decision_ready"), (3, "b3", "failed")], "id long, batch_id string, status string")
    step = state.version_step(path, queue.finalize, first)
    step(batch, 0)
    step(batch.where("false"), 1)
    want = [(None, "submitted", None), (1, "decision_ready", None), (2, "submitted", "b2"), (3, "applied", "b3")]
    for _ in range(2):
        assert sorted(map(tuple, state.newest_version(spark, path, first).collect()), key=str) == sorted(want, key=str)
        step(batch, 1)
    assert state.newest_version(spark, f"file://{tmp_path}/none", first).count() == 4


def test_drain_in_two_runs(spark, tmp_path):
    path = f"file://{tmp_path}"
    first = spark.createDataFrame([(i, "submitted", f"b{i % 2}") for i in range(4)], DONE)

    def run(*rows):
        spark.createDataFrame(rows, RESULTS).coalesce(1).write.mode("append").parquet(f"{path}/in")
        stream = spark.readStream.schema(RESULTS).option("maxFilesPerTrigger", 1).parquet(f"{path}/in")
        state.drain(stream, f"{path}/rows", first, f"{path}/checkpoint")
        return {r.id: (r.status, r.batch_id) for r in state.newest_version(spark, f"{path}/rows", first).collect()}

    one = run((0, "b0", "decision_ready", 1, at(0)), (0, "b0", "decision_ready", 1, at(0)), (1, "b0", "failed", 2, at(1)), (2, "b0", "failed", 4, at(1)), (2, "b0", "decision_ready", 3, at(2)))
    assert one == {0: ("decision_ready", None), 1: ("submitted", "b1"), 2: ("decision_ready", None), 3: ("submitted", "b1")}
    # delivered again, later ones for a row that is done, and the one that was waited for
    two = run((0, "b0", "failed", 1, at(3)), (2, "b0", "failed", 9, at(4)), (1, "b1", "decision_ready", 10, at(5)))
    assert two == one | {1: ("decision_ready", None)}
    assert two == run((3, None, "failed", 11, at(6)))
