"""Shared pieces: scratch tables in the shared folder, hashed counters, row ranks, Arrow helpers."""

from __future__ import annotations

import ctypes
import gc
import os
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

U64 = np.uint64


# --------------------------------------------------------------------------- session and scratch tables


BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def prepare(spark: SparkSession) -> None:
    """Let Python workers import this package when it was found through the driver's sys.path only.

    Batches for Python are bounded by bytes, as texts are; a bound that isn't Spark's own default stays.
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *paths])
    if spark.conf.get(BATCH) == "67108864b":
        spark.conf.set(BATCH, "8m")


class Scratch:
    """Intermediate tables as Parquet in the folder that spark.checkpoint.dir names.

    A written table cuts the lineage and survives lost executors. On a single machine a temporary
    folder serves where the setting is absent; executors of a cluster have no folder in common without it.
    """

    def __init__(self, spark: SparkSession, label: str):
        prepare(spark)
        self.spark = spark
        base = spark.conf.get("spark.checkpoint.dir", None)
        if not base:
            if not spark.sparkContext.master.startswith("local"):
                raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
            base = "file://" + tempfile.gettempdir()
        self.root = f"{base.rstrip('/')}/sparkurate/{label}-{uuid.uuid4().hex[:12]}"

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        """Write df, and return the written table."""
        schema = df.schema
        df.write.mode("overwrite").option("compression", "zstd").parquet(self.path(name))
        return self.spark.read.schema(schema).parquet(self.path(name))

    def drop(self, name: str) -> None:
        """Delete a table that no later step reads."""
        jvm = self.spark.sparkContext._jvm
        where = jvm.org.apache.hadoop.fs.Path(self.path(name))
        where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def release_shuffles(spark: SparkSession) -> None:
    """Collect the driver's garbage, so that Spark deletes shuffle files that no plan refers to."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def parallelism(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


# --------------------------------------------------------------------------- hashing


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: spreads the entropy of every input bit over all output bits."""
    x = x ^ (x >> U64(33))
    x = x * U64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> U64(33))
    x = x * U64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U64(33))


def constants(n: int, seed: int) -> np.ndarray:
    """n odd 64-bit multipliers."""
    return np.random.default_rng(seed).integers(0, 2**63, n, dtype=np.uint64) * U64(2) + U64(1)


_claimed: list = []


def claim(cache) -> None:
    """A Python worker serves many operators: the cache in use (anything with clear()) is the only one that is filled."""
    if _claimed and _claimed[0] is cache:
        return
    for other in _claimed:
        other.clear()
    _claimed[:] = [cache]
    give_back()


def give_back() -> None:
    """Return freed memory to the system: a worker lives on after its task, and others need it."""
    pa.default_memory_pool().release_unused()
    if hasattr(_libc, "malloc_trim"):
        _libc.malloc_trim(0)


_libc = ctypes.CDLL(None)


def arrow_map(df: DataFrame, f: Callable, schema) -> DataFrame:
    """df.mapInArrow(f, schema), with batches bounded by bytes and memory given back when a task ends."""
    prepare(df.sparkSession)

    def run(batches):
        yield from f(batches)
        give_back()

    return df.mapInArrow(run, schema)


class WordHash(dict):
    """64-bit hashes of words, remembered for the first `limit` distinct ones."""

    limit = 150_000

    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh3_64_intdigest(word)
        if len(self) < self.limit:
            self[word] = h
        return h


_words = WordHash()


def word_hashes(text: bytes) -> np.ndarray:
    """Hashes of the words [^\\x20\\x09-\\x0D]+ of a text with A-Z in lower case, in order."""
    claim(_words)
    words = text.lower().split()
    return np.fromiter(map(_words.__getitem__, words), dtype=np.uint64, count=len(words))


def shingle_set(text: bytes | None, n: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the n-word shingles; fewer words: the whole sequence as one; none: empty."""
    if not text:
        return np.empty(0, np.uint64)
    w = word_hashes(text)
    if not len(w):
        return w
    k = min(n, len(w))
    c = constants(n + 1, 11)
    s = np.full(len(w) - k + 1, c[n] * U64(k) if k < n else c[n], dtype=np.uint64)
    for i in range(k):
        s += w[i : len(w) - k + 1 + i] * c[i]
    return np.unique(mix(s))


# --------------------------------------------------------------------------- Arrow


def binary_rows(column: pa.Array) -> list:
    """Values of a string column as UTF-8 bytes (None: null)."""
    return column.cast(pa.binary() if not pa.types.is_large_string(column.type) else pa.large_binary()).to_pylist()


def batch(schema: pa.Schema, columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


# --------------------------------------------------------------------------- bounded hashed counters


def emit_counters(counts: np.ndarray, block: int = 1 << 14) -> Iterator[tuple[int, bytes]]:
    """Blocks of a counter array that hold anything, as (block number, 32-bit counters)."""
    for b in range(len(counts) // block):
        part = counts[b * block : (b + 1) * block]
        if part.any():
            yield b, part.astype("<u4").tobytes()


def sum_counters(df: DataFrame, bits: int, block: int = 1 << 14) -> np.ndarray:
    """Sum of counter blocks (block int, counts binary) as an array of 2**bits counters.

    Each task adds up its blocks as a stream, so it holds its own blocks only; the driver gets the
    2**bits counters, whatever the number of rows.
    """
    n = max(1, (1 << bits) // block)
    out = pa.schema([("block", pa.int32()), ("counts", pa.binary())])

    def add(batches):
        total: dict[int, np.ndarray] = {}
        for b in batches:
            for k, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                part = np.frombuffer(v, "<u4").astype(np.uint64)
                total[k] = total[k] + part if k in total else part
        if total:
            yield batch(out, [list(total), [np.minimum(v, 2**32 - 1).astype("<u4").tobytes() for v in total.values()]])

    counts = np.zeros(n * block, np.uint64)
    for row in df.select("block", "counts").repartition(min(n, 16), "block").transform(arrow_map, add, "block int, counts binary").collect():
        counts[row.block * block : (row.block + 1) * block] += np.frombuffer(row.counts, "<u4").astype(np.uint64)
    return counts


ID_BITS = 24


def id_slots(ids: np.ndarray, bits: int = ID_BITS) -> np.ndarray:
    return (mix(ids.astype(np.int64).view(np.uint64) + U64(0x9E3779B97F4A7C15)) >> U64(64 - bits)).astype(np.int64)


def id_bitmap(ids: DataFrame, bits: int = ID_BITS) -> np.ndarray:
    """A map of 2**bits bits with the hash of each id (first column, long) set.

    It has false positives, never false negatives, and a fixed size: it thins out what is shuffled
    into a join on the id, and the join decides. When it fills up, the join alone does the work.
    """
    out = pa.schema([("block", pa.int32()), ("bits", pa.binary())])
    size = 1 << bits

    def fill(batches):
        seen = np.zeros(size, np.bool_)
        for b in batches:
            c = b.column(0)
            seen[id_slots(c.filter(c.is_valid()).to_numpy(zero_copy_only=False))] = True
        for k in range(64):
            part = seen[k * (size // 64) : (k + 1) * (size // 64)]
            if part.any():
                yield batch(out, [[k], [np.packbits(part).tobytes()]])

    def join(batches):
        total: dict[int, np.ndarray] = {}
        for b in batches:
            for k, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                part = np.frombuffer(v, np.uint8)
                total[k] = total[k] | part if k in total else part
        if total:
            yield batch(out, [list(total), [v.tobytes() for v in total.values()]])

    bitmap = np.zeros(size // 8, np.uint8)
    step = size // 8 // 64
    made = ids.transform(arrow_map, fill, "block int, bits binary").repartition(16, "block").transform(arrow_map, join, "block int, bits binary")
    for row in made.collect():
        bitmap[row.block * step : (row.block + 1) * step] |= np.frombuffer(row.bits, np.uint8)
    return bitmap


def in_bitmap(bitmap: np.ndarray, ids: np.ndarray, bits: int = ID_BITS) -> np.ndarray:
    s = id_slots(ids, bits)
    return (bitmap[s >> 3] >> (7 - (s & 7)).astype(np.uint8)) & 1 == 1


def only_ids(df: DataFrame, bitmap: np.ndarray, id_col: str = "doc_id") -> DataFrame:
    """Rows whose id may be in the bitmap."""
    shared = df.sparkSession.sparkContext.broadcast(bitmap)

    def pick(batches):
        for b in batches:
            c = b.column(b.schema.get_field_index(id_col))
            ids = c.fill_null(0).to_numpy(zero_copy_only=False)
            mask = in_bitmap(shared.value, ids) & c.is_valid().to_numpy(zero_copy_only=False)
            if mask.any():
                yield b.filter(pa.array(mask))

    return df.transform(arrow_map, pick, df.schema)


# --------------------------------------------------------------------------- ranks and prefix sums


def range_sorted(df: DataFrame, order: list[Column], scratch: Scratch, name: str, within: list[Column] | None = None) -> DataFrame:
    """df dealt out in ranges of `order`, with the range's number as `_range`, written once so that it stays put.

    Later steps need only local windows in a range, and one row per range (and group) for what precedes it.
    """
    n = parallelism(df.sparkSession)
    return scratch.keep(df.repartitionByRange(n, *order).withColumn("_range", F.spark_partition_id()), name)


def prefix_sums(df: DataFrame, order: list[Column], sums: dict[str, Column], scratch: Scratch, name: str, group: list[str] | None = None) -> DataFrame:
    """Exclusive prefix sums in `order`, within `group` (its columns must lead the order): column name -> expression.

    Range partitioning on the whole order splits a group of any size over many tasks. Each range sums
    locally; the totals, one row per range and group in it, are added up and joined back.
    """
    group = group or []
    ranged = range_sorted(df, order, scratch, name)
    null_safe = [F.coalesce(F.col(g).cast("string"), F.lit("")) for g in group] + [F.col(g).isNull() for g in group]
    key = F.xxhash64(*null_safe) if group else F.lit(0).cast("long")
    ranged = ranged.withColumn("_group", key)
    totals = ranged.groupBy("_range", "_group").agg(*[F.sum(e).alias(f"_{c}") for c, e in sums.items()])
    before = Window.partitionBy("_group").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_range", "_group", *[F.coalesce(F.sum(f"_{c}").over(before), F.lit(0)).cast("long").alias(f"_{c}") for c in sums])
    local = Window.partitionBy("_range", "_group").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    out = ranged.select("*", *[F.coalesce(F.sum(e).over(local), F.lit(0)).cast("long").alias(f"_local_{c}") for c, e in sums.items()])
    out = out.join(offsets, ["_range", "_group"])
    keep = [c for c in df.columns if c not in sums]
    return out.select(*keep, *[(F.col(f"_local_{c}") + F.col(f"_{c}")).alias(c) for c in sums])


# --------------------------------------------------------------------------- connected components


def _forest(batches):
    """Edges of one task, reduced to a spanning forest of stars; memory: the task's own vertices."""
    parent: dict[int, int] = {}

    def root(x):
        top = x
        while (p := parent.get(top, top)) != top:
            top = p
        while (p := parent.get(x, x)) != top:
            parent[x] = top
            x = p
        return top

    for b in batches:
        for u, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            a, c = root(u), root(v)
            parent.setdefault(u, u)
            parent.setdefault(v, v)
            if a != c:
                lo, hi = (a, c) if a < c else (c, a)
                parent[hi] = lo
    out = pa.schema([("u", pa.int64()), ("v", pa.int64())])
    pairs = [(x, r) for x in list(parent) if (r := root(x)) != x]
    if pairs:
        yield batch(out, [list(x) for x in zip(*pairs, strict=True)])


def components(edges: DataFrame, scratch: Scratch, name: str = "cc") -> DataFrame:
    """(node, component): the smallest id reachable, for every node of an edge; edges: two long columns.

    Alternates large-star and small-star steps on tables in the shared folder until all nodes hang on
    their root, after each task has reduced its own edges to stars. In every table u > v, so a large
    step needs only the least smaller neighbor of each v, and a root has none. That table is written:
    a root of very many nodes is then a key of one side only, which Spark may split when it joins.
    """
    spark = edges.sparkSession
    u, v = edges.columns[:2]
    schema = "u long, v long"
    e = edges.select(F.col(u).cast("long").alias("u"), F.col(v).cast("long").alias("v")).where("u is not null and v is not null and u <> v")
    e = scratch.keep(e.transform(arrow_map, _forest, schema), f"{name}0")
    last = None
    for step in range(1, 60):
        least = scratch.keep(e.groupBy(F.col("u").alias("v")).agg(F.min("v").alias("m")), f"{name}least{step}")
        large = e.join(least, "v", "left").select("u", F.coalesce("m", "v").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        small = small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(small.select("u", F.col("m").alias("v"))).distinct()
        e = scratch.keep(small, f"{name}{step}")
        now = tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % 1_000_003), F.sum("v")).first())
        scratch.drop(f"{name}least{step}")
        release_shuffles(spark)
        if step > 1:
            scratch.drop(f"{name}{step - 2}")
        if now == last:
            break
        last = now
    else:
        raise RuntimeError("components did not converge")
    nodes = e.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component"))
    roots = e.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return nodes.unionByName(roots)
