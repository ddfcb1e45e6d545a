"""Embedding near-dedup by PCA-ordered tiled comparison.

Equal vectors are one representative with a count first. Representatives are rotated to the principal
axes of a bounded sample (any rotation gives the same cosines; this one puts most of each product in
the leading coordinates), sorted along the first axis and cut into blocks. Blocks are dealt out once, and
each pair of parts is a task (a Cartesian product of partitions, so that blocks aren't copied for every
block they meet: disk stays in proportion to the input). Blocks too far apart along the first axis for
any pair to reach the threshold never meet. In a tile of two blocks the products of the leading
coordinates come first; what the others can add is at most the product of the two suffix norms. Pairs
whose bound reaches the threshold go on with the next coordinates, a step at a time, and stop as soon as
what is accumulated and the bound of the rest can't reach it. The few that are left are computed in
double precision from the vectors as they are.

A task gives counts and a spanning forest of its links, so what it gives is bounded by its vectors; links
are not listed. All pairs of blocks that the bounds leave are compared, so no link is lost. The work of
the first products is quadratic in the number of different vectors.

Vectors of each dimension are compared with each other. Those that are null, empty, zero, or hold null
or non-finite components have no links: component and kept are their own. Rows that repeat an id count as one node in
components; null ids have a null component and are kept.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, arrow_map, batch, components, release_shuffles

BLOCK, TILE = 1 << 20, 1024  # bytes of a block at most, vectors in a side of a tile
PART, PARTS = 32, 6  # blocks in a part at most, parts at least
SLACK = 1e-4  # of products in single precision


def axes(sample: np.ndarray) -> np.ndarray:
    """Principal axes of unit vectors, the widest first, as columns."""
    values, vectors = np.linalg.eigh(np.cov(sample.T) if len(sample) > 1 else np.eye(sample.shape[1]))
    return vectors[:, ::-1]


def tile_links(a: dict, b: dict, same: bool, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Indices of linked pairs of two blocks; below the diagonal only if they are the same."""
    lead = a["turned"].shape[1] // a["rest"].shape[1]  # coordinates of a step
    first = lambda v: np.concatenate([v["turned"][:, :lead], v["rest"][:, :1]], 1)  # noqa: E731  the product of suffix norms is the last coordinate's
    bound = first(a) @ first(b).T
    x, y = np.nonzero(bound >= threshold - SLACK)
    if same:
        on = x > y
        x, y = x[on], y[on]
    so_far = bound[x, y] - a["rest"][x, 0] * b["rest"][y, 0]
    for k in range(1, a["rest"].shape[1]):
        if not len(x):
            return x, y
        part = slice(k * lead, (k + 1) * lead)
        so_far += np.einsum("ij,ij->i", a["turned"][x, part], b["turned"][y, part])
        on = so_far + a["rest"][x, k] * b["rest"][y, k] >= threshold - SLACK
        x, y, so_far = x[on], y[on], so_far[on]
    if not len(x):
        return x, y
    keep = []
    for s in range(0, len(x), 1 << 16):
        p, q = x[s : s + (1 << 16)], y[s : s + (1 << 16)]
        cosine = np.einsum("ij,ij->i", a["full"][p], b["full"][q]) / (a["norm"][p] * b["norm"][q])
        keep.append(cosine >= threshold)
    keep = np.concatenate(keep)
    return x[keep], y[keep]


def forest(n: int, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The smallest index that each of n nodes is connected with."""
    label = np.arange(n)
    while True:
        old = label.copy()
        np.minimum.at(label, x, old[y])
        np.minimum.at(label, y, label[x])
        label = label[label]
        if (label == old).all():
            return label


def turned(full: np.ndarray, basis: np.ndarray, lead: int) -> dict:
    """Vectors as double precision between -1 and 1, their norms, coordinates along the axes, and norms of what follows each step of these."""
    full = full.astype(np.float64)
    full /= np.abs(full).max(1)[:, None]  # no overflow, and the cosine is the same
    norm = np.sqrt((full * full).sum(1))
    r = full @ basis / norm[:, None]
    steps = -(-full.shape[1] // lead)
    r = np.concatenate([r, np.zeros((len(r), steps * lead - full.shape[1]))], 1)
    squares = np.cumsum((r * r).reshape(len(r), steps, lead).sum(2), axis=1)
    return {"full": full, "norm": norm, "turned": r.astype(np.float32), "rest": np.sqrt(np.maximum(0, 1 - squares)).astype(np.float32), "first": r[:, 0]}


def tiles(block: dict) -> list[dict]:
    return [{k: v[s : s + TILE] for k, v in block.items()} for s in range(0, len(block["ids"]), TILE)]


class TaskLinks:
    """Counts and a spanning forest of links by id, as rows (u, v, n); memory: in proportion to the ids that have links."""

    def __init__(self, limit: int = 1 << 20):
        self.parts, self.size, self.limit = [], 0, limit

    def add(self, u: np.ndarray, v: np.ndarray, n: np.ndarray) -> None:
        self.parts.append((u, v, n))
        self.size += len(u)
        if self.size > self.limit:
            self.parts = [self.rows()]
            self.size = len(self.parts[0][0])
            self.limit = max(self.limit, 2 * self.size)

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if not self.parts:
            return (np.empty(0, np.int64),) * 3
        u, v, n = (np.concatenate(c) for c in zip(*self.parts, strict=True))
        ids, at = np.unique(np.concatenate([u, v]), return_inverse=True)
        total = np.zeros(len(ids), np.int64)
        np.add.at(total, at[: len(u)], n)
        return ids, ids[forest(len(ids), at[: len(u)], at[len(u) :])], total


def near_duplicates(vectors: DataFrame, threshold: float = 0.9, id_col: str = "vec_id", vector_col: str = "embedding", leading: int = 16, sample: int = 20_000) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of each row."""
    spark = vectors.sparkSession
    scratch = Scratch(spark, "embeddings")
    single = dict(vectors.dtypes)[vector_col] == "array<float>"
    kind = np.float32 if single else np.float64
    v = F.col(vector_col) if single else F.col(vector_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v"))
    sound = F.coalesce(F.size("v") > 0, F.lit(False)) & F.coalesce(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))
    sound = sound & F.coalesce(F.exists("v", lambda x: x != 0), F.lit(False)) & F.col("vec_id").isNotNull()
    h, g = F.xxhash64(F.col("v").cast("array<double>")), F.xxhash64(F.lit(5), F.col("v").cast("array<double>"))
    dims = [r.d for r in rows.where(sound).groupBy(F.size("v").alias("d")).count().where("count > 1").orderBy("d").collect()]
    if not dims:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    keyed = scratch.keep(rows.select("vec_id", sound.alias("sound"), F.when(sound, h).alias("h"), F.when(sound, g).alias("g"), F.size("v").alias("d")), "keys")
    classes = scratch.keep(keyed.where("sound").groupBy("h", "g", "d").agg(F.min("vec_id").alias("rep"), F.count("*").alias("m")), "classes")

    def links_of(dim: int) -> DataFrame:
        """Links of the vectors of one dimension."""
        lead = min(leading, dim)
        size = max(1, BLOCK // (dim * np.dtype(kind).itemsize))  # vectors in a block
        here = sound & (F.size("v") == dim)
        reps = rows.where(here).withColumns({"h": h, "g": g}).join(classes.where(F.col("d") == dim).drop("d"), ["h", "g"]).where("vec_id = rep").dropDuplicates(["h", "g"]).select("vec_id", "m", "v")

        taken = rows.where(here).select("v").orderBy(h).limit(sample).toArrow()
        flat = np.array(taken.column(0).combine_chunks().flatten()).reshape(-1, dim).astype(np.float64)
        flat = flat / np.abs(flat).max(1, keepdims=True)
        basis = axes(flat / np.sqrt((flat * flat).sum(1, keepdims=True)))
        shared = spark.sparkContext.broadcast(basis)
        n = classes.where(F.col("d") == dim).count()
        release_shuffles(spark)

        firsts = pa.schema([("vec_id", pa.int64()), ("m", pa.int64()), ("first", pa.float64()), ("full", pa.binary())])

        def turn(batches):
            for b in batches:
                if not b.num_rows:
                    continue
                full = np.asarray(b.column(2).flatten()).reshape(-1, dim)
                yield batch(firsts, [b.column(0), b.column(1), turned(full, shared.value, lead)["first"], [x.tobytes() for x in full]])

        placed = reps.transform(arrow_map, turn, "vec_id long, m long, first double, full binary")
        placed = placed.repartitionByRange(max(1, -(-n // (4 * size))), "first", "vec_id").sortWithinPartitions("first", "vec_id")
        block = pa.schema([("block", pa.int64()), ("low", pa.float64()), ("high", pa.float64()), ("ids", pa.binary()), ("m", pa.binary()), ("full", pa.binary())])

        def cut(batches):
            from pyspark import TaskContext

            held, k = None, TaskContext.get().partitionId() << 24

            def made(x, k):
                first = x.column("first").to_numpy()
                ids, m = (x.column(c).to_numpy().tobytes() for c in ("vec_id", "m"))
                return batch(block, [[k], [float(first.min())], [float(first.max())], [ids], [m], [b"".join(x.column("full").to_pylist())]])

            for b in batches:
                held = pa.Table.from_batches([b]) if held is None else pa.concat_tables([held, pa.Table.from_batches([b])])
                while held.num_rows >= size:
                    yield made(held.slice(0, size), k)
                    held, k = held.slice(size), k + 1
            if held is not None and held.num_rows:
                yield made(held, k)

        blocks = scratch.keep(placed.transform(arrow_map, cut, "block long, low double, high double, ids binary, m binary, full binary"), f"blocks{dim}")
        release_shuffles(spark)

        # Each pair of parts is a task, which reads both where they were dealt out.
        reach = float(np.sqrt(max(0.0, 2 - 2 * threshold))) + SLACK
        k = -(-n // size)
        dealt = blocks.repartition(max(-(-k // PART), min(k, PARTS)))
        one, two = (dealt.select([F.col(c).alias(f"{side}_{c}") for c in dealt.columns]) for side in "ab")
        meet = one.hint("shuffle_replicate_nl").join(two, (F.col("a_block") <= F.col("b_block")) & (F.col("a_low") <= F.col("b_high") + reach) & (F.col("b_low") <= F.col("a_high") + reach))
        meet = meet.select("a_block", "a_ids", "a_m", "a_full", "b_block", "b_ids", "b_m", "b_full")
        linked = pa.schema([("u", pa.int64()), ("v", pa.int64()), ("n", pa.int64())])

        def compare(batches):
            links, ready = TaskLinks(), {}

            def read(row, side):
                key = row[f"{side}_block"]
                if key not in ready:
                    if len(ready) >= 16:
                        ready.pop(next(iter(ready)))
                    made = turned(np.frombuffer(row[f"{side}_full"], kind).reshape(-1, dim), shared.value, lead)
                    ready[key] = tiles(made | {"ids": np.frombuffer(row[f"{side}_ids"], np.int64), "m": np.frombuffer(row[f"{side}_m"], np.int64)})
                return ready[key]

            for batch_ in batches:
                for i in range(batch_.num_rows):
                    row = {c: batch_.column(c)[i].as_py() for c in ("a_block", "b_block")}
                    row |= {c: batch_.column(c)[i].as_buffer() for c in batch_.schema.names if c not in row}
                    same = row["a_block"] == row["b_block"]
                    sides = read(row, "a"), read(row, "b")
                    for p, a in enumerate(sides[0]):
                        for q, b in enumerate(sides[1]):
                            if (same and p < q) or a["first"][0] > b["first"][-1] + reach or b["first"][0] > a["first"][-1] + reach:
                                continue
                            x, y = tile_links(a, b, same and p == q, threshold)
                            if not len(x):
                                continue
                            ids, m = (a[c] if same and p == q else np.concatenate([a[c], b[c]]) for c in ("ids", "m"))
                            y = y if same and p == q else y + len(a["ids"])
                            total = np.bincount(x, weights=m[y], minlength=len(ids)) + np.bincount(y, weights=m[x], minlength=len(ids))
                            on = np.flatnonzero(total)
                            # stars around the smallest index; components() takes them to the smallest id
                            links.add(ids[on], ids[forest(len(ids), x, y)[on]], total[on].astype(np.int64))
            u, v, total = links.rows()
            if len(u):
                yield batch(linked, [u, v, total])

        found = scratch.keep(meet.transform(arrow_map, compare, "u long, v long, n long"), f"links{dim}")
        scratch.drop(f"blocks{dim}")
        release_shuffles(spark)
        return found

    found = functools.reduce(DataFrame.unionByName, [links_of(dim) for dim in dims])
    nodes = components(found.select("u", "v"), scratch)
    counts = found.groupBy(F.col("u").alias("rep")).agg(F.sum("n").alias("n"))
    of = classes.join(counts, "rep", "left").join(nodes.withColumnRenamed("node", "rep"), "rep", "left")
    out = keyed.join(of.select("h", "g", "rep", "m", "n", "component"), ["h", "g"], "left")
    component = F.when(F.col("vec_id").isNotNull(), F.coalesce("component", "rep", "vec_id"))
    out = out.select("vec_id", (F.coalesce("n", F.lit(0)) + F.coalesce(F.col("m") - 1, F.lit(0))).cast("long").alias("n_links"), component.alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
