"""Best-fit packing of documents into sequences, with large-item matching.

Only lengths matter to a packing, and there are at most `capacity` of them: the packing is planned on
their histogram, which has a fixed size whatever the number of documents. Lengths above a third of
the capacity go at most twice into a sequence, so they are matched first, the longest with the
longest that still fits. Shorter ones follow in descending order, each into the smallest gap that
takes it; many equal sequences are filled at once. The plan is a few thousand runs (length, first
rank, sequences). Documents get their rank among those of their length from distributed prefix
counts, and look their place up in the plan.

A null text is empty. Rows that repeat an id are packed as documents of their own. An empty table
gives an empty result.
"""

from __future__ import annotations

import bisect
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, arrow_map, batch, prefix_sums
from .tokens import word_ids


def plan(counts: np.ndarray, capacity: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Sequences as (how many, [(length, times), ...]) that take counts[n] pieces of each length n."""
    left = [int(c) for c in counts]
    gaps: dict[int, list[tuple[int, list]]] = {}
    open_gaps: list[int] = []
    done = []

    def put(gap: int, many: int, content: list) -> None:
        if not many:
            return
        if not gap:
            done.append((many, content))
            return
        if gap not in gaps:
            gaps[gap] = []
            bisect.insort(open_gaps, gap)
        gaps[gap].append((many, content))

    large = [n for n in range(capacity, capacity // 3, -1) if left[n]]
    for n in large:
        while left[n]:
            partner = next((m for m in range(min(n, capacity - n), capacity // 3, -1) if left[m] > (m == n)), None)
            many = left[n] if partner is None else left[n] // 2 if partner == n else min(left[n], left[partner])
            left[n] -= many
            if partner is None:
                put(capacity - n, many, [(n, 1)])
            else:
                left[partner] -= many
                put(capacity - n - partner, many, [(n, 2)] if partner == n else [(n, 1), (partner, 1)])
    for n in range(capacity // 3, 0, -1):
        while left[n]:
            at = bisect.bisect_left(open_gaps, n)
            if at == len(open_gaps):
                each = capacity // n
                many = max(1, left[n] // each)
                each = min(each, left[n])
                put(capacity - each * n, many, [(n, each)])
                left[n] -= many * each
                continue
            gap = open_gaps[at]
            many, content = gaps[gap].pop()
            if not gaps[gap]:
                del gaps[gap], open_gaps[at]
            each = min(gap // n, left[n])
            use = min(many, left[n] // each)
            put(gap, many - use, content)
            put(gap - each * n, use, [*content, (n, each)])
            left[n] -= use * each
    return done + [x for g in open_gaps for x in gaps[g]]


def runs(sequences: list[tuple[int, list[tuple[int, int]]]]) -> np.ndarray:
    """Rows (length, first rank, first sequence, times in each sequence, offset), sorted."""
    out, ranks, first = [], {}, 0
    for many, content in sequences:
        offset = 0
        for n, times in content:
            out.append((n, ranks.get(n, 0), first, times, offset))
            ranks[n] = ranks.get(n, 0) + many * times
            offset += n * times
        first += many
    return np.array(sorted(out), np.int64).reshape(-1, 5)


def pieces(docs: DataFrame, tokenizer: str, capacity: int, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of each document's ids and end_id, cut every `capacity` ids."""
    out = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])
    end = int(end_id).to_bytes(4, "little")

    def cut(batches):
        ids_of = word_ids(tokenizer)
        for b in batches:
            rows = []
            for d, ids in zip(b.column(0).to_pylist(), ids_of.documents(b.column(1)), strict=True):
                ids = ids + end
                for p, s in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[s : s + 4 * capacity]
                    rows.append((d, p, s // 4, len(part) // 4, zlib.crc32(part)))
            if rows:
                yield batch(out, [list(c) for c in zip(*rows, strict=True)])

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return texts.transform(arrow_map, cut, "doc_id long, piece int, start long, length long, ids_crc32 long")


def pack(lengths: DataFrame, capacity: int, order: list[str], scratch: Scratch) -> DataFrame:
    """lengths (with a column `length` from 1 to capacity) and the sequence_id and offset of each row."""
    counts = np.zeros(capacity + 1, np.int64)
    for row in lengths.groupBy("length").count().collect():  # at most `capacity` rows
        counts[row.length] = row["count"]
    table = runs(plan(counts, capacity))
    shared = lengths.sparkSession.sparkContext.broadcast(table)
    ranked = prefix_sums(lengths.withColumn("rank", F.lit(0)), [F.col("length"), *[F.col(c) for c in order]], {"rank": F.lit(1)}, scratch, "ranked", ["length"])

    def place(batches):
        t = shared.value
        keys = t[:, 0] * (1 << 48) + t[:, 1]
        for b in batches:
            n, r = (b.column(b.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in ("length", "rank"))
            run = t[np.searchsorted(keys, n * (1 << 48) + r, side="right") - 1]
            q = r - run[:, 1]
            keep = [c for c in b.schema.names if c != "rank"]
            yield pa.RecordBatch.from_arrays([*(b.column(b.schema.get_field_index(c)) for c in keep), pa.array(run[:, 2] + q // run[:, 3]), pa.array(run[:, 4] + q % run[:, 3] * n)], names=[*keep, "sequence_id", "offset"])

    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in ranked.schema if f.name != "rank"]
    return ranked.transform(arrow_map, place, ", ".join([*kept, "sequence_id long", "offset long"]))


def packed_sequences(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of all documents with their place: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    scratch = Scratch(docs.sparkSession, "packing")
    cut = scratch.keep(pieces(docs, tokenizer, capacity, end_id, id_col, text_col), "pieces")
    return pack(cut, capacity, ["doc_id", "piece", "ids_crc32"], scratch)
