"""Document fingerprints by Order MinHash.

The k-mers of a text are its stretches of K bytes of UTF-8, numbered by occurrence: the second "abab" of a
text is another element than the first. Hashes of these elements fall into `sketches` bins by their
leading bits. Of each bin the `tuple_size` least elements are selected and put in text order; the
hash of their k-mers in that order is the bin's sketch. Two texts agree in a bin if they have the same
least elements in the same order, so likeness (the share of bins that agree) falls with moved,
repeated and inserted passages, as edit distance does, and not only with changed vocabulary.

A bin with fewer elements than tuple_size takes the missing ones from the next bins, in turn; a text
with fewer elements than tuple_size uses all it has, in every bin. Texts shorter than K bytes have one
element, the text itself. Equal texts have equal fingerprints; a null text is the empty one.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import U64, arrow_map, batch, binary_rows, mix, parallelism, prepare

K = 8


def elements(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the k-mers, and of the occurrence-numbered k-mers, in text order."""
    n = len(text) - K + 1
    if n < 1:
        x = np.array([xxhash.xxh3_64_intdigest(text)], dtype=np.uint64)
        return x, mix(x)
    b = np.frombuffer(text, np.uint8)
    pair = b[:-1].astype(np.uint16) | b[1:].astype(np.uint16) << np.uint16(8)
    four = pair[:-2].astype(np.uint32) | pair[2:].astype(np.uint32) << np.uint32(16)
    kmers = mix((four[:-4].astype(np.uint64) | four[4:].astype(np.uint64) << U64(32)) + U64(1))
    order = np.argsort(kmers)
    s = kmers[order]
    same = s[1:] == s[:-1]
    if not same.any():
        return kmers, mix(kmers)
    at = order[np.r_[same, False] | np.r_[False, same]]  # of k-mers that occur again, in groups
    at = at[np.lexsort((at, kmers[at]))]
    fresh = np.r_[True, kmers[at[1:]] != kmers[at[:-1]]]
    starts = np.flatnonzero(fresh)
    number = np.zeros(n, np.uint64)
    number[at] = np.arange(len(at)) - np.repeat(starts, np.diff(np.r_[starts, len(at)]))
    return kmers, mix(kmers + number * U64(0x9E3779B97F4A7C15))


def sketch(text: bytes, sketches: int = 64, tuple_size: int = 2) -> np.ndarray:
    """`sketches` 32-bit hashes; sketches: a power of two."""
    kmers, h = elements(text)
    n, bits = len(h), sketches.bit_length() - 1
    if n > 64 * sketches * tuple_size:  # only what can be among the least of a bin is sorted, if every bin has enough of it
        low = h << U64(bits) < U64(min(2**64 - 1, int(2**64 * 16 * sketches * tuple_size / n)))
        at = np.flatnonzero(low)
        if (np.bincount((h[at] >> U64(64 - bits)).astype(np.int64), minlength=sketches) < tuple_size).any():
            at = np.arange(n)
    else:
        at = np.arange(n)
    at = at[np.argsort(h[at])]
    m, size = len(at), min(tuple_size, n)
    first = np.searchsorted(h[at], np.arange(sketches, dtype=np.uint64) << U64(64 - bits))
    chosen = np.sort(at[(first[:, None] + np.arange(size)[None, :]) % m], axis=1)
    out = np.full(sketches, size, dtype=np.uint64)
    for j in range(size):
        out = mix(out * U64(0x9E3779B97F4A7C15) + kmers[chosen[:, j]])
    return (out >> U64(32)).astype(np.uint32)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    return float((a == b).mean())


def edited(text: str, following: str) -> str:
    """text with its last floor(n/2) code points replaced by the first as many (or all) of the following one's."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def in_id_order(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(_part, _next, doc_id, text): documents in ranges of ids, sorted, each range followed by the next one's first document.

    Ranges are cut at ids that occur, from quantiles of the id column alone; the document at a cut also
    goes to the range before it, marked _next, and the very first one to the last range. So texts are
    shuffled once, and a task needs no other's rows. Null ids come first; rows that repeat an id are in
    the order of their texts.
    """
    n = parallelism(docs.sparkSession)
    ids = F.coalesce(F.col(id_col).cast("long"), F.lit(-(2**63)))
    keys = docs.select(ids.alias("k"))
    least = keys.agg(F.min("k")).first()[0]

    def range_of(cuts: list[int]) -> Column:
        bounds = F.array(*[F.lit(c).cast("long") for c in cuts])
        halves = F.array(*[F.lit(1 << i) for i in reversed(range(len(cuts).bit_length()))])  # steps of a binary search
        return F.aggregate(halves, F.lit(0), lambda at, step: F.when(F.get(bounds, at + step) <= k, at + step).otherwise(at))

    cuts, k = [0], F.col("k")
    if least is not None:  # quantiles are doubles, and need not be ids beyond 2**53: the least id of each range is
        near = {min(int(c), 2**63 - 1) for c in keys.approxQuantile("k", [i / n for i in range(1, n)], 0.2 / n)}
        near = [least, *sorted(c for c in near if c > least)]
        cuts = sorted(r.k for r in keys.groupBy(range_of(near).alias("r")).agg(F.min("k").alias("k")).collect())
    k = F.col("_k")
    bounds = F.array(*[F.lit(c).cast("long") for c in cuts])
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"), ids.alias("_k"))
    rows = rows.withColumn("_part", range_of(cuts))
    part, at_cut = F.col("_part"), F.get(bounds, F.col("_part")) == F.col("_k")
    before = F.when(F.col("_k") == cuts[0], F.lit(len(cuts) - 1)).otherwise(part - 1)
    own, copy = F.struct(part.alias("_part"), F.lit(False).alias("_next")), F.struct(before.cast("int").alias("_part"), F.lit(True).alias("_next"))
    rows = rows.withColumn("_to", F.explode(F.when(at_cut, F.array(own, copy)).otherwise(F.array(own))))
    rows = rows.select("_to._part", "_to._next", "doc_id", "text", "_k")
    return rows.repartitionById(len(cuts), F.col("_part")).sortWithinPartitions("_part", "_next", "_k", "text").select("_part", "_next", "doc_id", "text")


_OUT = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])
_OUT_SQL = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def fingerprints(docs: DataFrame, text_col: str = "text", sketches: int = 64, tuple_size: int = 2) -> DataFrame:
    """docs with their fingerprint, as 8 hex digits for each sketch."""
    prepare(docs.sparkSession)
    docs = docs.drop("fingerprint")
    at = docs.columns.index(text_col)
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema), "fingerprint string"])

    def run(batches):
        for b in batches:
            made = [sketch(t or b"", sketches, tuple_size).astype(">u4").tobytes().hex() for t in binary_rows(b.column(at))]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(made, pa.string())], names=[*b.schema.names, "fingerprint"])

    return docs.transform(arrow_map, run, schema)


def edit_comparison(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sketches: int = 64, tuple_size: int = 2) -> DataFrame:
    """Fingerprints of each document and of its edited text, and their likeness to it and to the next document's."""
    prepare(docs.sparkSession)

    def run(batches):
        held = closed = None  # (doc_id, text, sketch) of the row before; the range whose following document has been seen

        def row(doc, text, own, following, next_sketch):
            new = edited(text, following).encode()
            e = own if new == text.encode() else sketch(new, sketches, tuple_size)
            return (doc, len(text), hashlib.sha256(new).hexdigest(), own.astype(">u4").tobytes().hex(), e.astype(">u4").tobytes().hex(), likeness(own, e), likeness(own, next_sketch))

        for b in batches:
            rows = []
            for p, nxt, d, t in zip(*(b.column(i).to_pylist() for i in range(4)), strict=True):
                if nxt and (closed == p or held is None):
                    continue
                s = sketch(t.encode(), sketches, tuple_size)
                if held is not None:
                    rows.append(row(*held, t, s))
                held, closed = (None, p) if nxt else ((d, t, s), closed)
            if rows:
                yield batch(_OUT, [list(c) for c in zip(*rows, strict=True)])
        if held is not None:
            raise ValueError(f"document {held[0]} has no following one")

    return in_id_order(docs, id_col, text_col).transform(arrow_map, run, _OUT_SQL)
