"""Quality classifier: ordinal cumulative-link regression on graded ratings.

    P(grade <= j | text) = sigmoid(threshold_j - w . x),    threshold_0 < threshold_1 < ...

One weight vector over hashed text features is shared by all grades. Features of a text: each
different word (lower case, without punctuation around it), each word shape (letters a or A, digits
0, other signs as they are) by the root of its share, and four measures of repetition and length.
The expected grade and the tail probability P(grade >= wanted) come from the same score.

The model is fitted on the driver on a sample of labelled rows that `sample` bounds (the rows whose
ids hash lowest, so that reruns agree); all documents are scored. With no labelled row that has a
document the probabilities are null and everything is kept. Null texts are scored as empty ones.
Rows with a null label or id are not fitted on; of several labels of an id the lowest grade counts, and of
several documents of an id one, by a hash of its text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, batch, binary_rows, claim, give_back, prepare

WORD_BITS, SHAPE_BITS, DENSE = 18, 12, 4
SIZE = (1 << WORD_BITS) + (1 << SHAPE_BITS) + DENSE
_AROUND = bytes(c for c in range(33, 127) if not chr(c).isalnum())
_SHAPE = bytes(ord("0") if 48 <= c < 58 else ord("A") if 65 <= c < 91 else ord("a") if 97 <= c < 123 or c >= 128 else c for c in range(256))


class _Slots(dict):
    """word -> its feature slots, as word slot + shape slot << 32."""

    limit = 150_000

    def __missing__(self, word: bytes) -> int:
        core = word.strip(_AROUND).lower() or word
        shape = word.translate(_SHAPE)
        short = bytes(c for i, c in enumerate(shape) if i < 2 or c != shape[i - 1] or c != shape[i - 2])
        short = short.replace(b"aa", b"a").replace(b"AA", b"A")
        slot = xxhash.xxh3_64_intdigest(core) >> (64 - WORD_BITS) | xxhash.xxh3_64_intdigest(short) >> (64 - SHAPE_BITS) << 32
        if len(self) < self.limit:
            self[word] = slot
        return slot


_slots = _Slots()


def features(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Slots and values of a text's features."""
    claim(_slots)
    words = text.split()
    n = len(words)
    both = np.fromiter(map(_slots.__getitem__, words), dtype=np.int64, count=n)
    different = np.unique(both & 0xFFFFFFFF)
    shapes = np.bincount(both >> 32, minlength=1)
    used = np.flatnonzero(shapes)
    dense = np.array([1.0, np.log1p(n) / 10, (both[1:] == both[:-1]).mean() if n > 1 else 0.0, len(different) / n if n else 0.0])
    slots = np.concatenate([different, used + (1 << WORD_BITS), np.arange(DENSE) + SIZE - DENSE])
    return slots, np.concatenate([np.ones(len(different)), np.sqrt(shapes[used] / max(n, 1)), dense]).astype(np.float64)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


class OrdinalModel:
    """Weights by slot and ordered thresholds."""

    def __init__(self, weights: np.ndarray, thresholds: np.ndarray):
        self.weights, self.thresholds = weights, thresholds

    def tails(self, scores: np.ndarray) -> np.ndarray:
        """P(grade >= j) for j = 1, 2, ..., a row for each score."""
        return 1 - _sigmoid(self.thresholds[None, :] - scores[:, None])


def fit(slots: np.ndarray, values: np.ndarray, rows: np.ndarray, grades: np.ndarray, n_grades: int, steps: int = 150, rate: float = 0.08, ridge: float = 3e-5, least: int = 3, z: float = 4.0) -> OrdinalModel:
    """Maximum likelihood with a ridge penalty, by Adam over the whole sample.

    Word slots get a weight if they are in `least` rows, and if the mean grade of these is `z` standard
    errors off the sample's: among many thousand words, most would fit noise.
    """
    n = len(grades)
    held = np.bincount(slots, minlength=SIZE)
    off = np.bincount(slots, weights=grades[rows] - grades.mean(), minlength=SIZE)
    off = np.abs(off) / (np.sqrt(np.maximum(held, 1)) * max(grades.std(), 1e-9))
    is_word = np.arange(SIZE) < 1 << WORD_BITS
    used = np.flatnonzero(((held >= least) & (~is_word | (off >= z))) | (np.arange(SIZE) >= SIZE - DENSE))
    place = np.full(SIZE, -1)
    place[used] = np.arange(len(used))
    on = place[slots] >= 0
    x, v, r = place[slots[on]], values[on], rows[on]
    share = np.cumsum(np.bincount(grades, minlength=n_grades) + 0.5) / (n + 0.5 * n_grades)
    cut = np.log(share[:-1] / (1 - share[:-1]))
    params = np.concatenate([np.zeros(len(used)), cut[:1], np.log(np.maximum(np.diff(cut), 1e-3))])
    m, s = np.zeros_like(params), np.zeros_like(params)
    k = len(used)
    for step in range(1, steps + 1):
        w = params[:k]
        cut = params[k] + np.concatenate([[0.0], np.cumsum(np.exp(params[k + 1 :]))])
        score = np.bincount(r, weights=v * w[x], minlength=n)
        ends = np.concatenate([[-np.inf], cut, [np.inf]])
        a, b = (np.where(np.isfinite(e), _sigmoid(np.where(np.isfinite(e), e, 0) - score), e > 0) for e in (ends[grades + 1], ends[grades]))
        p = np.maximum(a - b, 1e-12)
        g = np.empty_like(params)
        g[:k] = np.bincount(x, weights=v * (1 - a - b)[r], minlength=k) / n + ridge * w
        at = np.zeros(n_grades + 1)
        np.add.at(at, grades + 1, -a * (1 - a) / p)
        np.add.at(at, grades, b * (1 - b) / p)
        at = at[1:n_grades] / n
        g[k] = at.sum()
        g[k + 1 :] = np.cumsum(at[::-1])[::-1][1:] * np.exp(params[k + 1 :])
        m, s = 0.9 * m + 0.1 * g, 0.99 * s + 0.01 * g * g
        params -= rate * min(1, 2 - 2 * step / steps) * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-8)
    weights = np.zeros(SIZE)
    weights[used] = params[:k]
    return OrdinalModel(weights, params[k] + np.concatenate([[0.0], np.cumsum(np.exp(params[k + 1 :]))]))


def fit_on_labels(docs: DataFrame, labels: DataFrame, grade: Column, n_grades: int, sample: int = 20_000, id_col: str = "doc_id", text_col: str = "text") -> OrdinalModel | None:
    """labels: one row for each id and rating, with the column id_col; grade: its grade from 0."""
    prepare(docs.sparkSession)
    rated = labels.select(F.col(id_col).cast("long").alias("doc_id"), grade.cast("int").alias("grade")).where("doc_id is not null and grade is not null")
    rated = rated.groupBy("doc_id").agg(F.min("grade").alias("grade"))
    chosen = rated.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    met = texts.join(F.broadcast(chosen), "doc_id").select("doc_id", F.xxhash64("text").alias("h"), "grade", "text")  # at most `sample` ids
    out = pa.schema([("doc_id", pa.int64()), ("h", pa.int64()), ("grade", pa.int32()), ("slots", pa.binary()), ("values", pa.binary())])

    def run(batches):
        for b in batches:
            found = [features(t) for t in binary_rows(b.column(3))]
            yield batch(out, [*b.columns[:3], [s.astype("<i4").tobytes() for s, _ in found], [v.astype("<f4").tobytes() for _, v in found]])

    made = met.transform(arrow_map, run, "doc_id long, h long, grade int, slots binary, values binary")
    rows = made.groupBy("doc_id").agg(F.min(F.struct("h", "grade", "slots", "values")).alias("x")).select("doc_id", "x.grade", "x.slots", "x.values").toArrow().sort_by("doc_id")  # a row per id
    if not rows.num_rows:
        return None
    slots = [np.frombuffer(s, "<i4") for s in rows.column("slots").to_pylist()]
    values = np.concatenate([np.frombuffer(v, "<f4") for v in rows.column("values").to_pylist()]).astype(np.float64)
    grades = np.array(rows.column("grade").to_pylist())
    model = fit(np.concatenate(slots), values, np.repeat(np.arange(len(slots)), [len(s) for s in slots]), grades, n_grades)
    del rows, slots, values
    give_back()  # the driver lives on
    return model


def graded(docs: DataFrame, model: OrdinalModel | None, wanted: int, at_least: float = 0.5, text_col: str = "text") -> DataFrame:
    """docs with expected_grade, p_tail = P(grade >= wanted) and keep = p_tail >= at_least; columns of these names are replaced."""
    prepare(docs.sparkSession)
    docs = docs.drop("expected_grade", "p_tail", "keep")
    if model is None:
        return docs.withColumns({"expected_grade": F.lit(None).cast("double"), "p_tail": F.lit(None).cast("double"), "keep": F.lit(True)})
    shared = docs.sparkSession.sparkContext.broadcast((model.weights.astype(np.float32), model.thresholds))
    names = docs.columns
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema), "expected_grade double", "p_tail double", "keep boolean"])
    at = names.index(text_col)

    def run(batches):
        weights, thresholds = shared.value
        m = OrdinalModel(weights, thresholds)
        for b in batches:
            scores = np.empty(b.num_rows)
            for i, t in enumerate(binary_rows(b.column(at))):
                s, v = features(t or b"")
                scores[i] = weights[s] @ v
            tails = m.tails(scores)
            p = tails[:, wanted - 1]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(tails.sum(1)), pa.array(p), pa.array(p >= at_least)], names=[*names, "expected_grade", "p_tail", "keep"])

    return docs.transform(arrow_map, run, schema)


def safe_grade() -> Column:
    """Grades of the labels table: 0 toxic, 1 of low quality, 2 good."""
    return F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).when((F.col("quality") == 1) & (F.col("toxic") == 0), 2)
