"""Exact substring dedup by a depth-limited radix sort of suffixes.

Two occurrences of the same `depth` tokens are found by passes that each order the suffixes still in
question by one more digit of their window, most significant first, and drop those that are alone
with their prefix. No suffix is looked at beyond `depth` tokens, and the groups that are left after
the last pass are exactly the repeated windows.

A digit is a stretch of tokens, compared by two 64-bit rolling hashes. The first pass takes the
`core`: of the core-length stretches in each window the one with the least hash, so that equal
windows have the same core at the same place, and about 2 in `reach` positions are sorted instead
of all. The next passes widen it for those whose core occurs again: to the union of all windows
around the core, then unions of 8 windows, then single windows. If a union of windows occurs again
as a whole, so does each window in it. One occurrence stands for all equal unions in the next pass,
and goes on only if what all its windows share also occurs in a different union. So only the borders
of repeated regions reach the last pass.

Each pass shuffles one row per different digit of a batch: more occurrences in a batch prove each
other, and go past. So a passage that a third of all documents hold is a row per batch. Texts meet
what was found about them in a join on the document, thinned out by a bitmap of ids.

Rows are told apart by 96 bits of hashes of their id (null is one of its own) and whole text: rows with
null and repeated ids are documents of their own, and so are repeated rows, which have one key and
one result. Null texts are empty. Texts of fewer tokens than `depth` keep all their bytes.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import U64, Scratch, WordHash, arrow_map, batch, binary_rows, claim, constants, id_bitmap, in_bitmap, mix

NEW = ("n_bytes", "n_removed", "n_spans", "kept_sha256", "kept")
STEP = 8  # windows in a union of the third pass
_BYTES = constants(256, 21)
_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])


def byte_tokens(text: bytes) -> np.ndarray:
    return _BYTES[np.frombuffer(text, np.uint8)]


def word_tokens(text: bytes) -> np.ndarray:
    claim(_held)
    words = text.split()
    return np.fromiter(map(_held.words.__getitem__, words), dtype=np.uint64, count=len(words))


def _bytes_covered(text: bytes, cover: np.ndarray, unit: str) -> np.ndarray:
    """A mask of bytes from a mask of tokens; what stands between two covered words is covered."""
    if unit == "bytes":
        return cover
    space = _SPACE[np.frombuffer(text, np.uint8)]
    edge = np.diff(np.r_[True, space, True].astype(np.int8))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    runs = np.flatnonzero(np.diff(np.r_[False, cover, False].astype(np.int8)))
    mask = np.zeros(len(text) + 1, np.int64)
    np.add.at(mask, starts[runs[::2]], 1)
    np.add.at(mask, ends[runs[1::2] - 1], -1)
    return np.cumsum(mask)[:-1] > 0


class _Held:
    """What a worker keeps from text to text: hashes of words, and powers of two odd multipliers and their inverses modulo 2**64."""

    def __init__(self):
        self.words = WordHash()
        self.mult = [int(x) for x in constants(2, 22)]
        self.clear()

    def clear(self) -> None:
        self.words.clear()
        self.size, self.of = 0, []

    def powers(self, n: int) -> list[np.ndarray]:
        """The first n powers of each, n at least; those for a very long text are not kept."""
        if n <= self.size:
            return self.of
        size = max(n, 1 << 15)
        of = []
        for m in self.mult:
            for f in (m, pow(m, -1, 1 << 64)):
                p = np.full(size, f, dtype=np.uint64)
                p[0] = 1
                of.append(np.multiply.accumulate(p))
        if size <= 1 << 20:
            self.size, self.of = size, of
        return of


_held = _Held()


def _sliding(x: np.ndarray, width: int, f: Callable) -> np.ndarray:
    have = 1
    while 2 * have <= width:
        x = f(x[:-have], x[have:])
        have *= 2
    return f(x[: len(x) - (width - have)], x[width - have :]) if width > have else x


class Suffixes:
    """One text's tokens: hashes of any stretch, and the places of its cores."""

    def __init__(self, x: np.ndarray, depth: int):
        self.n, self.depth = len(x), depth
        self.reach = max(1, depth // 3 // STEP * STEP)  # windows that hold a core of a given place
        self.core = depth - self.reach + 1
        self.m = self.n - depth + 1  # window starts
        claim(_held)
        p1, i1, p2, i2 = _held.powers(self.n + 1)
        self.inverse = i1, i2
        self.sums = [np.concatenate([np.zeros(1, np.uint64), np.cumsum(x * p[: self.n], dtype=np.uint64)]) for p in (p1, p2)]

    def hashes(self, start: np.ndarray, end: np.ndarray, salt: int) -> tuple[np.ndarray, np.ndarray]:
        extra = (end - start).astype(np.uint64) * U64(0x9E3779B97F4A7C15) + U64(salt)
        return tuple(mix((s[end] - s[start]) * i[start] + extra) for s, i in zip(self.sums, self.inverse, strict=True))

    def find_cores(self) -> np.ndarray:
        s, k = self.sums[0], self.core
        self.order = mix((s[k:] - s[:-k]) * self.inverse[0][: self.n - k + 1])
        self.least = _sliding(self.order, self.reach, np.minimum)
        pad = np.zeros(self.reach - 1, np.uint64)
        self.cores = np.flatnonzero(self.order == _sliding(np.concatenate([pad, self.least, pad]), self.reach, np.maximum))
        return self.cores

    def union(self, core: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The first and last window start around a core."""
        return np.maximum(core - self.reach + 1, 0), np.minimum(core, self.m - 1)

    def own_core(self) -> np.ndarray:
        """For each window start, the place in self.cores of its core: the leftmost one that is the least in the window."""
        at = np.searchsorted(self.cores, np.arange(self.m))
        while (wrong := np.flatnonzero(self.order[self.cores[at]] != self.least)).size:
            at[wrong] += 1
        return at

    def step_of(self, starts: np.ndarray) -> np.ndarray:
        """The first start of the union of STEP windows that a start is in; aligned with its core."""
        c = self.cores[self.own[starts]]
        return c - (c - starts) // STEP * STEP - STEP + 1


_DIGIT = pa.schema([("route", pa.int64()), ("probe", pa.bool_()), ("several", pa.bool_()), ("h", pa.int64()), ("g", pa.int64()), ("shared", pa.int64()), ("doc", pa.int64()), ("tag", pa.int32()), ("pos", pa.int32())])
_FOUND = pa.schema([("doc", pa.int64()), ("tag", pa.int32()), ("pos", pa.int32()), ("repeated", pa.bool_()), ("first", pa.bool_()), ("shared", pa.int64())])
_DIGIT_SQL = "route long, probe boolean, several boolean, h long, g long, shared long, doc long, tag int, pos int"
_FOUND_SQL = "doc long, tag int, pos int, repeated boolean, first boolean, shared long"


def _tag(text: bytes) -> int:
    return xxhash.xxh32_intdigest(text) - 2**31


def _digits(rows: list) -> pa.RecordBatch | None:
    """Digits of a batch, from (doc, tag, pos, h, g, shared): one probe for each value, and what the batch proves itself."""
    if not rows:
        return None
    size = [len(r[2]) for r in rows]
    doc, tag = (np.repeat(np.array([r[i] for r in rows], t), size) for i, t in ((0, np.int64), (1, np.int32)))
    pos, h, g, shared = (np.concatenate([r[i] for r in rows]) for i in (2, 3, 4, 5))
    by = np.lexsort((g, h))
    doc, tag, pos, h, g, shared = (x[by] for x in (doc, tag, pos.astype(np.int32), h, g, shared))
    first = np.ones(len(h), bool)
    first[1:] = (h[1:] != h[:-1]) | (g[1:] != g[:-1])
    group = np.cumsum(first) - 1
    several = np.bincount(group)[group] > 1
    proven = np.flatnonzero(several)
    one = np.flatnonzero(first)
    z = np.zeros(len(proven), np.int64)
    route = mix(doc[proven].view(np.uint64) + pos[proven].astype(np.uint64)).view(np.int64)
    h, g, shared = (x.view(np.int64)[one] for x in (h, g, shared))
    cat = np.concatenate
    return batch(_DIGIT, [cat([route, h]), cat([z > 0, first[one]]), cat([several[proven], several[one]]), cat([z, h]), cat([z, g]), cat([z, shared]), *(cat([x[proven], x[one]]) for x in (doc, tag, pos))])


def _sorted_digits(digits: DataFrame, firsts: bool = False) -> DataFrame:
    """Occurrences of digits that occur more than once, and with firsts one of each digit; a task streams through its sorted probes."""

    def found(x, before, after, keep):
        probe, several = x[:2]
        first = probe & ~before
        repeated = ~probe | before | after | several
        out = keep & (repeated | first if firsts else repeated & ~(probe & several))
        return batch(_FOUND, [pa.array(v[out]) for v in (x[5], x[6], x[7], repeated, first, x[4])]) if out.any() else None

    def compare(batches):
        held = held_before = None
        for b in batches:
            x = [b.column(i).to_numpy(zero_copy_only=False) for i in range(8)]
            if held is not None:
                x = [np.concatenate([p, q]) for p, q in zip(held, x, strict=True)]
            if not len(x[0]):
                continue
            same = x[0][1:] & x[0][:-1] & (x[2][1:] == x[2][:-1]) & (x[3][1:] == x[3][:-1])
            before, after, keep = np.r_[False, same], np.r_[same, False], np.ones(len(x[0]), bool)
            if held is not None:
                before[0] = held_before
            keep[-1] = False  # the last one waits for what follows
            if (out := found(x, before, after, keep)) is not None:
                yield out
            held, held_before = [v[-1:] for v in x], bool(before[-1])
        if held is not None:
            no = np.zeros(1, bool)
            if (out := found(held, no | held_before, no, ~no)) is not None:
                yield out

    return digits.repartition("route").sortWithinPartitions("probe", "h", "g").drop("route").transform(arrow_map, compare, _FOUND_SQL)


def removed_spans(docs: DataFrame, depth: int, unit: str = "bytes", id_col: str = "doc_id", text_col: str = "text", keep_text: bool = False) -> DataFrame:
    """docs' id, n_bytes, n_removed, n_spans, kept_sha256 and, if keep_text, all columns with the text that is left.

    Removes each token that a stretch of `depth` tokens covers which also starts anywhere else; unit is
    bytes or words (with the white space between the words that are removed). Columns of docs that have
    the names of the new ones are replaced.
    """
    if unit not in ("bytes", "words"):
        raise ValueError(unit)
    if depth < 3 * STEP:
        raise ValueError(f"depth must be {3 * STEP} at least")
    spark = docs.sparkSession
    scratch = Scratch(spark, "substrings")
    tokens = byte_tokens if unit == "bytes" else word_tokens
    names = [f.name for f in docs.schema if f.name not in {id_col, text_col, *NEW}] if keep_text else []
    inner = [f"__{i}" for i in range(len(names))]  # no clash with what is made on the way
    whole_text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    row_key = F.xxhash64(F.col(id_col).isNull(), F.col(id_col), whole_text)
    texts = docs.select(row_key.alias("doc"), whole_text.alias("text"))

    def first(batches):
        for b in batches:
            rows = []
            for d, t in zip(b.column(0).to_pylist(), binary_rows(b.column(1)), strict=True):
                x = tokens(t) if len(t) >= depth else ()
                if len(x) >= depth:
                    s = Suffixes(x, depth)
                    c = s.find_cores()
                    h, g = s.hashes(c, c + s.core, 1)
                    rows.append((d, _tag(t), c, h, g, np.zeros(len(c), np.uint64)))
            if (out := _digits(rows)) is not None:
                yield out

    cores = scratch.keep(_sorted_digits(texts.transform(arrow_map, first, _DIGIT_SQL)), "cores")
    live = spark.sparkContext.broadcast(id_bitmap(cores.select("doc").distinct()))

    def tagged(batches):
        for b in batches:
            ok = in_bitmap(live.value, b.column(0).to_numpy(zero_copy_only=False))
            if ok.any():
                b = b.filter(pa.array(ok))
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array([_tag(t) for t in binary_rows(b.column(1))], pa.int32()), b.column(1)], names=["doc", "tag", "text"])

    again = texts.transform(arrow_map, tagged, "doc long, tag int, text string")

    def widened(places: DataFrame, step: Callable, name: str, firsts: bool) -> DataFrame:
        """The next pass, over the texts that have places in question."""
        state = places.groupBy("doc", "tag").agg(F.collect_set("pos").alias("places"))

        def run(batches):
            for b in batches:
                rows = []
                for d, g, t, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), binary_rows(b.column(2)), b.column(3), strict=True):
                    rows.append((d, g, *step(Suffixes(tokens(t), depth), np.sort(np.array(x.as_py(), np.int64)), d)))
                if (out := _digits(rows)) is not None:
                    yield out

        # equal rows of documents are occurrences of their own: the join keeps them apart
        met = again.join(state, ["doc", "tag"]).select("doc", "tag", "text", "places")
        return scratch.keep(_sorted_digits(met.transform(arrow_map, run, _DIGIT_SQL), firsts), name)

    turn = itertools.count()

    def mixed(found: DataFrame) -> DataFrame:
        """One occurrence of each union, where what its windows share is in several unions."""
        ones = found.where("first")
        # written, so that Spark may split a value that many unions share when it joins
        several = scratch.keep(ones.groupBy("shared").count().where("count > 1").select("shared"), f"several{next(turn)}")
        return ones.join(several, "shared", "left_semi").select("doc", "tag", "pos")

    def unions(s: Suffixes, places, _):
        a, b = s.union(places)
        # in a text of fewer than depth + reach tokens several cores have one union, which is one place; the leftmost is own to its windows
        one = np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])]
        places, a, b = places[one], a[one], b[one]
        return places, *s.hashes(a, b + depth, 2), s.hashes(places, places + s.core, 1)[0]

    def steps(s: Suffixes, places, doc):
        s.find_cores()
        s.own = s.own_core()
        a = np.unique(s.step_of(np.flatnonzero(np.isin(s.cores[s.own], places))))
        out = (a < 0) | (a + STEP > s.m)  # sticks out of the text, so equals no other; what its windows share never does
        h, g = s.hashes(np.maximum(a, 0), np.minimum(a + STEP, s.m) - 1 + depth, 3)
        h[out] = mix(h[out] ^ mix(np.full(out.sum(), doc, np.int64).view(np.uint64) + a[out].astype(np.uint64)))
        return a, h, g, s.hashes(a + STEP - 1, a + depth, 4)[0]

    def windows(s: Suffixes, places, _):
        s.find_cores()
        s.own = s.own_core()
        a = np.arange(s.m)
        a = a[np.isin(s.step_of(a), places)]
        return a, *s.hashes(a, a + depth, 5), np.zeros(len(a), np.uint64)

    whole = widened(cores, unions, "unions", True)
    parts = widened(mixed(whole), steps, "steps", True)
    single = widened(mixed(parts), windows, "windows", False)

    # What is repeated, as window starts, and what is left.
    found = [x.where("repeated").select("doc", "tag", "pos", F.lit(w).alias("w")) for w, x in enumerate((whole, parts, single))]
    starts = found[0].unionByName(found[1]).unionByName(found[2])
    starts = starts.groupBy("doc", "tag").agg(*[F.collect_set(F.when(F.col("w") == w, F.col("pos"))).alias(f"s{w}") for w in range(3)])
    kept = docs.select(F.col(id_col), *[F.col(f"`{n}`").alias(i) for n, i in zip(names, inner, strict=True)])
    schema = T.StructType([*kept.schema.fields]).add("n_bytes", "long").add("n_removed", "long").add("n_spans", "long").add("kept_sha256", "string")
    schema = schema.add("kept", "string") if keep_text else schema
    arrow = to_arrow_schema(schema)
    n_names = 1 + len(names)

    def finish(b: pa.RecordBatch, found) -> pa.RecordBatch:
        """b: id, other columns, doc, [tag,] text; found: window starts of row r, or None."""
        rows = []
        for r, t in enumerate(binary_rows(b.column(b.schema.get_field_index("text")))):
            marks = found(r)
            if marks is None or not any(len(m) for m in marks):
                rows.append((len(t), 0, 0, hashlib.sha256(t).hexdigest(), t))
                continue
            s = Suffixes(tokens(t), depth)
            cover = np.zeros(s.n + 1, np.int64)
            a, e = s.union(marks[0])
            for f, l in ((a, e + depth), (marks[1], marks[1] + STEP - 1 + depth), (marks[2], marks[2] + depth)):
                np.add.at(cover, np.maximum(f, 0), 1)
                np.add.at(cover, np.minimum(l, s.n), -1)
            mask = _bytes_covered(t, np.cumsum(cover)[:-1] > 0, unit)
            left = np.frombuffer(t, np.uint8)[~mask].tobytes()
            rows.append((len(t), len(t) - len(left), int((np.diff(np.r_[0, mask.astype(np.int8)]) == 1).sum()), hashlib.sha256(left).hexdigest(), left))
        made = [list(c) for c in zip(*rows, strict=True)]
        if keep_text:  # a cut between the bytes of a character can leave part of it
            made[4] = [x.decode("utf-8", "replace") for x in made[4]]
        return batch(arrow, [*b.columns[:n_names], *made[: 5 if keep_text else 4]])

    full = docs.select(*[F.col(f"`{n}`").alias(i) for n, i in zip((id_col, *names), kept.columns, strict=True)], row_key.alias("__doc"), whole_text.alias("text"))

    def untouched(batches):
        for b in batches:
            ok = ~in_bitmap(live.value, b.column(n_names).to_numpy(zero_copy_only=False))
            if ok.any():
                yield finish(b.filter(pa.array(ok)), lambda r: None)

    def pick(batches):
        for b in batches:
            ok = in_bitmap(live.value, b.column(n_names).to_numpy(zero_copy_only=False))
            if ok.any():
                b = b.filter(pa.array(ok))
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array([_tag(t) for t in binary_rows(b.column(n_names + 1))], pa.int32())], names=[*b.schema.names, "__tag"])

    def touched(batches):
        for b in batches:
            cols = [b.column(b.schema.get_field_index(f"s{w}")) for w in range(3)]
            yield finish(b, lambda r: [np.array(c[r].as_py() or [], np.int64) for c in cols])  # noqa: B023

    some = full.transform(arrow_map, pick, T.StructType([*full.schema, T.StructField("__tag", T.IntegerType())])).join(starts.withColumnRenamed("doc", "__doc").withColumnRenamed("tag", "__tag"), ["__doc", "__tag"], "left")
    some = some.select(id_col, *inner, "text", "s0", "s1", "s2").transform(arrow_map, touched, schema)
    out = full.transform(arrow_map, untouched, schema).unionByName(some)
    return out.withColumnsRenamed(dict(zip(inner, names, strict=True)))
