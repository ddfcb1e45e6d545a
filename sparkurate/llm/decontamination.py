"""Benchmark decontamination with suffix arrays of the training texts.

The texts of a batch, one after the other, are cut into shards of a bounded number of words. Each shard
gets a suffix array: its suffixes in the order of their words, to `window` words deep, by most
significant pairs of words first; only suffixes that are still tied go on to the next pair. Every test
suffix is searched in every shard by bisection, which gives the range of suffixes that begin with the
same `window` words (all words of a shorter item): all places where the window occurs. Windows that go
on from place to place are the longest verbatim matches.

* A word is a 64-bit hash. Suffixes are ordered by its upper half, and places are then compared with
  the window word by word in both halves.
* Tasks work on their own texts only: there is no shuffle, and nothing of the texts leaves its row.
* Test items are dealt into lots of about `block` bytes by a hash, and a lot is sent to the tasks; with
  several lots each is a pass over the texts, written between passes. So what is sent is bounded
  whatever the size of the benchmark (one longer item is sent whole).

Null texts have no words. Items without words have no windows; repeated items and items of one id count
as one; items without an id mark words as hit and aren't listed. Documents with null or repeated ids are
rows of their own. Texts of any length are cut into shards that overlap by a window.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import U64, Scratch, WordHash, arrow_map, batch, binary_rows, claim

SHARD, BLOCK = 1 << 20, 1 << 20  # words of a shard, bytes of a lot of test items
_READ = bytes(b if b >= 128 or 48 <= b < 58 or 97 <= b < 123 else b + 32 if 65 <= b < 91 else 32 for b in range(256))
_held = WordHash()
LOW = U64(0xFFFFFFFF)


def words(text: bytes, size: int = 4 << 20) -> np.ndarray:
    """Hashes, never 0, of the words of a text: letters a-z (A-Z in lower case), digits and all that isn't ASCII."""
    claim(_held)
    read, parts, at = text.translate(_READ), [], 0
    while at < len(read):
        end = read.find(b" ", at + size)
        end = len(read) if end < 0 else end
        w = read[at:end].split()
        parts.append(np.fromiter(map(_held.__getitem__, w), np.uint64, len(w)))
        at = end
    return np.maximum(np.concatenate(parts), U64(1)) if parts else np.zeros(0, np.uint64)


class Windows:
    """Distinct windows of test items: words (0 beyond a window's end), length, and which items have each."""

    def __init__(self, items: list[tuple[str | None, bytes]], window: int):
        self.window, self.width = window, window + window % 2
        rows, own, starts = [], [], []
        for i, (_, text) in enumerate(items):
            w = words(text)
            if len(w):
                k = min(window, len(w))
                part = np.zeros((len(w) - k + 1, self.width), np.uint64)
                part[:, :k] = np.lib.stride_tricks.sliding_window_view(w, k)
                rows.append(part)
                own.append(np.full(len(part), i))
                starts.append(np.arange(len(part)))
        every = np.concatenate(rows) if rows else np.zeros((0, self.width), np.uint64)
        self.w, at = np.unique(every, axis=0, return_inverse=True)
        self.length = (self.w > 0).sum(1)
        self.names = [n for n, _ in items]
        # places (item, start) of each window, by window
        at = at.ravel()
        by = np.argsort(at, kind="stable")
        self.own, self.starts = (np.concatenate(x)[by] if x else np.zeros(0, np.int64) for x in (own, starts))
        self.first = np.searchsorted(at[by], np.arange(len(self.w) + 1))
        self.keys = pair_keys(self.w[:, 0::2], self.w[:, 1::2])
        # the last suffix that begins with a window: words beyond its end are the greatest
        top = np.where(self.w > 0, self.w, ~U64(0))
        self.tops = pair_keys(top[:, 0::2], top[:, 1::2])

    def items_of(self, found: np.ndarray) -> list[str]:
        """Ids of the items that have one of the windows."""
        i = np.unique(np.concatenate([self.own[self.first[x] : self.first[x + 1]] for x in found])) if len(found) else []
        return sorted({self.names[x] for x in i if self.names[x] is not None})


def pair_keys(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The upper halves of two words as one number."""
    return (a & ~LOW) | (b >> U64(32))


class SuffixArray:
    """Suffixes of a shard in the order of their first `width` words (an even number)."""

    def __init__(self, x: np.ndarray, width: int):
        self.x = np.concatenate([x, np.zeros(width, np.uint64)])
        n = len(x)
        pair = pair_keys(self.x[: n + width - 1], self.x[1 : n + width])  # of the words at i and i + 1
        self.order = np.argsort(pair[:n])
        key = pair[self.order]
        self.keys = [key]
        edge = np.r_[True, key[1:] != key[:-1]]  # where a tie begins
        for d in range(2, width, 2):
            tied = np.flatnonzero(~(edge & np.r_[edge[1:], True]))
            if tied.size:
                group = np.cumsum(edge)[tied]
                by = np.lexsort((pair[self.order[tied] + d], group))
                self.order[tied] = self.order[tied][by]
            key = pair[self.order + d]
            self.keys.append(key)
            if tied.size:
                edge[tied[1:]] |= key[tied[1:]] != key[tied[1:] - 1]

    def bisect(self, keys: np.ndarray, right: bool) -> np.ndarray:
        """For each row of keys the first place whose suffix isn't less (with right: is greater)."""
        lo, hi = np.zeros(len(keys), np.int64), np.full(len(keys), len(self.order))
        while (open_ := np.flatnonzero(lo < hi)).size:
            mid = (lo[open_] + hi[open_]) // 2
            less, same = np.zeros(len(mid), bool), np.ones(len(mid), bool)
            for k, column in zip(keys.T, self.keys, strict=True):
                here, there = column[mid], k[open_]
                less |= same & (here < there)
                same &= here == there
            go = less | same if right else less
            lo[open_[go]], hi[open_[~go]] = mid[go] + 1, mid[~go]
        return lo

    def places(self, w: Windows) -> tuple[np.ndarray, np.ndarray]:
        """(place, window) of all occurrences of windows."""
        first, end = self.bisect(w.keys, False), self.bisect(w.tops, True)
        n = end - first
        which = np.repeat(np.arange(len(n)), n)
        at = self.order[np.repeat(first - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(len(which))] if len(which) else which
        good = np.ones(len(at), bool)
        for j in range(w.w.shape[1]):  # both halves of each word
            want = w.w[which, j]
            good &= (want == 0) | (self.x[at + j] == want)
        return at[good], which[good]


def _shards(texts: list[np.ndarray], window: int, size: int = SHARD) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(words, row of each, place in the row of each) of shards; rows are set apart by a 0, and a row over shards is cut with an overlap."""
    parts, total = [], 0
    for row, x in enumerate(texts):
        for s in range(0, max(len(x) - window + 1, min(len(x), 1)), size):
            part = x[s : s + size + window - 1]
            parts.append((row, s, part))
            total += len(part) + 1
            if total >= size:
                yield _joined(parts)
                parts, total = [], 0
    if parts:
        yield _joined(parts)


def _joined(parts: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    zero = np.zeros(1, np.uint64)
    x = np.concatenate([y for _, _, p in parts for y in (p, zero)])
    row = np.concatenate([np.full(len(p) + 1, r) for r, _, p in parts])
    place = np.concatenate([np.arange(s, s + len(p) + 1) for _, s, p in parts])
    return x, row, place


def _found(texts: list, w: Windows) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, place in the row, window) of all occurrences, by row."""
    found = [(row[at], place[at], which) for x, row, place in _shards(texts, w.window) for at, which in [SuffixArray(x, w.width).places(w)]]
    if not found:
        return (np.zeros(0, np.int64),) * 3
    row, place, which = (np.concatenate(f) for f in zip(*found, strict=True))
    by = np.argsort(row, kind="stable")
    return row[by], place[by], which[by]


class _Lots:
    """Test items in lots, each small enough to be sent to every task; an item is whole in one lot."""

    def __init__(self, items: DataFrame, id_col: str, text_col: str, window: int, block: int):
        self.rows = items.select(F.col(id_col).cast("string").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")).distinct()
        size = self.rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        self.n, self.window = max(1, -(-size // block)), window

    def __iter__(self) -> Iterator[Windows]:
        for i in range(self.n):
            part = self.rows.where(F.pmod(F.xxhash64("id", "text"), F.lit(self.n)) == i)
            yield Windows([(r.id, r.text.encode()) for r in part.collect()], self.window)


HITS = ("n_words", "spans", "items")


def contamination(docs: DataFrame, items: DataFrame, window: int = 10, text_col: str = "text", item_id: str = "item_id", item_text: str = "text", block: int = BLOCK, keep_text: bool = True) -> DataFrame:
    """docs' columns, with n_words, spans (start, end: the runs of words that windows of items cover, ascending) and items (ids, ascending as text).

    Columns of docs that have these names are replaced; without keep_text the text goes.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "leaks")
    other = [c for c in docs.columns if c not in HITS or c == text_col]
    inner, text = [f"c{i}" for i in range(len(other))], f"c{other.index(text_col)}"
    rows = docs.select(*[(F.col(f"`{c}`").cast("string") if c == text_col else F.col(f"`{c}`")).alias(i) for c, i in zip(other, inner, strict=True)])
    rows = rows.withColumns({"n_words": F.lit(0).cast("long"), "spans": F.array().cast("array<struct<start:long,end:long>>"), "items": F.array().cast("array<string>")})

    def searched(shared, given: list[str], made: list[str], arrow: pa.Schema):
        def run(batches):
            w = shared.value
            for b in batches:
                if not b.num_rows:
                    continue
                column = dict(zip(given, b.columns, strict=True))
                texts = [words(t or b"") for t in binary_rows(column[text])]
                spans, names = column["spans"].to_pylist(), column["items"].to_pylist()
                row, place, which = _found(texts, w)
                n = w.length[which]
                edges = np.flatnonzero(np.diff(np.r_[-1, row, -1])) if len(row) else row  # where a row's places begin and end
                for s, e in zip(edges[:-1], edges[1:], strict=True):
                    r = int(row[s])
                    lit = np.zeros(len(texts[r]) + 1, np.int64)
                    np.add.at(lit, place[s:e], 1)
                    np.add.at(lit, place[s:e] + n[s:e], -1)
                    for x in spans[r]:
                        lit[x["start"]] += 1
                        lit[x["end"]] -= 1
                    edge = np.flatnonzero(np.diff(np.r_[0, (np.cumsum(lit) > 0).astype(np.int8)]))
                    spans[r] = [{"start": x, "end": y} for x, y in edge.reshape(-1, 2).tolist()]
                    names[r] = sorted({*names[r], *w.items_of(np.unique(which[s:e]))})
                column |= {"n_words": [len(t) for t in texts], "spans": spans, "items": names}
                yield batch(arrow, [column[c] for c in made])

        return run

    lots = _Lots(items, item_id, item_text, window, block)
    for i, lot in enumerate(lots):
        last = i == lots.n - 1
        fields = [f for f in rows.schema.fields if keep_text or not last or f.name != text]
        schema = T.StructType(fields)
        rows = rows.transform(arrow_map, searched(spark.sparkContext.broadcast(lot), rows.columns, schema.names, to_arrow_schema(schema)), schema)
        rows = rows if last else scratch.keep(rows, f"pass{i}")
    return rows.select(*[F.col(i).alias(c) for i, c in zip(inner, other, strict=True) if i in rows.columns], *HITS)


def decontaminated(docs: DataFrame, items: DataFrame, window: int = 10, **names) -> DataFrame:
    """The documents without those that hold a window of an item."""
    clean = contamination(docs, items, window, **names).where(F.size("spans") == 0)
    return clean.select(*[F.col(f"`{c}`") for c in docs.columns if c in clean.columns and c not in HITS])


def longest_matches(docs: DataFrame, items: DataFrame, window: int = 10, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text", block: int = BLOCK) -> DataFrame:
    """(item_id, start, n_words, doc_id, place): for each test suffix that begins with a window found in docs, the longest verbatim match.

    It is given with its first location: the least doc_id, then the least place; a null doc_id comes last.
    An item that holds one window m times meets a text that holds it n times in m * n places.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "matches")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    out = pa.schema([("item_id", pa.string()), ("start", pa.int64()), ("n_words", pa.int64()), ("doc_id", pa.int64()), ("place", pa.int64())])
    schema = "item_id string, start long, n_words long, doc_id long, place long"

    def searched(shared):
        def run(batches):
            w = shared.value
            for b in batches:
                row, place, which = _found([words(t or b"") for t in binary_rows(b.column(1))], w)
                n = w.first[which + 1] - w.first[which]
                each = np.repeat(np.arange(len(which)), n)
                at = np.repeat(w.first[which] - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(len(each)) if len(each) else each
                pair = np.unique(np.stack([w.own[at], row[each], place[each] - w.starts[at], w.starts[at], w.length[which[each]]], 1), axis=0)
                if not len(pair):
                    continue
                # windows that follow each other in the item and in the text are one match
                item, r, shift, start, size = pair.T
                new = np.r_[True, (pair[1:, :3] != pair[:-1, :3]).any(1) | (start[1:] != start[:-1] + 1)]
                ends = np.r_[np.flatnonzero(new)[1:], len(pair)] - 1
                total = start[ends[np.cumsum(new) - 1]] - start + size
                docs_ = b.column(0).to_numpy(zero_copy_only=False)[r]
                order = np.lexsort((shift, docs_, -total, start, item))
                best = order[np.r_[True, (item[order][1:] != item[order][:-1]) | (start[order][1:] != start[order][:-1])]]
                ids = b.column(0).take(pa.array(r[best]))
                yield batch(out, [[w.names[i] for i in item[best]], start[best], total[best], ids, (shift + start)[best]])

        return run

    lots = _Lots(items, item_id, item_text, window, block)
    found = None
    for i, lot in enumerate(lots):
        part = rows.transform(arrow_map, searched(spark.sparkContext.broadcast(lot)), schema)
        part = part if lots.n == 1 else scratch.keep(part, f"pass{i}")
        found = part if found is None else found.unionByName(part)
    best = F.min(F.struct((-F.col("n_words")).alias("n"), F.col("doc_id").isNull().alias("none"), "doc_id", "place"))
    return found.groupBy("item_id", "start").agg(best.alias("b")).select("item_id", "start", (-F.col("b.n")).alias("n_words"), "b.doc_id", "b.place")
