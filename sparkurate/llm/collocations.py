"""Phrase collocation mining by suffix-sigma.

Texts are cut into pieces and words; a phrase is up to max_n words in a row within a piece. Every word
starts a suffix of its piece, cut after max_n words. Suffixes are shuffled by language and first word,
sorted in reverse lexicographic order, and one stack of open prefixes counts all prefixes as the
sorted suffixes go by: a prefix is closed, with its count, as soon as a suffix doesn't begin with it.

* A word is the 63-bit hash of its language and itself; suffixes are ordered by these numbers. 0 ends a
  suffix and is the least, so longer suffixes come first.
* Suffixes are dealt out in ranges of the whole suffix, not by the first word alone, so that a word or
  a pair with a third of all occurrences is spread over many tasks. Only the first and last prefixes
  of a range can go on in another, and their counts are added up afterwards.
* Equal suffixes of a batch are one row with a count before the shuffle.
* A phrase is as frequent as its rarest pair at most. Pairs are counted first in 2**bits hashed,
  saturating counters, whose values are never too small: suffixes end before a pair that is surely
  below the least count. When the counters fill up, suffixes are longer and results stay the same.

Frequent phrases are then joined with their parts for scores, and with the longer ones that hold them.
Null texts are empty, a null language is `und`, repeated rows count again, an empty table has no
phrases. A text is tokenized in slices, so its length is bounded by what a row holds only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import U64, Scratch, WordHash, arrow_map, batch, binary_rows, claim, mix

BITS, BLOCK, STRIDE, HELD = 24, 1 << 17, 1 << 20, 300_000
CUT = b"A"  # stands between pieces: no word holds a capital A
_READ = bytes.maketrans(b".,;:!?\n\v\f\r\tABCDEFGHIJKLMNOPQRSTUVWXYZ", CUT * 10 + b" abcdefghijklmnopqrstuvwxyz")
_held = WordHash()
_held[CUT] = 0


def slices(text: bytes, size: int = 4 << 20) -> Iterator[bytes]:
    """A text in parts of about `size` bytes, cut at spaces."""
    at = 0
    while len(text) - at > size:
        end = text.find(b" ", at + size)
        if end < 0:
            break
        yield text[at:end]
        at = end
    yield text[at:] if at else text


def _by_language(b: pa.RecordBatch) -> Iterator[tuple[str, list[bytes]]]:
    """Texts of a batch (lang, text) for each language."""
    by: dict[str, list] = {}
    for lang, text in zip(b.column(0).to_pylist(), binary_rows(b.column(1)), strict=True):
        if text:
            by.setdefault("und" if lang is None else lang, []).append(text)
    yield from by.items()


def _codes(lang: str, words: np.ndarray) -> np.ndarray:
    """Numbers of a language's words, from their hashes; 0 stays 0."""
    salt = U64(xxhash.xxh3_64_intdigest(lang.encode(), seed=1))  # another hash than words have
    return np.where(words > 0, np.maximum(mix(words + salt) >> U64(1), U64(1)), U64(0)).view(np.int64)


def _tokenized(lang: str, texts: list[bytes]) -> Iterator[tuple[list[bytes], np.ndarray]]:
    """Words and cuts of texts one after the other, and their numbers, in slices."""
    read = (b" " + CUT + b" ").join(t.translate(_READ).replace(CUT, b" " + CUT + b" ") for t in texts)
    for part in slices(read):
        claim(_held)
        _held[CUT] = 0
        words = part.split()
        h = np.fromiter(map(_held.__getitem__, words), np.uint64, len(words))
        yield words, _codes(lang, h)


def _pairs(codes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(both are words, the counter's number) of each two in a row."""
    a, b = codes[:-1], codes[1:]
    return (a > 0) & (b > 0), (mix(a.view(np.uint64) * U64(0x9E3779B97F4A7C15) + b.view(np.uint64)) >> U64(64 - bits)).astype(np.int64)


_SEEN = pa.schema([("lang", pa.string()), ("word", pa.string()), ("k", pa.int64()), ("n", pa.int64()), ("block", pa.int32()), ("counts", pa.binary())])
_SEEN_SQL = "lang string, word string, k long, n long, block int, counts binary"


def _counted(texts: DataFrame, bits: int, scratch: Scratch) -> DataFrame:
    """Words of each task with their counts (block is null; a word may be there again when a task has many), and blocks of each task's pair counters, which stop at 255."""

    def rows(held: dict[str, dict[bytes, int]]) -> Iterator[pa.RecordBatch]:
        for lang, n in held.items():
            k = _codes(lang, np.fromiter(map(_held.__getitem__, n), np.uint64, len(n)))
            yield batch(_SEEN, [[lang] * len(n), [w.decode("utf-8", "replace") for w in n], k, list(n.values()), pa.nulls(len(n), pa.int32()), pa.nulls(len(n), pa.binary())])
        held.clear()

    def count(batches):
        counters = np.zeros(1 << bits, np.uint8)
        held: dict[str, dict[bytes, int]] = {}  # words of a task, given out when they are many
        for b in batches:
            for lang, read in _by_language(b):
                before = np.zeros(1, np.int64)  # the last word of the slice before
                own = held.setdefault(lang, {})
                for words, codes in _tokenized(lang, read):
                    k, at, n = np.unique(codes, return_index=True, return_counts=True)
                    for i, x in zip(at[k > 0].tolist(), n[k > 0].tolist(), strict=True):
                        own[words[i]] = own.get(words[i], 0) + x
                    both, slot = _pairs(np.concatenate([before, codes]), bits)
                    slot, n = np.unique(slot[both], return_counts=True)
                    counters[slot] = np.minimum(counters[slot] + n, 255)
                    before = codes[-1:] if len(codes) else before
            if sum(map(len, held.values())) > HELD:
                yield from rows(held)
        yield from rows(held)
        full = [i for i in range(len(counters) // BLOCK) if counters[i * BLOCK : (i + 1) * BLOCK].any()]
        if full:
            none = pa.nulls(len(full), pa.string())
            yield batch(_SEEN, [none, none, [0] * len(full), [0] * len(full), full, [counters[i * BLOCK : (i + 1) * BLOCK].tobytes() for i in full]])

    return scratch.keep(texts.transform(arrow_map, count, _SEEN_SQL), "seen")


def _frequent_pairs(seen: DataFrame, bits: int, least: int) -> np.ndarray:
    """A map of 2**bits bits: set where a pair may occur `least` times."""
    out = pa.schema([("block", pa.int32()), ("bits", pa.binary())])

    def add(batches):
        total: dict[int, np.ndarray] = {}
        for b in batches:
            for k, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                part = np.frombuffer(v, np.uint8).astype(np.uint16)
                total[k] = np.minimum(total[k] + part, 255) if k in total else part
        if total:
            yield batch(out, [list(total), [np.packbits(v >= min(least, 255)).tobytes() for v in total.values()]])

    n = max((1 << bits) // BLOCK, 1)
    bitmap = np.zeros((n, BLOCK // 8), np.uint8)
    for r in seen.where("block is not null").select("block", "counts").repartition(min(n, 16), "block").transform(arrow_map, add, "block int, bits binary").collect():
        bitmap[r.block] = np.frombuffer(r.bits, np.uint8)
    return bitmap.ravel()


def _suffixes(texts: DataFrame, frequent: np.ndarray, bits: int, max_n: int) -> DataFrame:
    """(k0 .. k[max_n - 1], n): suffixes of two words at least, equal ones of a batch once."""
    shared = texts.sparkSession.sparkContext.broadcast(frequent)
    names = [f"k{i}" for i in range(max_n)]
    out = pa.schema([(c, pa.int64()) for c in [*names, "n"]])

    def emit(batches):
        for b in batches:
            for lang, read in _by_language(b):
                codes = np.concatenate([*(c for _, c in _tokenized(lang, read)), np.zeros(max_n, np.int64)])
                for s in range(0, len(codes) - max_n, STRIDE):
                    part = codes[s : s + STRIDE + max_n]
                    both, slot = _pairs(part, bits)
                    on = both & ((shared.value[slot >> 3] >> (7 - (slot & 7)).astype(np.uint8)) & 1 == 1)
                    i = np.flatnonzero(on[: len(part) - max_n])
                    if not i.size:
                        continue
                    k, go = [part[i], part[i + 1]], np.ones(len(i), bool)
                    for d in range(2, max_n):
                        go = go & on[i + d - 1]
                        k.append(np.where(go, part[i + d], 0))
                    key = np.zeros(len(i), np.uint64)
                    for c in k:
                        key = mix(key * U64(0x9E3779B97F4A7C15) + c.view(np.uint64))
                    _, at, n = np.unique(key, return_index=True, return_counts=True)
                    yield batch(out, [*(c[at] for c in k), n])

    return texts.transform(arrow_map, emit, ", ".join(f"{c} long" for c in [*names, "n"]))


def prefix_counts(suffixes: DataFrame, max_n: int, least: int) -> DataFrame:
    """(k0 .. k[max_n - 1], f): prefixes of two words at least that occur `least` times, from suffixes dealt out in sorted ranges."""
    names = [f"k{i}" for i in range(max_n)]
    schema = ", ".join(f"{c} long" for c in [*names, "f"])
    out = pa.schema([(c, pa.int64()) for c in [*names, "f"]])

    def row(k: np.ndarray, depth: int) -> np.ndarray:
        k = k.copy()
        k[..., depth:] = 0
        return k

    def count(batches):
        last = None  # the suffix before
        stack: dict[int, list] = {}  # depth -> [count, whether it is the first prefix of the range], of the prefixes of `last` that are open
        for b in batches:
            if not b.num_rows:
                continue
            k = np.stack([b.column(i).to_numpy(zero_copy_only=False) for i in range(max_n)], 1)
            n = b.column(max_n).to_numpy(zero_copy_only=False)
            differs = np.ones(len(k), bool) if last is None else np.r_[(k[0] != last).any(), np.zeros(len(k) - 1, bool)]
            differs[1:] = (k[1:] != k[:-1]).any(1)
            first_new = np.argmax(np.concatenate([k[:1] != (np.full((1, max_n), -1) if last is None else last), k[1:] != k[:-1]]), 1)
            first_new[~differs] = max_n  # the first place where a suffix leaves the one before
            closed = []
            for depth in range(2, max_n + 1):
                new = np.flatnonzero(first_new < depth)  # here prefixes of this depth end, and others begin
                sums = np.add.reduceat(n, np.r_[0, new[new > 0]]) if len(n) else n
                starts = np.r_[0, new[new > 0]]
                if depth in stack and not (len(new) and new[0] == 0):  # goes on from the batch before
                    sums[0] += stack[depth][0]
                    edge = stack[depth][1]
                else:
                    if depth in stack:
                        if stack[depth][1] or stack[depth][0] >= least:
                            closed.append((row(last[None], depth), np.array([stack[depth][0]]), last[None, depth - 1] > 0))
                    edge = depth not in stack
                keep = sums >= least
                keep[0] |= edge
                keep[-1] = False  # stays open
                closed.append((row(k[starts[keep]], depth), sums[keep], k[starts[keep], depth - 1] > 0))
                stack[depth] = [int(sums[-1]), edge and len(sums) == 1]
            last = k[-1]
            rows, f, there = (np.concatenate(x) for x in zip(*closed, strict=True))
            if there.any():
                yield batch(out, [*rows[there].T, f[there]])
        if last is not None:
            left = [(row(last, d), f) for d, (f, _) in stack.items() if last[d - 1] > 0]
            if left:
                yield batch(out, [*np.stack([r for r, _ in left]).T, [f for _, f in left]])

    sort = [F.desc(c) for c in names]
    parts = suffixes.repartitionByRange(*names).sortWithinPartitions(*sort).transform(arrow_map, count, schema)
    return parts.groupBy(*names).agg(F.sum("f").alias("f")).where(F.col("f") >= least)


def frequent_phrases(texts: DataFrame, scratch: Scratch, max_n: int, least: int, bits: int = BITS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(words (k, lang, word, f), phrases (k0 .., f), totals (lang, n)) of texts (lang, text)."""
    seen = _counted(texts, bits, scratch)
    found = seen.where("block is null")
    totals = found.groupBy("lang").agg(F.sum("n").alias("n"))
    words = scratch.keep(found.groupBy("k").agg(F.min("lang").alias("lang"), F.min("word").alias("word"), F.sum("n").alias("f")).where(F.col("f") >= least), "words")
    suffixes = scratch.keep(_suffixes(texts, _frequent_pairs(seen, bits, least), bits, max_n), "suffixes")
    phrases = scratch.keep(prefix_counts(suffixes, max_n, least), "phrases")
    scratch.drop("suffixes")
    return words, phrases, totals


def collocations(docs: DataFrame, max_n: int = 4, least: int = 30, top: int = 2000, covered: int = 80, lang_col: str = "lang", text_col: str = "text", bits: int = BITS) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) of each language's `top` phrases of 2 to max_n words that occur `least` times.

    a: occurrences of the phrase; l, r: of its two parts at the cut with the least score
    floor(2000000 * a / (l + r)), the earliest of equal ones; n: words of the language. Phrases that lie in a
    longer one with covered % of their occurrences or more are left out. Products are decimals, so none overflows.
    """
    scratch = Scratch(docs.sparkSession, "collocations")
    texts = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    words, phrases, totals = frequent_phrases(texts, scratch, max_n, least, bits)
    names = [f"k{i}" for i in range(max_n)]
    zero = F.lit(0).cast("long")

    def stretch(start: int, end: int) -> list[Column]:
        return [F.col(names[start + i]) if start + i < end else zero for i in range(max_n)]

    length = sum(((F.col(c) > 0).cast("int") for c in names), F.lit(0))
    f = phrases.unionByName(words.select(F.col("k").alias("k0"), *[zero.alias(c) for c in names[1:]], "f"))

    # longer phrases, for each phrase that they hold
    wide = lambda x: x.cast("decimal(38,0)")
    within = [(m, s, e) for m in range(3, max_n + 1) for s in range(m) for e in range(s + 2, m + 1) if e - s < m]
    inner = F.explode(F.array(*[F.when(length == m, F.struct(*[c.alias(n) for n, c in zip(names, stretch(s, e), strict=True)])) for m, s, e in within])).alias("p") if within else None
    left = phrases
    if within:
        longer = phrases.where(length >= 3).select(F.col("f").alias("longer"), inner).where("p is not null").groupBy(*[F.col(f"p.{c}").alias(c) for c in names]).agg(F.max("longer").alias("longer"))
        left = phrases.join(longer, names, "left").where(F.col("longer").isNull() | (100 * wide(F.col("longer")) < covered * wide(F.col("f")))).drop("longer")
    left = scratch.keep(left.withColumnRenamed("f", "a").withColumn("m", length), "left")

    # scores: each cut meets the counts of its parts
    parts = lambda cut, m: F.struct(F.lit(cut).alias("cut"), *[c.alias(f"x{i}") for i, c in enumerate(stretch(0, cut))], *[c.alias(f"y{i}") for i, c in enumerate(stretch(cut, m))])
    cuts = left.select(*names, "a", F.explode(F.array(*[F.when(F.col("m") == m, parts(c, m)) for m in range(2, max_n + 1) for c in range(1, m)])).alias("p")).where("p is not null").select(*names, "a", "p.*")
    side = lambda x, name: f.select(*[F.col(c).alias(f"{x}{i}") for i, c in enumerate(names)], F.col("f").alias(name))
    cuts = cuts.join(side("x", "l"), [f"x{i}" for i in range(max_n)]).join(side("y", "r"), [f"y{i}" for i in range(max_n)])
    score = F.expr("(cast(2000000 as decimal(38,0)) * a) div (cast(l as decimal(20,0)) + r)")
    scored = cuts.groupBy(*names, "a").agg(F.min(F.struct(score.alias("score"), "cut", "l", "r")).alias("s"))

    # words in place of numbers, then the first of each language
    spelled = scored.select(F.struct(*names).alias("p"), "a", "s", F.posexplode(F.array(*names)).alias("at", "k")).where("k > 0")
    spelled = spelled.join(words.select("k", "lang", "word"), "k").groupBy("p", "a", "s").agg(F.min("lang").alias("lang"), F.concat_ws(" ", F.transform(F.sort_array(F.collect_list(F.struct("at", "word"))), lambda x: x["word"])).alias("phrase"))
    rows = spelled.select("lang", "phrase", "a", "s.l", "s.r", "s.score")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # a language's phrases are first ranked in parts, each of which may hold all of its best
    some = rows.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(64))).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).where(F.col("rank") <= top)
    best = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return best.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
