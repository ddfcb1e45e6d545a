"""N-gram Jaccard join by token-combination prefixes.

A token is the 64-bit hash of an n-word shingle. Tokens have one global order, rarest first, from
counts over all documents, and one of two classes: rare or frequent. A document's prefix is extended
until

    rare tokens in it + sum over groups g of max(0, frequent tokens of g in it - 1) >= errors + 1,

where errors is the number of tokens in which a linked partner may differ. Of two linked documents,
let x be the one whose prefix ends first. The tokens of x's prefix that y has are in y's prefix too.
If they had no rare token and at most one frequent token of each group in common, x would miss more
tokens than errors. So they share a rare token or a pair of frequent tokens of one group, and it is
enough to index single rare tokens and those pairs. Groups (by hash) keep the number of pairs
linear in the document's size; how many there are depends on its size class, and a document whose
partners can be in a neighbouring class is indexed under both.

Candidates are not all pairs of a posting list. Each list has two pivots (its smallest document, and
one at random), and all others are verified against these, which is linear. The pivots are done then,
and so are lists whose other members are one component; of lists with the same other members one is
gone through. In it each document outside the largest component is compared with all of the other
components' documents, in blocks, through an upper bound of the intersection from small histograms,
unless the two met in another list, and what passes is verified. So no link that joins two components
is lost, and a group of thousands of near copies costs no quadratic work.

Null or blank texts have no tokens and no links. Rows with a null id have a null component. Rows
that repeat an id count as one document: they link with whatever any of their texts links with.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import (
    U64,
    Scratch,
    arrow_map,
    batch,
    binary_rows,
    components,
    emit_counters,
    id_bitmap,
    in_bitmap,
    mix,
    only_ids,
    release_shuffles,
    shingle_set,
    sum_counters,
)

BITS = 20  # of the counters that tokens' frequencies are kept in
BINS = 256  # of the histogram that bounds an intersection
FULL = 65_535  # tokens that a bin counts up to
LOW = 32  # keys that tell where two documents met already
UNIT = 40  # documents of UNIT * 4**c tokens and more are in size class c


def errors_allowed(n: int, num: int, den: int) -> int:
    """Tokens of a set of n that a linked partner may lack: n - ceil(n * num / den)."""
    return n - -(-n * num // den)


def size_class(n: int) -> int:
    """-1 below UNIT tokens, where single tokens are indexed whatever their class."""
    c = -1
    while n >= UNIT * 4 ** (c + 1):
        c += 1
    return c


def signatures(tokens: np.ndarray, counts: np.ndarray, frequent: int, num: int, den: int) -> np.ndarray:
    """Hashes of the rare tokens and pairs of frequent tokens that the document is indexed under."""
    n = len(tokens)
    if not n:
        return tokens
    need = errors_allowed(n, num, den) + 1
    f = counts[(tokens >> U64(64 - BITS)).astype(np.int64)]
    order = np.lexsort((tokens, f))
    t, f = tokens[order], f[order]
    out = []
    for c in range(size_class(-(-n * num // den)), size_class(n * den // num) + 1):
        if c < 0:
            out.append(mix(t[:need] + U64(1)))
            continue
        rare = int(np.searchsorted(f, frequent, side="right"))
        if rare >= need:
            out.append(mix(t[:need] + U64(2)))
            continue
        groups = max(1, UNIT * 4**c * num * num // (den * den) - 1)  # so few that need is met within n tokens
        g = (mix(t[rare:] + U64(7)) % U64(groups)).astype(np.int64)
        by = np.argsort(g, kind="stable")
        first = np.ones(len(g), bool)
        first[by[1:]] = g[by[1:]] != g[by[:-1]]
        got = rare + np.cumsum(~first)
        end = int(np.searchsorted(got, need)) + 1 if got[-1] >= need else len(g)
        g, p = g[:end], t[rare : rare + end]
        out.append(mix(t[:rare] + U64(2)))
        by = np.argsort(g, kind="stable")
        g, p = g[by], p[by]
        starts = np.flatnonzero(np.r_[True, g[1:] != g[:-1]])
        for a, b in zip(starts, np.r_[starts[1:], len(g)], strict=True):
            if b - a > 1:
                i, j = np.triu_indices(b - a, 1)
                out.append(mix(mix(p[a:b][i]) + mix(p[a:b][j]) + U64(3)))
    return np.unique(np.concatenate(out)) if out else t[:0]


def histogram(tokens: np.ndarray) -> bytes:
    h = np.bincount((tokens & U64(BINS - 1)).astype(np.int64), minlength=BINS)
    return np.minimum(h, FULL).astype("<u2").tobytes()


def most_common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Upper bounds of the intersections of sets with these histograms; a bin that is full in both says nothing."""
    least = np.minimum(a, b)
    return np.where((least == FULL).any(1), np.iinfo(np.int32).max, least.sum(1, dtype=np.int64))


def _linked(inter, n, m, num: int, den: int):
    return (inter > 0) & ((den + num) * inter >= num * (n + m))


def _sizes_fit(a: str, b: str, num: int, den: int):
    return F.expr(f"{a} * {num} <= {b} * {den} and {b} * {num} <= {a} * {den}")


class _Indexed(NamedTuple):
    ids: DataFrame  # doc_id, text
    signed: DataFrame  # doc_id, n, h1, h2, hist, keys
    classes: DataFrame  # h1, h2, n, rep
    hists: DataFrame  # doc_id, hist, n
    postings: DataFrame  # key, doc_id, n


def _indexed(docs: DataFrame, n: int, num: int, den: int, id_col: str, text_col: str, scratch: Scratch) -> _Indexed:
    """Signatures of the documents, and one document for each class of equal sets in the posting lists."""
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    ids = docs.where("doc_id is not null")

    # Counts of tokens over all documents, in a fixed number of hashed counters.
    def count(batches):
        total = np.zeros(1 << BITS, np.int64)
        for b in batches:
            for t in binary_rows(b.column(0)):
                s = shingle_set(t, n)
                if len(s):
                    np.add.at(total, (s >> U64(64 - BITS)).astype(np.int64), 1)
        yield from (batch(counter, [[k], [v]]) for k, v in emit_counters(total))

    counter = pa.schema([("block", pa.int32()), ("counts", pa.binary())])
    counts = sum_counters(docs.select("text").transform(arrow_map, count, "block int, counts binary"), BITS)
    frequent = int(2 * counts.sum() / len(counts)) + 64
    shared = spark.sparkContext.broadcast(np.minimum(counts, 2**32 - 1).astype(np.uint32))

    # Signatures, and what tells classes of equal sets apart.
    made = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("h1", pa.int64()), ("h2", pa.int64()), ("hist", pa.binary()), ("keys", pa.list_(pa.int64()))])

    def sign(batches):
        for b in batches:
            rows = []
            for i, t in zip(b.column(0).to_pylist(), binary_rows(b.column(1)), strict=True):
                s = shingle_set(t, n)
                k = signatures(s, shared.value, frequent, num, den) if i is not None else s[:0]
                h = [int(x.astype(np.int64)) for x in (mix(s).sum(dtype=U64), mix(s ^ U64(0x5555)).sum(dtype=U64))]
                rows.append((i, len(s), *h, histogram(s) if len(s) else None, k.view(np.int64)))
            yield batch(made, [list(c) for c in zip(*rows, strict=True)])

    signed = scratch.keep(docs.transform(arrow_map, sign, "doc_id long, n long, h1 long, h2 long, hist binary, keys array<long>"), "signed")
    classes = signed.where("n > 0 and doc_id is not null").groupBy("h1", "h2", "n").agg(F.min("doc_id").alias("rep"))
    classes = scratch.keep(classes, "classes")
    reps = signed.join(classes.select(F.col("rep").alias("doc_id"), "h1", "h2", "n"), ["doc_id", "h1", "h2", "n"], "left_semi")
    postings = reps.select(F.explode("keys").alias("key"), "doc_id", "n")
    hists = signed.where("n > 0 and doc_id is not null").select("doc_id", "hist", "n")
    return _Indexed(ids, signed, classes, hists, postings)


def _sizes(signed: DataFrame, classes: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, rep) for each row: rep is the smallest id with an equal set, itself included."""
    sizes = signed.select("doc_id", F.col("n").alias("n_shingles"), "h1", "h2")
    sizes = sizes.join(classes.withColumnRenamed("n", "n_shingles"), ["h1", "h2", "n_shingles"], "left")
    return sizes.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("rep", "doc_id")).alias("rep"))


def set_sizes_and_links(docs: DataFrame, n: int = 5, num: int = 80, den: int = 100, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(id, n_shingles, class representative) for each row, and (node, component) for representatives with links."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "ngram")
    ids, signed, classes, hists, postings = _indexed(docs, n, num, den, id_col, text_col, scratch)

    # First round: everyone against the list's pivots.
    lists = postings.groupBy("key").agg(F.count("*").alias("m"), F.min(F.struct("doc_id", "n")).alias("p"), F.min(F.struct(F.xxhash64("key", "doc_id").alias("h"), "doc_id", "n")).alias("q")).where("m > 1")
    lists = scratch.keep(lists, "lists")  # written, so that Spark may split a long list when it joins
    release_shuffles(spark)
    listed = scratch.keep(postings.join(lists.select("key", "m", "p", F.struct("q.doc_id", "q.n").alias("q")), "key"), "listed")
    release_shuffles(spark)  # here and below: shuffles are several times the tables that are written from them
    pairs = listed.select("doc_id", "n", F.explode(F.array("p", "q")).alias("o"))
    pairs = pairs.where("doc_id <> o.doc_id").where(_sizes_fit("n", "o.n", num, den))
    pairs = pairs.select(F.least("doc_id", "o.doc_id").alias("a"), F.greatest("doc_id", "o.doc_id").alias("b")).distinct()
    tried = scratch.keep(pairs, "tried")
    release_shuffles(spark)
    links = scratch.keep(_verified(tried, ids, hists, n, num, den, scratch, "left"), "links")
    release_shuffles(spark)
    nodes = scratch.keep(components(links, scratch), "nodes")

    # Second round: lists that hold several components yet. All members have met the pivots, so these are left
    # out, and of lists that have the same members then one is enough.
    rest = listed.where("m > 2 and not (doc_id = p.doc_id and n = p.n) and not (doc_id = q.doc_id and n = q.n)").select("key", "doc_id", "n")
    # sums as decimals don't overflow; an exclusive or would not see ids that a list holds twice
    members = [F.sum(F.xxhash64(F.lit(salt), "doc_id", "n").cast("decimal(20,0)")).alias(f"s{salt}") for salt in (1, 2)]
    once = rest.groupBy("key").agg(F.count("*").alias("m"), *members).where("m > 1").groupBy("m", "s1", "s2").agg(F.min("key").alias("key"))
    rest = rest.join(scratch.keep(once.select("key"), "once"), "key", "left_semi")
    label = nodes.select(F.col("node").alias("doc_id"), "component")
    open_lists = rest.join(label, "doc_id", "left").withColumn("component", F.coalesce("component", "doc_id"))
    by_part = open_lists.groupBy("key", "component").agg(F.count("*").alias("c"))
    largest = by_part.groupBy("key").agg(F.max(F.struct("c", "component")).alias("x"), F.count("*").alias("parts"), F.sum("c").alias("m")).where("parts > 1")
    largest = scratch.keep(largest, "largest")
    open_lists = open_lists.join(largest.select("key", F.col("x.component").alias("main"), (F.col("m") - F.col("x.c")).alias("others"), "m"), "key")
    open_lists = scratch.keep(open_lists, "open")
    more = scratch.keep(_across(open_lists, hists, num, den).join(tried, ["a", "b"], "left_anti"), "more")
    release_shuffles(spark)
    links = links.unionByName(scratch.keep(_verified(more, ids, hists, n, num, den, scratch, "left2"), "links2"))
    release_shuffles(spark)
    nodes = scratch.keep(components(links, scratch, "cd"), "nodes2")
    sizes = _sizes(signed, classes)
    result = Scratch(spark, "ngram-result")
    sizes, nodes = result.keep(sizes, "sizes"), result.keep(nodes, "nodes")
    scratch.drop("")  # signatures and lists are several times the result
    release_shuffles(spark)
    return sizes, nodes


def _across(open_lists: DataFrame, hists: DataFrame, num: int, den: int, side: int = 768, other: int = 1024) -> DataFrame:
    """Pairs (a, b) of different components on one list that the histograms don't rule out.

    Members outside the largest component (all, where main is null) are dealt out in cells of about
    `side`; all members meet them there, dealt out again by `other` where the list is long. A task
    streams through its cells. Each member knows the least keys of its lists: two members that share a
    lesser key than their list's met there. Of what they share the least is always gone through.
    """
    low = open_lists.groupBy("doc_id", "n").agg(F.slice(F.array_sort(F.collect_set("key")), 1, LOW).alias("low"))
    rows = open_lists.join(low, ["doc_id", "n"]).join(hists.select("doc_id", "hist"), "doc_id")
    cells, splits = F.ceil(F.col("others") / side).cast("int"), F.ceil(F.col("m") / other).cast("int")
    h = F.xxhash64("doc_id")
    asks = rows.where("not component <=> main").select(F.col("key"), F.pmod(h, cells).cast("int").alias("i"), F.explode(F.sequence(F.lit(0), splits - 1)).alias("j"), F.lit(0).alias("role"), "doc_id", "n", "component", "hist", "low")
    all_ = rows.select("key", F.explode(F.sequence(F.lit(0), cells - 1)).alias("i"), F.pmod(F.xxhash64(h), splits).cast("int").alias("j"), F.lit(1).alias("role"), "doc_id", "n", "component", "hist", "low")
    dealt = asks.unionByName(all_).repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "role")
    out = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def compare(batches):
        cell, held = None, None
        for b in batches:
            k = np.stack([b.column(x).to_numpy(zero_copy_only=False).astype(np.int64) for x in range(4)], 1)
            ids, n, comp = (b.column(x).to_numpy(zero_copy_only=False) for x in (4, 5, 6))
            hist = np.frombuffer(b"".join(b.column(7).to_pylist()), "<u2").reshape(-1, BINS)
            low = np.full((len(k), LOW), np.iinfo(np.int64).max)
            for r, x in enumerate(b.column(8).to_pylist()):
                low[r, : len(x)] = x
            cuts = np.flatnonzero(np.r_[True, (k[1:] != k[:-1]).any(1)])
            found_a, found_b = [], []
            for s, e in zip(cuts, np.r_[cuts[1:], len(k)], strict=True):
                here = tuple(k[s, :3])
                if k[s, 3] == 0:
                    part = (ids[s:e], n[s:e], comp[s:e], hist[s:e], low[s:e])
                    held = tuple(np.concatenate(x) for x in zip(held, part, strict=True)) if cell == here else part
                    cell = here
                    continue
                if cell != here:
                    continue
                for r in range(s, e):
                    ok = (held[2] != comp[r]) & (held[0] != ids[r]) & (held[1] * num <= n[r] * den) & (n[r] * num <= held[1] * den)
                    w = np.flatnonzero(ok)
                    if len(w):
                        w = w[_linked(most_common(held[3][w], hist[r]), held[1][w], n[r], num, den)]
                        w = w[~np.isin(held[4][w], low[r][low[r] < here[0]]).any(1)]
                        found_a.append(np.minimum(held[0][w], ids[r]))
                        found_b.append(np.maximum(held[0][w], ids[r]))
            if found_a:
                yield batch(out, [np.concatenate(found_a), np.concatenate(found_b)])

    return dealt.transform(arrow_map, compare, "a long, b long").distinct()


def _verified(pairs: DataFrame, docs: DataFrame, hists: DataFrame, n: int, num: int, den: int, scratch: Scratch, name: str) -> DataFrame:
    """The pairs (a, b) that link, by their whole texts; a histogram bound goes first."""
    one, two = hists.select(F.col("doc_id").alias("a"), F.col("hist").alias("ha"), F.col("n").alias("na")), hists.select(F.col("doc_id").alias("b"), F.col("hist").alias("hb"), F.col("n").alias("nb"))
    out = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def bound(batches):
        for b in batches:
            x, y = (np.frombuffer(b"".join(b.column(c).to_pylist()), "<u2").reshape(-1, BINS) for c in ("ha", "hb"))
            ok = _linked(most_common(x, y), *(b.column(c).to_numpy(zero_copy_only=False) for c in ("na", "nb")), num, den)
            if ok.any():
                yield batch(out, [b.column(c).filter(pa.array(ok)) for c in ("a", "b")])

    left = scratch.keep(pairs.join(one, "a").join(two, "b").transform(arrow_map, bound, "a long, b long").distinct(), name)
    release_shuffles(pairs.sparkSession)
    bitmap = id_bitmap(left.select("a").union(left.select("b")))
    texts = only_ids(docs, bitmap)

    def verify(batches):
        last: tuple[bytes | None, np.ndarray] = (None, np.empty(0, np.uint64))
        for b in batches:
            keep = np.zeros(b.num_rows, bool)
            for r, (x, y) in enumerate(zip(binary_rows(b.column(2)), binary_rows(b.column(3)), strict=True)):
                if x != last[0]:
                    last = (x, shingle_set(x, n))
                p, q = last[1], shingle_set(y, n)
                both = np.concatenate([p, q])
                both.sort()
                keep[r] = _linked(int((both[1:] == both[:-1]).sum()), len(p), len(q), num, den)
            if keep.any():
                yield batch(out, [b.column(c).filter(pa.array(keep)) for c in (0, 1)])

    met = left.join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("tb")), "b").join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("ta")), "a")
    return met.select("a", "b", "ta", "tb").transform(arrow_map, verify, "a long, b long").distinct()


def ngram_jaccard_components(docs: DataFrame, n: int = 5, num: int = 80, den: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) for each row: links are pairs with Jaccard similarity of at least num / den."""
    sizes, nodes = set_sizes_and_links(docs, n, num, den, id_col, text_col)
    out = sizes.join(nodes.withColumnRenamed("node", "rep"), "rep", "left")
    return out.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "rep")).alias("component_id"))


def ngram_jaccard_links(docs: DataFrame, n: int = 5, num: int = 80, den: int = 100, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """The whole join: (doc_id, n_shingles, rep) for each row, and (a, b), a < b, for every linked pair of representatives.

    Rows of one rep have equal sets, so they link with each other and with what their rep links with.
    Every two members of a posting list meet in cells, as the result may hold all of them; where
    components are enough, ngram_jaccard_components looks at far fewer pairs.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "ngram-links")
    ids, signed, classes, hists, postings = _indexed(docs, n, num, den, id_col, text_col, scratch)
    lists = scratch.keep(postings.groupBy("key").agg(F.count("*").alias("m")).where("m > 1"), "lists")
    open_lists = postings.join(lists, "key").select("key", "doc_id", "n", F.col("doc_id").alias("component"), F.lit(None).cast("long").alias("main"), F.col("m").alias("others"), "m")
    open_lists = scratch.keep(open_lists, "open")
    pairs = scratch.keep(_across(open_lists, hists, num, den), "pairs")
    links = _verified(pairs, ids, hists, n, num, den, scratch, "left")
    result = Scratch(spark, "ngram-links-result")
    sizes, links = result.keep(_sizes(signed, classes), "sizes"), result.keep(links, "links")
    scratch.drop("")
    return sizes, links
