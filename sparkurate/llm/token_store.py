"""Content-addressed store of token ids.

A document's ids are cut into chunks where a rolling hash of the last WINDOW ids has its low bits
zero, so that equal stretches of ids give equal chunks wherever they stand. Chunks are addressed by
a digest of their ids, and each is stored once. A document's recipe lists the addresses, in order.

Layout of a store (a folder that Spark can write to):

    objects/kind=chunk   address binary, payload binary (zstd of little-endian ids of `width` bytes)
    manifest/            range long, doc_id, n_tokens, start, addresses binary, root binary
                         rows in ascending doc_id order (nulls first), start: ids of all before it
    roots/               range long, n_documents, n_tokens, root binary

`root` is the root of a Merkle tree over a document's chunk addresses, and in roots/ over the roots of
the documents of a range, of 1,024 in their order. Reading checks each chunk against its address, each document against
its root and length, and each range against its root; it raises on the first difference.

Nothing but the recipes is sorted; ids are shuffled once when written, as chunks, after each batch
has dropped its own repeats, so that a chunk that is everywhere is a row per batch. A null text is
empty. Rows that repeat an id are documents of their own, in the order of their roots. An empty
table gives an empty store.
"""

from __future__ import annotations

import hashlib
import zlib
from functools import partial

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import U64, Scratch, arrow_map, batch, constants, mix, prefix_sums, release_shuffles
from .tokens import word_ids

WINDOW = 8
ADDRESS = 16  # bytes
RANGE = 1024  # documents under a root of the manifest
MULTIPLIER = constants(1, 31)[0]


def chunk_ends(ids: np.ndarray, bits: int = 9, least: int = 128, most: int = 4096) -> list[int]:
    """Ends of the chunks of an id array: where the rolling hash says, from `least` to `most` ids apart."""
    n = len(ids)
    if n <= least:
        return [n] if n else []
    h = np.cumsum(mix(ids.astype(np.uint64) + U64(1)), dtype=np.uint64)
    h[WINDOW:] -= h[:-WINDOW].copy()  # sums of the last WINDOW ids' hashes
    marks = np.flatnonzero(h * MULTIPLIER < U64(1 << (64 - bits))) + 1
    ends, last = [], 0
    while n - last > most or len(marks):
        i = int(np.searchsorted(marks, last + least))
        end = int(marks[i]) if i < len(marks) else n
        end = min(end, last + most, n)
        if end == n:
            break
        ends.append(end)
        last = end
        marks = marks[np.searchsorted(marks, last + least) :]
    return [*ends, n]


def address(payload: bytes) -> bytes:
    return hashlib.blake2b(payload, digest_size=ADDRESS).digest()


def merkle(leaves: list[bytes]) -> bytes:
    """Root of the binary tree of digests; an odd one goes up as it is; of none: the digest of nothing."""
    if not leaves:
        return address(b"")
    level = [address(b"\0" + x) for x in leaves]
    while len(level) > 1:
        pairs = [address(b"\1" + level[i] + level[i + 1]) for i in range(0, len(level) - 1, 2)]
        level = pairs + level[len(level) & ~1 :]
    return level[0]


_OBJECT = pa.schema([("route", pa.int64()), ("kind", pa.string()), ("address", pa.binary()), ("payload", pa.binary()), ("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("addresses", pa.binary()), ("root", pa.binary())])
_OBJECT_SQL = "route long, kind string, address binary, payload binary, doc_id long, n_tokens long, addresses binary, root binary"


def _objects(tokenizer: str, end: bytes, width: int, batches):
    ids_of, press = word_ids(tokenizer), zstandard.ZstdCompressor(level=1)
    kind = "<u2" if width == 2 else "<u4"
    for b in batches:
        chunks: dict[bytes, bytes] = {}
        recipes = []
        for d, got in zip(b.column(0).to_pylist(), ids_of.documents(b.column(1)), strict=True):
            ids = np.frombuffer(got + end, "<u4")
            raw = ids.astype(kind).tobytes()
            leaves, last = [], 0
            for e in chunk_ends(ids):
                part = raw[width * last : width * e]
                leaves.append(address(part))
                if leaves[-1] not in chunks:
                    chunks[leaves[-1]] = part
                last = e
            recipes.append((d, len(ids), b"".join(leaves), merkle(leaves)))
        n, m = len(chunks), len(recipes)
        # recipes need no company: those of equal documents are dealt out by their place
        route = np.frombuffer(b"".join([a[:8] for a in chunks] + [r[3][:8] for r in recipes]), "<u8").copy()
        route[n:] = mix(route[n:] + np.arange(m, dtype=np.uint64))
        route = route.view(np.int64)
        one = [list(c) for c in zip(*recipes, strict=True)] if recipes else [[]] * 4
        yield batch(_OBJECT, [route, ["chunk"] * n + ["recipe"] * m, [*chunks, *[None] * m], [*map(press.compress, chunks.values()), *[None] * m], [None] * n + one[0], [None] * n + one[1], [None] * n + one[2], [None] * n + one[3]])


def _once(batches):
    """Chunks that are sorted by address, each once; recipes as they are."""
    last = None
    for b in batches:
        keep = []
        for k, a in zip(b.column("kind").to_pylist(), b.column("address").to_pylist(), strict=True):
            keep.append(k == "recipe" or a != last)
            last = a if k == "chunk" else last
        yield b.filter(pa.array(keep))


def _write_objects(texts: DataFrame, path: str, make) -> None:
    made = texts.transform(arrow_map, make, _OBJECT_SQL).repartition("route").sortWithinPartitions("kind", "address").transform(arrow_map, _once, _OBJECT_SQL)
    made.drop("route").write.partitionBy("kind").option("compression", "none").parquet(f"{path}/objects")  # payloads are compressed, and digests can't be


def write_store(docs: DataFrame, path: str, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> None:
    spark = docs.sparkSession
    width = 2 if max(word_ids(tokenizer).tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16 else 4
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    _write_objects(texts, path, partial(_objects, tokenizer, int(end_id).to_bytes(4, "little"), width))
    release_shuffles(spark)
    recipes = _read(spark, f"{path}/objects").where("kind = 'recipe'").select("doc_id", "n_tokens", "addresses", "root", F.lit(0).cast("long").alias("start"))
    scratch = Scratch(spark, "store")
    order = [F.col("doc_id").asc_nulls_first(), F.col("root")]
    placed = prefix_sums(recipes.withColumn("place", F.lit(0).cast("long")), order, {"start": F.col("n_tokens"), "place": F.lit(1)}, scratch, "recipes")
    ranges = placed.repartitionByRange("start").sortWithinPartitions("start").withColumn("range", F.floor(F.col("place") / RANGE).cast("long"))
    ranges.select("range", "doc_id", "start", "n_tokens", "addresses", "root", F.lit(width).alias("width")).write.option("compression", "zstd").parquet(f"{path}/manifest")
    _roots(spark, path).write.parquet(f"{path}/roots")
    scratch.drop("")


def _read(spark: SparkSession, path: str) -> DataFrame:
    schema = "address binary, payload binary, doc_id long, n_tokens long, addresses binary, root binary, kind string"
    return spark.read.schema(schema).parquet(path)


def _manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("range long, doc_id long, start long, n_tokens long, addresses binary, root binary, width int").parquet(f"{path}/manifest")


def _roots(spark: SparkSession, path: str) -> DataFrame:
    """A Merkle root for each RANGE documents of the manifest, in their order."""
    leaves = F.sort_array(F.collect_list(F.struct("start", "root")))
    by_range = _manifest(spark, path).groupBy("range").agg(F.count("*").alias("n_documents"), F.sum("n_tokens").alias("n_tokens"), leaves.alias("leaves"))
    out = pa.schema([("range", pa.int64()), ("n_documents", pa.int64()), ("n_tokens", pa.int64()), ("root", pa.binary())])

    def tree(batches):
        for b in batches:
            yield batch(out, [*b.columns[:3], [merkle([x["root"] for x in v]) for v in b.column(3).to_pylist()]])

    return by_range.transform(arrow_map, tree, "range long, n_documents long, n_tokens long, root binary")


_DOCUMENT = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary()), ("ids_crc32", pa.int64())])


def _documents(with_ids: bool, batches):
    unpress = zstandard.ZstdDecompressor()
    for b in batches:
        rows = []
        parts = b.column(5)
        ends = parts.offsets.to_numpy() - parts.offsets[0].as_py()
        flat = parts.flatten()
        addresses, payloads = flat.field("address").to_pylist(), flat.field("payload").to_pylist()
        for r, (d, s, n, root, width) in enumerate(zip(*(b.column(i).to_pylist() for i in range(5)), strict=True)):
            at = slice(ends[r], ends[r + 1])
            if None in payloads[at]:
                raise ValueError(f"document {d} at {s}: a chunk is missing")
            raws = [unpress.decompress(p) for p in payloads[at]]
            leaves = [address(x) for x in raws]
            if leaves != addresses[at] or merkle(leaves) != root:
                raise ValueError(f"document {d} at {s}: a chunk differs from its address, or the tree from its root")
            ids = np.frombuffer(b"".join(raws), "<u2" if width == 2 else "<u4").astype("<u4").tobytes()
            if len(ids) != 4 * n:
                raise ValueError(f"document {d} at {s}: {len(ids) // 4} ids where {n} were written")
            rows.append((d, s, n, ids if with_ids else None, zlib.crc32(ids)))
        if rows:
            yield batch(_DOCUMENT, [list(c) for c in zip(*rows, strict=True)])


def read_store(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """(doc_id, start, n_tokens, ids, ids_crc32) of each document, verified; ids: little-endian unsigned 32-bit."""
    differ = _roots(spark, path).join(spark.read.schema("range long, n_documents long, n_tokens long, root binary").parquet(f"{path}/roots"), ["range", "n_documents", "n_tokens", "root"], "left_anti")
    if differ.take(1):
        raise ValueError("the manifest differs from its roots")
    release_shuffles(spark)
    recipes = _manifest(spark, path)
    size = ADDRESS
    steps = recipes.select("doc_id", "start", "n_tokens", "root", "width", F.posexplode(F.expr(f"transform(sequence(0, cast(length(addresses) / {size} as int) - 1), i -> substring(addresses, i * {size} + 1, {size}))")).alias("i", "address"))
    chunks = _read(spark, f"{path}/objects").where("kind = 'chunk'").select("address", "payload")
    met = steps.select("start", "i", "address").join(chunks, "address", "left")
    parts = met.groupBy("start").agg(F.array_sort(F.collect_list(F.struct("i", "address", "payload"))).alias("parts"))
    whole = recipes.join(parts, "start").select("doc_id", "start", "n_tokens", "root", "width", "parts")
    return whole.transform(arrow_map, partial(_documents, with_ids), "doc_id long, start long, n_tokens long, ids binary, ids_crc32 long")
