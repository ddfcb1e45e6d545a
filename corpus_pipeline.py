"""A corpus pipeline: quality, near duplicates, repeated passages, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which run() writes as Parquet and reads
again as the next stage's docs. All but the last return the columns of documents. Null texts go
through as empty ones, rows with null or repeated ids are documents of their own, and empty tables stay empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkurate.llm import mixing, ngram_join, packing, quality, substring_dedup
from sparkurate.llm.common import Scratch, table
from sparkurate.llm.queries import tokenizer_path

REST, ROW = "_rest", "_row"


def _with_rest(docs: DataFrame) -> DataFrame:
    """doc_id, text, and all columns in one, so that no other column's name can clash."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.struct("*").alias(REST))


def _columns(rows: DataFrame, docs: DataFrame, text: str | None = None) -> DataFrame:
    """The columns of docs from _with_rest's; with another text, n_chars follows it."""
    new = {"text": F.col(text), "n_chars": F.char_length(text).cast("long")} if text else {}
    return rows.select(*[new.get(c, F.col(f"{REST}.`{c}`")).alias(c) for c in docs.columns])


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are at least as likely good as not, by a classifier fitted on the labels (20,000 of them at most)."""
    model = quality.fit_on_labels(docs, table(spark, sf_dir, "labels"), quality.safe_grade(), n_grades=3)
    return _columns(quality.graded(_with_rest(docs), model, wanted=2).where("keep"), docs)


def _numbered(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """_with_rest's columns and a number for each row, written so that it stays: ids may be null or repeated. Texts are written once."""
    rows = scratch.keep(docs.select(F.struct("*").alias(REST), F.monotonically_increasing_id().alias(ROW)), "numbered")
    return rows.select(F.col(f"{REST}.doc_id").cast("long").alias("doc_id"), F.col(f"{REST}.text").cast("string").alias("text"), REST, ROW)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (five words, a similarity of 0.8) the row with the smallest id; a null id is the largest."""
    scratch = Scratch(spark, "near")
    rows = _numbered(docs, scratch)
    groups = ngram_join.ngram_jaccard_components(rows, n=5, num=80, den=100, id_col=ROW)
    groups = scratch.keep(groups.select(F.col("doc_id").alias(ROW), "component_id"), "groups")
    ids = rows.select(ROW, "doc_id").join(groups, ROW)
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", ROW)).alias("first")
    stay = ids.groupBy("component_id").agg(first).select(F.col(f"first.{ROW}").alias(ROW))
    return _columns(rows.join(stay, ROW, "left_semi"), docs)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of 50 words and more that occur again anywhere."""
    left = substring_dedup.removed_spans(_with_rest(docs), depth=50, unit="words", keep_text=True)
    return _columns(left, docs, "kept")


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at weights 3, 1, 2 and so on, 150 % of all words, each source twice at most.

    A document is there as often as it is taken; the one at a source's cut gives its first words.
    """
    rows = _numbered(docs, Scratch(spark, "mixed"))
    sized = rows.select("doc_id", "text", F.col(f"{REST}.source").alias("source"), ROW)
    taken = mixing.mix_sources(sized, weights=[3, 1, 2], share=1.5, most=2.0, carry=[ROW]).where("taken > 0").select(ROW, "size", "taken")
    rows = rows.join(taken, ROW)
    full, rest = F.floor(F.col("taken") / F.col("size")).cast("int"), (F.col("taken") % F.col("size")).cast("int")
    parts = F.concat(F.array_repeat(F.lit(0), full), F.when(rest > 0, F.array(rest)).otherwise(F.array().cast("array<int>")))
    rows = rows.withColumn("_part", F.explode(parts))
    space = "[\\x20\\x09-\\x0D]+"
    after = F.element_at(F.split("text", space, F.col("_part") + 1 + F.col("text").rlike(f"^{space}").cast("int")), -1)
    first_words = F.expr("substring(text, 1, length(text) - length(_after))")
    rows = rows.withColumn("_after", F.when(F.col("_part") > 0, after)).withColumn("_text", F.when(F.col("_part") > 0, F.rtrim(first_words)).otherwise(F.col("text")))
    return _columns(rows, docs, "_text")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of 2048 tokens at most: a row for each piece of a document, with its place."""
    return packing.packed_sequences(docs, tokenizer_path(), capacity=2048, end_id=0)


STAGES = [
    ("quality classifier", good_documents),
    ("n-gram Jaccard join", one_of_each),
    ("suffix-array dedup", without_repeats),
    ("mixing sources", mixed),
    ("best-fit packing", packed),
]

#: SQL can express neither the classifier nor the tokenizer; tests/llm hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scratch = Scratch(spark, "pipeline")
    for i, (_, stage) in enumerate(STAGES):
        docs = scratch.keep(stage(spark, docs, sf_dir), f"stage{i}")
    return docs
