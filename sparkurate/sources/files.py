"""Readers and writers of the catalog's files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import slug


def read_taxonomy(spark: SparkSession, path: str) -> DataFrame:
    """Entries of a taxonomy file: canonical, cas, ec, wikidata, pubchem, synonyms, parents, other_names (map of language).

    Blocks are separated by blank lines; the first English name is canonical, further ones are
    synonyms; of an identifier the first counts; blocks without an English name are left out.
    """
    text = spark.read.text(path, wholetext=True).select(F.monotonically_increasing_id().alias("file"), F.regexp_replace("value", "\r\n?", "\n").alias("value"))
    blocks = text.select("file", F.posexplode(F.split("value", "\n[ \\t]*\n")).alias("block", "body"))
    lines = blocks.select("file", "block", F.posexplode(F.split("body", "\n")).alias("at", "line")).where("trim(line) <> '' and not startswith(ltrim(line), '#')")
    parsed = lines.select(
        "file", "block", "at",
        F.regexp_extract("line", "^\\s*<\\s*en:\\s*(.*?)\\s*$", 1).alias("parent"),
        F.lower(F.regexp_extract("line", "^\\s*([A-Za-z_]+):[A-Za-z]{2}:\\s*(.*?)\\s*$", 1)).alias("prop"), F.regexp_extract("line", "^\\s*([A-Za-z_]+):[A-Za-z]{2}:\\s*(.*?)\\s*$", 2).alias("value"),
        F.lower(F.regexp_extract("line", "^\\s*([A-Za-z_]+):\\s*(.*?)\\s*$", 1)).alias("key"), F.regexp_extract("line", "^\\s*([A-Za-z_]+):\\s*(.*?)\\s*$", 2).alias("rest"),
    )
    names = F.filter(F.transform(F.split("rest", ","), lambda x: F.btrim(x)), lambda x: x != "")
    prop, value = F.when(F.col("prop") != "", F.col("prop")).otherwise(F.col("key")), F.when(F.col("prop") != "", F.col("value")).otherwise(F.col("rest"))
    is_name = (F.col("prop") == "") & (F.length("key") == 2)
    first = lambda pattern: F.min_by(F.when((~is_name) & prop.rlike(pattern), value), F.when((~is_name) & prop.rlike(pattern) & (value != ""), F.col("at")))
    ordered = lambda cond, v: F.flatten(F.transform(F.array_sort(F.collect_list(F.when(cond, F.struct("at", v.alias("v"))))), lambda x: x["v"]))
    english = ordered(is_name & (F.col("key") == "en"), names)
    others = F.map_from_entries(F.array_sort(F.collect_list(F.when(is_name & (F.col("key") != "en"), F.struct("key", names.alias("v"))))))
    entries = parsed.groupBy("file", "block").agg(
        english.alias("en"), first("^cas").alias("cas"), first("^ec").alias("ec"), first("^wikidata").alias("wikidata"), first("^pubchem").alias("pubchem"),
        ordered(F.col("parent") != "", F.array("parent")).alias("parents"), others.alias("other_names"),
    )
    return entries.where(F.size("en") > 0).select(F.get("en", F.lit(0)).alias("canonical"), F.slice("en", 2, 1_000_000).alias("synonyms"), "cas", "ec", "wikidata", "pubchem", "parents", "other_names", "file", "block")


PRODUCT = "code string, _id string, product_name string, brands string, ingredients_text string, ingredients_text_en string"


def read_products(spark: SparkSession, path: str) -> DataFrame:
    """(barcode, name, brand, ingredients_text) of a JSON-lines dump, gzipped or not; malformed lines and rows without a code go.

    A gzip file is one task's to read, so its rows are dealt out again.
    """
    rows = spark.read.schema(PRODUCT).option("mode", "DROPMALFORMED").json(path)
    rows = rows.repartition(spark.sparkContext.defaultParallelism) if path.endswith(".gz") else rows
    filled = lambda *cs: F.coalesce(*[F.nullif(F.col(c), F.lit("")) for c in cs])
    out = rows.select(filled("code", "_id").alias("barcode"), F.col("product_name").alias("name"), F.col("brands").alias("brand"), filled("ingredients_text_en", "ingredients_text").alias("ingredients_text"))
    return out.where("barcode is not null")


EDITORIAL = "what_it_does string, summary_short string, summary_long string, quick_facts array<string>"


def read_inbox(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(entries, rejected) of a folder with one JSON file per slug, in a code fence or not; all keys are required."""
    files = spark.read.text(path, wholetext=True, pathGlobFilter="*.json").select(F.regexp_extract(F.input_file_name(), "([^/]+)\\.json$", 1).alias("slug"), "value")
    body = F.btrim(F.regexp_replace(F.regexp_replace(F.btrim("value"), "(?s)^```[^\\n]*\\n", ""), "(?s)```\\s*$", ""))
    rows = files.withColumn("j", F.from_json(body, EDITORIAL))
    good = F.col("j").isNotNull() & F.expr("j.what_it_does is not null and j.summary_short is not null and j.summary_long is not null and j.quick_facts is not null")
    return rows.where(good).select("slug", "j.*"), rows.where(~F.coalesce(good, F.lit(False))).select("slug", F.lit("malformed or incomplete").alias("reason"))


def write_prompts(entries: DataFrame, path: str) -> None:
    """One text file per entry(name, abstracts array of struct<title, text>), in a folder named by its slug; entries without abstracts are left out."""
    cited = F.array_join(F.transform("abstracts", lambda a: F.concat(F.lit("## "), a["title"], F.lit("\n\n"), a["text"])), "\n\n")
    rows = entries.where(F.size("abstracts") > 0).select(slug("name").alias("slug"), F.concat(F.lit("# "), "name", F.lit("\n\nWrite a neutral summary of this ingredient from the abstracts below, as JSON.\n\n"), cited).alias("value"))
    rows.write.mode("overwrite").partitionBy("slug").text(path)


def write_top(counts: DataFrame, path: str) -> None:
    """A CSV file with a header of counts that are limited already."""
    counts.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def move_files(spark: SparkSession, path: str, names: DataFrame, target: str, suffix: str = ".json") -> int:
    """Move the files of names(slug) from one folder to another, and return how many there were; for an inbox, of which a person writes the files."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    to = jvm.org.apache.hadoop.fs.Path(target)
    fs = to.getFileSystem(conf)
    fs.mkdirs(to)
    moved = 0
    for row in names.select("slug").distinct().toLocalIterator():
        moved += fs.rename(jvm.org.apache.hadoop.fs.Path(f"{path}/{row.slug}{suffix}"), jvm.org.apache.hadoop.fs.Path(f"{target}/{row.slug}{suffix}"))
    return moved
