"""Submissions: what is applied to the catalog, what a reviewer reads, and the record of runs."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.text import brand_key, diff_key, hashed_slug, inci_normalize, product_slug
from ..functions.web import age_bucket
from ..operators.formulas import as_lists, identity_match
from ..operators.tables import insert_missing, latest

DONE = ("matched", "new_ingredient", "junk")


def _hashed(*parts: Column | str) -> Column:
    """SHA-256 of the parts, told apart whatever they hold; null isn't the empty text."""
    texts = [(F.col(p) if isinstance(p, str) else p).cast("string") for p in parts]
    return F.sha2(F.to_json(F.array(*[F.struct(t.alias("v")) for t in texts])), 256)


def apply_submissions(tables: dict[str, DataFrame], submissions: DataFrame, tokens: DataFrame, actor: str = "system") -> dict[str, DataFrame]:
    """Decided submissions as new brands, entries, aliases, products and items, with their new states and an audit.

    tables: brands(normalized, name), entries(id, name, normalized_name), aliases(id, alias), products
    (product_id, brand, name, slug), items(product_id, position, id). submissions(id, brand, name, status), tokens(id,
    position, raw_token, resolution, canonical_name, entry_id). Guards: every token is decided, at least one is
    kept, and the product isn't there yet; what fails them gets the state failed or duplicate. Ids are
    hashes of what they stand for, so that a second run makes the same rows.
    """
    ready = submissions.where("status = 'decision_ready'")
    made_id = lambda *c: F.substring(_hashed(*c), 1, 32)
    state = tokens.groupBy("id").agg(F.every(F.col("resolution").isin(*DONE)).alias("decided"), F.count_if(F.col("resolution") != "junk").alias("kept"))
    known = identity_match(ready.select(F.col("id").alias("input"), "brand", "name"), tables["products"]).select(F.col("input").alias("id"), F.col("product_id").alias("existing"))
    judged = ready.join(state, "id", "left").join(known, "id", "left")
    status = F.when(~F.coalesce("decided", F.lit(False)) | (F.coalesce("kept", F.lit(0)) == 0), "failed").when(F.col("existing").isNotNull(), "duplicate").otherwise("applied")
    judged = judged.withColumn("new_status", status)
    good = judged.where("new_status = 'applied'").select("id", "brand", "name", made_id(brand_key("brand"), inci_normalize("name")).alias("product_id"))
    # of several submissions of one product the smallest is applied
    first = good.groupBy("product_id").agg(F.min("id").alias("id"))
    good = good.join(first, ["product_id", "id"], "left_semi")
    kept = tokens.join(good.select("id", "product_id"), "id").where("resolution <> 'junk'")
    fresh = kept.where("resolution = 'new_ingredient'").select(F.coalesce("canonical_name", "raw_token").alias("name")).withColumn("normalized_name", inci_normalize("name")).where("normalized_name <> ''")
    fresh = fresh.groupBy("normalized_name").agg(F.min("name").alias("name")).withColumn("id", made_id("normalized_name"))
    entries = insert_missing(tables["entries"], fresh.select("id", "name", "normalized_name"), ["normalized_name"])
    named = entries.select(F.col("id").alias("_e"), F.col("normalized_name").alias("_n"))
    solved = kept.withColumn("_key", inci_normalize(F.coalesce("canonical_name", "raw_token"))).join(named, (F.col("resolution") == "new_ingredient") & (F.col("_key") == F.col("_n")), "left")
    solved = solved.select("id", "product_id", "position", "raw_token", F.coalesce("entry_id", "_e").alias("entry"))
    listed = as_lists(solved, "product_id", ["position"], "entry").select("product_id", F.posexplode("ids").alias("at", "id"))
    spelled = solved.join(entries.select(F.col("id").alias("entry"), "normalized_name"), "entry").where(inci_normalize("raw_token") != F.col("normalized_name"))
    return {
        "brands": insert_missing(tables["brands"], good.select(brand_key("brand").alias("normalized"), F.col("brand").alias("name")), ["normalized"], ["name"]),
        "entries": entries,
        "aliases": insert_missing(tables["aliases"], spelled.select(F.col("entry").alias("id"), F.col("raw_token").alias("alias")), ["id", "alias"]),
        "products": tables["products"].unionByName(good.select("product_id", "brand", "name", product_slug("brand", "name").alias("slug"))),
        "items": tables["items"].unionByName(listed.select("product_id", (F.col("at") + 1).cast("int").alias("position"), "id")),
        "states": judged.join(first.select("id", F.lit(True).alias("_won")), "id", "left").select("id", F.when((F.col("new_status") == "applied") & F.col("_won").isNull(), "duplicate").otherwise(F.col("new_status")).alias("status")),
        "audit": judged.select("id", F.lit(actor).alias("actor"), F.col("new_status").alias("event")),
    }


def entry_slug(name: Column | str) -> Column:
    return hashed_slug(name)


def description_context(items: DataFrame, entries: DataFrame, most: int = 15) -> DataFrame:
    """(product_id, ingredients): the first `most` matched items of each product by position, with their functions array (empty if unknown).

    Items without an entry don't count. Items at one position are in the order of their names.
    """
    functions = F.coalesce("functions", F.array().cast("array<string>")).alias("functions")
    met = items.join(entries.select("id", "name", functions), "id")
    l = F.array_sort(F.collect_list(F.struct("position", "name", "functions")))
    return met.groupBy("product_id").agg(F.slice(l, 1, most).alias("ingredients"))


def review_detail(submissions: DataFrame, tokens: DataFrame, entries: DataFrame, log: DataFrame, domains: DataFrame, products: DataFrame) -> DataFrame:
    """A row per token of a submission, with names, newest escalation, the brand's domains and a similar product's name."""
    newest = latest(log.where("trigger is not null"), "id", ["at"], "trigger")
    by_brand = domains.groupBy(brand_key("brand").alias("_b")).agg(F.array_sort(F.collect_set("domain")).alias("domains"))
    rows = tokens.join(submissions.select("id", "brand", "name", "status", "similar_product"), "id")
    rows = rows.join(entries.select(F.col("id").alias("entry_id"), F.col("name").alias("matched_name")), "entry_id", "left").join(newest, "id", "left")
    rows = rows.withColumn("_b", brand_key("brand")).join(by_brand, "_b", "left").drop("_b")
    return rows.join(products.select(F.col("product_id").alias("similar_product"), F.col("name").alias("similar_name")), "similar_product", "left")


def filter_queue(rows: DataFrame, now: Column, trigger: str | None = None, older_than_hours: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows with their age, triggers to choose from with counts) of a review queue(id, trigger, created_at)."""
    facets = rows.groupBy("trigger").agg(F.count("*").alias("n"))
    out = rows if trigger is None else rows.where(F.col("trigger") == trigger)
    if older_than_hours is not None:
        out = out.where(F.col("created_at") < now - F.make_dt_interval(hours=F.lit(older_than_hours)))
    return out.withColumn("age", age_bucket(F.col("created_at"), now)), facets


def list_difference(label: Column | str, online: Column | str) -> Column:
    """struct of entries that only the label has and that only the online list has, compared by letters and digits."""
    own = F.filter(F.transform(F.split(label, "[,;\n]"), lambda x: F.btrim(x)), lambda x: x != "")
    there = F.col(online) if isinstance(online, str) else online
    keys = lambda a: F.transform(a, diff_key)
    only = lambda a, b: F.filter(a, lambda x: ~F.array_contains(keys(b), diff_key(x)))
    return F.struct(only(own, there).alias("submitted_only"), only(there, own).alias("online_only"))


def request_id(*parts: Column) -> Column:
    """A stable id of at most 64 characters for a request of a batch."""
    return F.substring(_hashed(*parts), 1, 64)


RUNS = "run_id string, stage string, status string, started_at timestamp, ended_at timestamp, counters map<string,long>, error string"


@contextmanager
def recorded_run(spark: SparkSession, path: str, stage: str) -> Iterator[dict[str, int]]:
    """Append how a stage ran to the log at path; counters is what the block puts into the dictionary it gets."""
    counters: dict[str, int] = {}
    run, began = uuid.uuid4().hex, datetime.now(timezone.utc)

    def write(status: str, error: str | None) -> None:
        spark.createDataFrame([(run, stage, status, began, datetime.now(timezone.utc), counters, error)], RUNS).write.mode("append").parquet(path)

    try:
        yield counters
    except Exception as e:
        write("failed", str(e)[:2000])
        raise
    write("success", None)


def last_success(spark: SparkSession, path: str) -> DataFrame:
    """(stage, run_id, ended_at) of the newest successful run of each stage."""
    runs = spark.read.schema(RUNS).parquet(path).where("status = 'success'")
    return runs.groupBy("stage").agg(F.max_by("run_id", "ended_at").alias("run_id"), F.max("ended_at").alias("ended_at"))


def new_submissions(table: DataFrame, new: DataFrame, now: Column) -> DataFrame:
    """table(id, brand, name, ingredients, submitted_by, status, attempt_count, created_at) and all new(brand, name, ingredients, submitted_by) ones as received.

    Every row is a submission of its own, equal ones too: an id is the hash of what a row says, when, and its number.
    """
    parts = [F.col(c) for c in ("brand", "name", "ingredients", "submitted_by")]
    made = F.substring(_hashed(*parts, now, F.monotonically_increasing_id()), 1, 32)
    rows = new.select(made.alias("id"), *parts, F.lit("received").alias("status"), F.lit(0).alias("attempt_count"), now.alias("created_at"))
    return table.unionByName(rows)


def batch_requests(requests: DataFrame, longest: int = 64) -> tuple[DataFrame, DataFrame]:
    """(requests(custom_id, ...) that may go into a batch, faults(custom_id, reason)): ids are unique, not blank and not too long."""
    n = requests.groupBy("custom_id").agg(F.count("*").alias("n"))
    why = F.when(F.coalesce(F.length(F.btrim("custom_id")), F.lit(0)) == 0, "blank").when(F.length("custom_id") > longest, "too long").when(F.col("n") > 1, "repeated")
    faults = n.select("custom_id", why.alias("reason")).where("reason is not null")
    return requests.join(faults.select("custom_id"), "custom_id", "left_anti").where("custom_id is not null").select(requests.columns), faults


def answer_text(content: Column, kind: Column) -> Column:
    """The last text of an answer's blocks (array of struct<type, text>), as what comes before is about searches; null if the request failed."""
    texts = F.filter(content, lambda b: F.coalesce(b["type"] == "text", F.lit(True)) & F.coalesce(b["text"] != "", F.lit(False)))
    return F.when(F.coalesce(kind == "succeeded", F.lit(True)), F.get(texts, F.size(texts) - 1)["text"])


def counted(df: DataFrame, name: str, **counters: Column) -> tuple[DataFrame, Observation]:
    """df that counts as it is written, and the observation that has the counters then."""
    seen = Observation(name)
    return df.observe(seen, *[F.coalesce(c, F.lit(0)).alias(k) for k, c in counters.items()]), seen
