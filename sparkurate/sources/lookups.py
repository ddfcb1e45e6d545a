"""Evidence from outside sources: batched lookups with retries, and evidence tables."""

from __future__ import annotations

import random
import time
from collections.abc import Callable
from email.utils import parsedate_to_datetime

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import inci_normalize, normalize_name, slug, title_case
from ..functions.web import element_text, link_to, resolved_link

# Confidence of a source that finds a name, by how.
CONFIDENCE = {("taxonomy", "exact"): 0.95, ("taxonomy", "alias"): 0.92, ("compound", "exact"): 0.90, ("compound", "alias"): 0.84, ("sparql", "exact"): 0.82, ("page", "page"): 0.88}
CONFIDENCE_V2 = {"registry": 0.97, "page": 0.92, "compound": 0.85}


class Retry(Exception):
    """An answer to try again: status 429 or 5xx, with the server's Retry-After if it gave one."""

    def __init__(self, retry_after: str | None = None):
        super().__init__(retry_after)
        self.retry_after = retry_after


def wait_seconds(attempt: int, retry_after: str | None, now: float, most: float = 30.0, give_up: float = 10.0) -> float | None:
    """Seconds before the next try, or None to give up: the server's wish up to give_up, else doubling up to most."""
    if retry_after is None:
        return min(most, 2.0**attempt)
    try:
        wish = float(retry_after)
    except ValueError:
        try:
            wish = parsedate_to_datetime(retry_after).timestamp() - now
        except (TypeError, ValueError):
            return min(most, 2.0**attempt)
    return max(0.0, wish) if wish <= give_up else None


def with_retries(call: Callable, *args, tries: int = 4, sleep: Callable = time.sleep, clock: Callable = time.time):
    for attempt in range(tries):
        try:
            return call(*args)
        except Retry as e:
            wait = wait_seconds(attempt, e.retry_after, clock()) if attempt + 1 < tries else None
            if wait is None:
                raise
            sleep(wait + random.random() * 0.1)
    return None


def lookup(keys: DataFrame, fetch: Callable[[list], list[dict]], schema: str, size: int = 40, source: str = "source") -> DataFrame:
    """Rows that fetch (list of keys -> list of dicts) gives for batches of `size` different keys, in parallel over partitions.

    A batch that fails gives rows with found = false and the error instead of failing the job.
    schema: of fetch's dicts, of which the first column is the key.
    """
    first = keys.columns[0]
    names = [p.split()[0] for p in schema.split(",")]

    def run(frames):
        for frame in frames:
            values = frame[first].tolist()
            for i in range(0, len(values), size):
                part = values[i : i + size]
                try:
                    rows = [{**r, "found": True, "error": None} for r in with_retries(fetch, part)]
                except Exception as e:  # a source that is down is a finding
                    rows = [{names[0]: k, "found": False, "error": str(e)[:2000]} for k in part]
                yield pd.DataFrame(rows, columns=[*names, "found", "error"], dtype=object)

    return keys.select(first).distinct().mapInPandas(run, f"{schema}, found boolean, error string").withColumn("source", F.lit(source))


def table_evidence(names: DataFrame, table: DataFrame, source: str, confidence: dict[str, float]) -> DataFrame:
    """(name, source, found, lookup_type, canonical, confidence): names found in a source's table(term, canonical, kind exact or alias)."""
    kinds = F.create_map(*[x for k, v in confidence.items() for x in (F.lit(k), F.lit(v))])
    terms = table.select(inci_normalize("term").alias("_t"), "canonical", "kind", F.when(F.col("kind") == "exact", 0).otherwise(1).alias("_p"))
    best = terms.groupBy("_t").agg(F.min(F.struct("_p", "canonical", "kind")).alias("b"))
    met = names.select("name").distinct().withColumn("_t", inci_normalize("name")).join(best, "_t", "left")
    return met.select("name", F.lit(source).alias("source"), F.col("b").isNotNull().alias("found"), F.col("b.kind").alias("lookup_type"), F.col("b.canonical").alias("canonical"), F.try_element_at(kinds, F.col("b.kind")).alias("confidence"))


def registry_evidence(names: DataFrame, registry: DataFrame) -> DataFrame:
    """As table_evidence, for a registry in capitals: names are given in title case."""
    return table_evidence(names, registry.select("term", title_case("canonical").alias("canonical"), F.lit("exact").alias("kind")), "registry", {"exact": CONFIDENCE_V2["registry"]})


def page_evidence(names: DataFrame, pages: DataFrame, searches: DataFrame, address: str, search: str, folder: str = "/ingredients/") -> DataFrame:
    """(name, source, found, lookup_type, canonical, url, confidence) of a site whose pages(url, html) and answers to searches(name, html) are tables.

    names are normalized. A name's own page is at `address` with its slug for {slug}, and counts if its first h1, or
    else its title, is that name. Otherwise the first link into `folder` of the name's search answer, as seen from
    the address `search`, leads to its page, whatever that is called. `url` is the last page asked for. A page
    without h1 and title, or that isn't there, finds nothing; of several pages at one url, and of several answers
    to one name, the smallest counts. Null names and urls are left out.
    """
    first, last = address.split("{slug}")
    heading = F.coalesce(element_text("html", "h1"), element_text("html", "title"))
    titled = pages.where("url is not null").groupBy("url").agg(F.min(heading).alias("_canonical"))  # the heading alone is shuffled
    links = searches.where("name is not null").groupBy("name").agg(F.min(link_to("html", folder)).alias("_link"))
    own = names.select("name").where("name is not null").distinct().withColumn("url", F.concat(F.lit(first), slug("name"), F.lit(last))).join(titled, "url", "left")
    own = own.withColumn("_own", F.coalesce(normalize_name("_canonical") == F.col("name"), F.lit(False)))
    other = own.where(~F.col("_own")).select("name", F.col("url").alias("_first")).join(links, "name", "left").withColumn("url", resolved_link(F.lit(search), F.col("_link")))
    other = other.join(titled, "url", "left").select("name", F.coalesce("url", "_first").alias("url"), "_canonical")
    met = own.where("_own").select("name", "url", "_canonical").unionByName(other)
    found = F.col("_canonical").isNotNull()
    return met.select(
        "name", F.lit("page").alias("source"), found.alias("found"), F.when(found, "page").alias("lookup_type"), F.col("_canonical").alias("canonical"), "url",
        F.when(found, CONFIDENCE_V2["page"]).alias("confidence"),
    )


def all_evidence(*parts: DataFrame) -> DataFrame:
    """Rows of all sources, with `seq` as the source's place."""
    out = parts[0].withColumn("seq", F.lit(0))
    for i, p in enumerate(parts[1:], 1):
        out = out.unionByName(p.withColumn("seq", F.lit(i)))
    return out


def fill_identifiers(entries: DataFrame, found: DataFrame, missing: tuple[str, ...] = ("ec",), replaced: tuple[str, ...] = ("iupac",)) -> DataFrame:
    """entries with columns of found (one row per cas is taken, the smallest): some only where missing, some replaced."""
    one = found.where("cas is not null").groupBy("cas").agg(*[F.min(c).alias(f"_{c}") for c in (*missing, *replaced)])
    met = entries.join(one, "cas", "left")
    return met.select(*[F.coalesce(c, f"_{c}").alias(c) if c in missing else F.coalesce(f"_{c}", c).alias(c) if c in replaced else F.col(c) for c in entries.columns])
