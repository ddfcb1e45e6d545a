"""Resolving names to catalog entries: term index, exact and fuzzy matching, spelling candidates, search."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import similarity as sim
from ..functions.labels import let
from ..functions.text import inci_normalize, normalize_name


def first_by(df: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in `order`; with min_by, so that rows are combined before they are shuffled."""
    rest = F.struct(*[c for c in df.columns if c not in key])
    by = F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)])
    ordered = "map<" not in ",".join(t for _, t in df.dtypes)  # rows with maps have no order of their own to break ties by
    best = F.min(F.struct(by.alias("o"), rest.alias("r")))["r"] if ordered else F.min_by(rest, by)
    return df.groupBy(*key).agg(best.alias("_b")).select(*key, "_b.*")


def term_index(catalog: DataFrame, aliases: DataFrame) -> DataFrame:
    """(term, id, source): catalog(id, name) before manual aliases(id, alias, source) before others; ties by the smallest id."""
    names = catalog.select(inci_normalize("name").alias("term"), "id", F.lit("canonical").alias("source"), F.lit(0).alias("priority"))
    others = aliases.select(inci_normalize("alias").alias("term"), "id", F.lit("alias").alias("source"), F.when(F.col("source") == "manual", 1).otherwise(2).alias("priority"))
    return first_by(names.unionByName(others).where("term <> ''"), ["term"], [F.col("priority"), F.col("id")]).select("term", "id", "source")


def similarity_join(left: DataFrame, right: DataFrame, threshold: float, measure: str = "jaccard") -> DataFrame:
    """(a, b, similarity) of names a of left and b of right (one column each) whose trigram similarity is above the threshold.

    Equal names are joined once. Trigrams are ranked by how many names have them, rarest first; two names
    above the threshold share a trigram of their prefixes, so only these are joined on, with a bound on
    sizes, and what meets is verified. Frequent trigrams are only indexed where a name has no rarer ones.
    """
    t = threshold if measure == "jaccard" else threshold / (2 - threshold)  # a Dice threshold as a Jaccard one
    sides = [df.select(F.col(df.columns[0]).alias("name")).where("name is not null").distinct().select("name", sim.trigrams("name").alias("grams")) for df in (left, right)]
    grams = [s.select("name", F.size("grams").alias("n"), F.explode("grams").alias("gram")) for s in sides]
    counts = grams[0].select("gram").unionAll(grams[1].select("gram")).groupBy("gram").agg(F.count("*").alias("df"))
    prefixes = []
    for g in grams:
        ranked = g.join(counts, "gram").withColumn("at", F.row_number().over(Window.partitionBy("name").orderBy("df", "gram")))
        prefixes.append(ranked.where(F.col("at") <= F.col("n") - F.ceil(F.col("n") * t - 1e-9) + 1).select("name", "n", "gram"))
    a, b = (p.select(F.col("name").alias(x), F.col("n").alias(f"n{x}"), "gram") for p, x in zip(prefixes, "ab", strict=True))
    pairs = a.join(b, "gram").where((F.col("na") >= F.col("nb") * t - 1e-9) & (F.col("nb") >= F.col("na") * t - 1e-9)).select("a", "b").distinct()
    score = sim.trgm_jaccard if measure == "jaccard" else sim.trgm_dice
    return pairs.withColumn("similarity", score("a", "b")).where(F.col("similarity") > threshold)


def match(tokens: DataFrame, catalog: DataFrame, aliases: DataFrame, fuzzy_min: float = 0.3) -> DataFrame:
    """(term, id, match_type, confidence) for each different normalized token that matches.

    Names equal to a catalog name have confidence 1, to an alias .98, else the most similar of both
    counts if its similarity is above fuzzy_min. Only what is left goes on to the next step.
    """
    terms = tokens.select(inci_normalize(tokens.columns[0]).alias("term")).where("term <> ''").distinct()
    names = catalog.select(inci_normalize("name").alias("term"), "id").groupBy("term").agg(F.min("id").alias("id"))
    others = aliases.select(inci_normalize("alias").alias("term"), "id").groupBy("term").agg(F.min("id").alias("id"))
    exact = terms.join(names, "term").select("term", "id", F.lit("canonical_exact").alias("match_type"), F.lit(1.0).alias("confidence"))
    left = terms.join(names, "term", "left_anti")
    alias = left.join(others, "term").select("term", "id", F.lit("alias_exact").alias("match_type"), F.lit(0.98).alias("confidence"))
    left = left.join(others, "term", "left_anti")
    pool = names.select("term", "id", F.lit(0).alias("kind")).unionByName(others.select("term", "id", F.lit(1).alias("kind")))
    near = similarity_join(left, pool.select("term"), fuzzy_min).join(pool.withColumnRenamed("term", "b"), "b")
    best = first_by(near.select(F.col("a").alias("term"), "similarity", "kind", "id"), ["term"], [-F.round("similarity", 9), F.col("kind"), F.col("id")])
    fuzzy = best.select("term", "id", F.when(F.col("kind") == 0, "canonical_fuzzy").otherwise("alias_fuzzy").alias("match_type"), F.col("similarity").alias("confidence"))
    return exact.unionByName(alias).unionByName(fuzzy)


def match_with_remote(tokens: DataFrame, catalog: DataFrame, aliases: DataFrame, remote: DataFrame, exact_at: float = 0.98) -> DataFrame:
    """match() with a second try without brackets, and a remote catalog(id, name) for exact names.

    The best of: local exact, local exact without brackets, remote exact (mirrored: rows to add to the
    catalog have origin 'remote'), local fuzzy.
    """
    raw = tokens.select(F.col(tokens.columns[0]).alias("token")).distinct()
    tried = raw.select("token", F.lit(0).alias("variant"), inci_normalize("token").alias("term")).unionByName(
        raw.where(F.col("token").contains("(")).select("token", F.lit(1).alias("variant"), inci_normalize(F.regexp_replace("token", "\\([^)]*\\)", " ")).alias("term"))
    )
    local = tried.join(match(tried.select("term"), catalog, aliases), "term").withColumn("origin", F.lit("local"))
    far = tried.join(remote.select(inci_normalize("name").alias("term"), "id").groupBy("term").agg(F.min("id").alias("id")), "term")
    far = far.select("term", "token", "variant", "id", F.lit("canonical_exact").alias("match_type"), F.lit(1.0).alias("confidence"), F.lit("remote").alias("origin"))
    both = local.unionByName(far, allowMissingColumns=True)
    rank = F.when((F.col("origin") == "local") & (F.col("confidence") >= exact_at), F.col("variant")).when(F.col("origin") == "remote", F.col("variant") + 2).otherwise(4)
    return first_by(both, ["token"], [rank, -F.col("confidence"), F.col("variant"), F.col("id")]).select("token", "id", "match_type", "confidence", "origin")


def spelling_candidates(sources: DataFrame, targets: DataFrame, least: float = 0.72) -> DataFrame:
    """(source_id, source, target_id, target, similarity, edit_distance, token_overlap, rank, score_margin).

    sources(id, name), targets(id, name): names normalized; Dice similarity of at least `least`, not itself
    and not an equal name. The margin to the second best stands on the best row only.
    """
    names = similarity_join(sources.select("name"), targets.select("name"), least - 1e-9, "dice").where("a <> b")
    pairs = names.join(sources.select(F.col("id").alias("source_id"), F.col("name").alias("a")), "a").join(targets.select(F.col("id").alias("target_id"), F.col("name").alias("b")), "b")
    pairs = pairs.where("source_id <> target_id").select("source_id", F.col("a").alias("source"), "target_id", F.col("b").alias("target"), "similarity", F.levenshtein("a", "b").alias("edit_distance"), sim.token_jaccard("a", "b").alias("token_overlap"))
    order = Window.partitionBy("source_id").orderBy(F.desc(F.round("similarity", 9)), "edit_distance", "target_id")
    pairs = pairs.withColumn("rank", F.row_number().over(order)).withColumn("_next", F.lead("similarity").over(order))
    return pairs.withColumn("score_margin", F.when(F.col("rank") == 1, F.col("similarity") - F.coalesce("_next", F.lit(0.0)))).drop("_next")


def _ordered_pairs(name: Column) -> Column:
    """Pairs of letters of a normalized name, one somewhere before the other; as the first of one stands before the last of the other, at most 37 x 37."""
    letters = F.array_distinct(F.filter(F.split(name, ""), lambda x: x != ""))
    ends = F.transform(letters, lambda x: F.struct(x.alias("l"), F.call_function("locate", x, name).alias("first"), (F.length(name) + 1 - F.call_function("locate", x, F.reverse(name))).alias("last")))
    pairs = lambda e: F.flatten(F.transform(e, lambda x: F.transform(F.filter(e, lambda y: x["first"] < y["last"]), lambda y: F.concat(x["l"], y["l"]))))
    return let(ends, lambda e: F.concat(pairs(e), letters))


def rank_matches(catalog: DataFrame, queries: DataFrame, limit: int = 12) -> DataFrame:
    """(query, id, name, confidence, rank): the best `limit` of catalog(id, name) for each query typed.

    A name that a query fits has all neighboring letters of the query in that order, other letters between them
    or not, so a query meets the names with the pair of its own that the fewest names have; a query of one
    letter those with that letter. Only pairs that queries have are indexed. Queries or names without letters,
    and null ones, have no rows.
    """
    q = normalize_name("query")
    near = F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.length(q) - 1)), lambda i: F.substr(q, i, F.lit(2)))
    typed = queries.select(F.col(queries.columns[0]).alias("query")).where("query is not null").distinct().where(q != "").select("query", F.explode(F.array_distinct(near)).alias("_pair"))
    wanted = typed.select("_pair").distinct()  # of letters, digits and blanks: 37 + 37 x 37 rows at most
    held = catalog.select("id", "name", F.explode(_ordered_pairs(normalize_name("name"))).alias("_pair")).join(F.broadcast(wanted), "_pair")
    counts = held.groupBy("_pair").agg(F.count("*").alias("_n"))
    met = typed.join(F.broadcast(counts), "_pair", "left")  # as many rows as wanted at most
    rarest = met.groupBy("query").agg(F.min(F.struct(F.coalesce("_n", F.lit(0)).alias("n"), "_pair")).alias("_p")).select("query", F.col("_p._pair").alias("_pair"))
    scored = rarest.join(held, "_pair").drop("_pair").withColumn("confidence", sim.search_score("query", "name")).where("confidence is not null")
    order = Window.partitionBy("query").orderBy(F.desc(F.round("confidence", 9)), "name", "id")
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= limit).select("query", "id", "name", "confidence", "rank")


def unmatched_counts(tokens: DataFrame, index: DataFrame, limit: int = 5000) -> DataFrame:
    """The most frequent normalized tokens that the index lacks."""
    terms = tokens.select(inci_normalize(tokens.columns[0]).alias("term")).where("term <> ''").groupBy("term").agg(F.count("*").alias("n"))
    return terms.join(index.select("term"), "term", "left_anti").orderBy(F.desc("n"), "term").limit(limit)


def harvest_aliases(tokens: DataFrame, matches: DataFrame, least: float = 0.92) -> DataFrame:
    """(id, alias, confidence): spellings that resolve with confidence and aren't the normalized term itself."""
    raw = tokens.select(F.col(tokens.columns[0]).alias("alias")).distinct().withColumn("term", inci_normalize("alias"))
    return raw.join(matches.where(F.col("confidence") >= least), "term").select("id", "alias", "confidence").distinct()


def spelling_disagreement(evidence: DataFrame, donors: tuple[str, ...] = ("registry", "page")) -> DataFrame:
    """(token, disagrees): more than one normalized spelling among the sources that may donate one; evidence(token, source, found, canonical)."""
    name = normalize_name("canonical")
    return evidence.groupBy("token").agg((F.count_distinct(F.when(F.col("found") & F.col("source").isin(*donors) & (name != ""), name)) > 1).alias("disagrees"))


def rematch(items: DataFrame, index: DataFrame, token: str = "token") -> DataFrame:
    """items(..., token, id) whose id is null with the id of the index(term, id); the others stay as they are."""
    known = index.select(F.col("term").alias("_term"), F.col("id").alias("_id"))
    met = items.withColumn("_term", F.when(F.col("id").isNull(), inci_normalize(token))).join(known, "_term", "left")
    return met.withColumn("id", F.coalesce("id", "_id")).select(items.columns)
