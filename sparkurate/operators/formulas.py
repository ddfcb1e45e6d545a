"""Ordered lists of ids as formulas: exact and bag comparison, coverage, spelling donation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.labels import let
from ..functions.text import brand_key_sql, compare_key, inci_normalize, overlap_alternatives
from .tables import cut_lineage


def as_lists(rows: DataFrame, group: str, order: list[str], value: str) -> DataFrame:
    """(group, ids, resolved): values in order, and whether none is null."""
    parts = F.array_sort(F.collect_list(F.struct(*order, F.col(value).alias("_v"))))
    return rows.groupBy(group).agg(parts["_v"].alias("ids"), F.every(F.col(value).isNotNull()).alias("resolved"))


def bag_overlap(left: DataFrame, right: DataFrame, group: tuple[str, str], value: str) -> DataFrame:
    """(left group, right group, common): sizes of bag intersections of groups that share a value."""
    a = left.where(F.col(value).isNotNull()).groupBy(group[0], value).agg(F.count("*").alias("_a"))
    b = right.where(F.col(value).isNotNull()).groupBy(group[1], value).agg(F.count("*").alias("_b"))
    return a.join(b, value).groupBy(*group).agg(F.sum(F.least("_a", "_b")).alias("common"))


def similar_bags(left: DataFrame, right: DataFrame, group: tuple[str, str], value: str, threshold: float) -> DataFrame:
    """(left group, right group, common) of bags with common / larger size of at least the threshold, which is above 0.

    Entries are numbered by occurrence, so that bags are sets, and ordered by how many bags have them.
    Of n entries two such bags share one of the n - ceil(threshold * n) + 1 rarest of each, so an
    entry that most lists hold brings no two together. Nulls count for a bag's size only.
    """
    sides = []
    for rows, g in ((left, group[0]), (right, group[1])):
        sizes = rows.groupBy(g).agg(F.count("*").alias("_size"))
        entries = rows.where(F.col(value).isNotNull()).groupBy(g, value).agg(F.count("*").alias("_n"))
        sides.append(entries.select(F.col(g), F.explode(F.sequence(F.lit(1).cast("long"), F.col("_n"))).alias("_k"), F.col(value).alias("_v")).join(sizes, g))
    held = sides[0].select("_v", "_k").unionAll(sides[1].select("_v", "_k")).groupBy("_v", "_k").agg(F.count("*").alias("_df"))
    heads, bags = [], []
    for rows, g, x in zip(sides, group, "ab", strict=True):
        order = Window.partitionBy(g).orderBy("_df", "_v", "_k")
        ranked = rows.join(held, ["_v", "_k"]).withColumn("_at", F.row_number().over(order)).withColumn("_of", F.count("*").over(Window.partitionBy(g)))
        short = ranked.where(F.col("_at") <= F.col("_of") - F.ceil(F.col("_size") * threshold - 1e-9) + 1)
        heads.append(short.select("_v", "_k", g, F.col("_size").alias(f"_{x}")))
        bags.append(rows.groupBy(g).agg(F.collect_list(F.struct("_v", "_k")).alias(f"_bag_{x}")))
    near = (F.col("_a") >= F.col("_b") * threshold - 1e-9) & (F.col("_b") >= F.col("_a") * threshold - 1e-9)
    pairs = heads[0].join(heads[1], ["_v", "_k"]).where(near).select(*group).distinct()
    return pairs.join(bags[0], group[0]).join(bags[1], group[1]).select(*group, F.size(F.array_intersect("_bag_a", "_bag_b")).cast("long").alias("common"))


def nearest_bags(left: DataFrame, right: DataFrame | None, group: tuple[str, str], value: str, least: float = 0.0, rounds: tuple[float, ...] = (0.5,)) -> DataFrame:
    """(left group, right group, similarity): for each bag the most similar one that shares an entry, ties to the smallest group; no threshold is needed.

    Similarity is common / larger size, and at least `least`. Without right, bags of left meet each other, and not
    themselves. Entries are ordered as in similar_bags(). Bags that share one entry are met through the two smallest
    groups of each entry and size, so a frequent entry has a short list, and give a first bound. Bags that share more
    have two entries in common within their prefixes: a round looks at similarities above its own, and above the best
    that is known, by pairs of entries. What it finds is final; only bags whose best is below go on to the next, with
    longer prefixes. Pairs are quadratic in the length of one bag only.
    Nulls count for a bag's size only; a bag of nothing else, and rows without a group, have no row.
    """
    g, h = group

    def numbered(rows: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
        entries = rows.groupBy(key, value).agg(F.count("*").alias("_n"))
        each = entries.where(F.col(value).isNotNull()).select(F.col(key), F.col(value).alias("_v"), F.explode(F.sequence(F.lit(1).cast("long"), F.col("_n"))).alias("_k"))
        return each.select(F.col(key).alias("_g"), "_v", "_k"), entries.groupBy(F.col(key).alias("_g")).agg(F.sum("_n").alias("_size"))

    sides = [numbered(left, g)] if right is None else [numbered(left, g), numbered(right, h)]
    held = reduce(DataFrame.unionAll, [each for each, _ in sides]).groupBy("_v", "_k").agg(F.count("*").alias("_df"))
    bags = [cut_lineage(each.join(held, ["_v", "_k"]).groupBy("_g").agg(F.array_sort(F.collect_list(F.struct("_df", "_v", "_k"))).alias("_bag")).join(sizes, "_g")) for each, sizes in sides]
    lists = [b.toDF(key, bag, n) for b, key, bag, n in zip([bags[0], bags[-1]], group, ("_x", "_y"), ("_a", "_b"), strict=True)]
    apart = F.col(g) != F.col(h) if right is None else F.lit(True)

    def best(pairs: DataFrame) -> DataFrame:
        return pairs.groupBy(g).agg(F.min(F.struct(-F.col("similarity"), F.col(h))).alias("_m")).select(g, F.col("_m").getField(h).alias(h), (-F.col("_m.col1")).alias("similarity"))

    order = Window.partitionBy("_e", "_b").orderBy(h)
    few = lists[1].select(h, "_b", F.explode("_y").alias("_e")).withColumn("_i", F.row_number().over(order)).where(F.col("_i") <= 2)
    heads = few.groupBy("_e").agg(F.array_sort(F.collect_list(F.struct("_b", h))).alias("_h"))
    # of larger bags only those of smaller groups than all but one of the smaller bags can be the best
    heads = heads.withColumn("_h", F.filter("_h", lambda x, i: F.size(F.filter(F.slice("_h", 1, i), lambda y: y[h] < x[h])) < 2))
    met = lists[0].select(g, "_a", F.explode("_x").alias("_e")).join(heads, "_e").select(g, "_a", F.explode("_h").alias("_h")).select(g, F.col("_h").getField(h).alias(h), (1 / F.greatest("_a", "_h._b")).alias("similarity"))
    known = cut_lineage(best(met.where(apart & (F.col("similarity") >= least))))

    def heads_of(bags: DataFrame, bag: str, size: str, at_least: Column, keep: list[str | Column]) -> DataFrame:
        """Hashes of the pairs of entries of a prefix that bags with at_least * size common entries share one of."""
        common = F.greatest(F.lit(2), F.ceil(F.col(size) * at_least - 1e-9))
        prefix = F.slice(bag, F.lit(1), F.greatest(F.lit(0), F.size(bag) - common + 2).cast("int"))
        firsts = bags.select(*keep, prefix.alias("_p")).select("*", F.posexplode("_p").alias("_i", "_x"))
        return firsts.withColumn("_y", F.explode(F.slice("_p", F.col("_i") + 2, F.size("_p")))).withColumn("_e", F.xxhash64("_x", "_y")).drop("_p", "_i", "_x", "_y")

    final = None  # what an earlier round has found at or above its similarity
    for t in [*[r for r in sorted(rounds, reverse=True) if r > least], least]:
        open_ = lists[0].join(known, g, "left")
        open_ = open_ if final is None else open_.where(F.coalesce("similarity", F.lit(0.0)) < final)
        final = t
        bound = F.greatest(F.lit(float(t)), F.coalesce("similarity", F.lit(0.0)))
        one = heads_of(open_, "_x", "_a", bound, [g, "_a", bound.alias("_t")])
        two = heads_of(lists[1], "_y", "_b", F.lit(float(t)), [h, "_b"])
        near = F.least("_a", "_b") >= F.greatest("_a", "_b") * F.col("_t") - 1e-9
        pairs = one.join(two, "_e").where(apart & near).select(g, h).distinct().join(lists[0], g).join(lists[1], h)
        pairs = pairs.select(g, h, (F.size(F.array_intersect("_x", "_y")) / F.greatest("_a", "_b")).alias("similarity")).where(F.col("similarity") >= least)
        known = cut_lineage(best(known.unionByName(pairs)))
    return known


def resolve_tokens(tokens: DataFrame, catalog: DataFrame, aliases: DataFrame) -> DataFrame:
    """tokens(input, position, token) with `id` if exactly one catalog entry has that name or alias."""
    terms = catalog.select(inci_normalize("name").alias("term"), "id").union(aliases.select(inci_normalize("alias"), "id")).distinct()
    one = terms.groupBy("term").agg(F.min("id").alias("id"), F.count("*").alias("n")).where("n = 1").select("term", "id")
    kept = tokens.withColumn("term", inci_normalize("token")).where("term <> ''")
    return kept.join(one, "term", "left").select("input", "position", "id")


def formula_match(inputs: DataFrame, resolved: DataFrame, products: DataFrame, items: DataFrame, threshold: float = 0.95) -> DataFrame:
    """The best product for each input, one row at most: product_id, product_name, similarity, is_exact, product_name_matches, brand_name_matches, same_product.

    inputs(input, brand, name), resolved(input, position, id), products(product_id, brand, name),
    items(product_id, position, id). Products that share nothing with the input are no candidates
    unless the threshold is 0 or less, as similarity is then 0.
    """
    want = as_lists(resolved, "input", ["position"], "id").where(F.size("ids") > 0)
    have = as_lists(items, "product_id", ["position"], "id").select("product_id", F.col("ids").alias("own"), F.col("resolved").alias("own_resolved"))
    if threshold > 0:
        pairs = similar_bags(resolved, items, ("input", "product_id"), "id", min(threshold, 1.0))
    else:
        pairs = bag_overlap(resolved, items, ("input", "product_id"), "id")
        every = want.select("input").join(have.select("product_id"), how="cross")
        pairs = every.join(pairs, ["input", "product_id"], "left").fillna({"common": 0})
    rows = pairs.join(want, "input").join(have, "product_id").join(inputs.select("input", F.col("brand").alias("_brand"), F.col("name").alias("_name")), "input").join(products.select("product_id", "brand", F.col("name").alias("product_name")), "product_id")
    # REAL arithmetic of the original is replaced by doubles
    rows = rows.withColumn("similarity", F.col("common") / F.greatest(F.size("ids"), F.size("own")))
    rows = rows.withColumn("is_exact", F.col("resolved") & F.col("own_resolved") & (F.col("ids") == F.col("own")))
    rows = rows.withColumn("product_name_matches", compare_key("product_name") == compare_key("_name")).withColumn("brand_name_matches", brand_key_sql("brand") == brand_key_sql("_brand"))
    rows = rows.withColumn("same_product", F.col("product_name_matches") & F.col("brand_name_matches"))
    rows = rows.where(F.col("is_exact") | (F.col("similarity") >= max(0.0, min(threshold, 1.0))))
    order = Window.partitionBy("input").orderBy(F.desc(F.col("is_exact") & F.col("same_product")), F.desc("is_exact"), F.desc(~F.col("product_name_matches")), F.desc("similarity"), "product_id")
    rows = rows.withColumn("_n", F.row_number().over(order)).where("_n = 1")
    return rows.select("input", "product_id", "product_name", "similarity", "is_exact", "product_name_matches", "brand_name_matches", "same_product")


def identity_match(inputs: DataFrame, products: DataFrame) -> DataFrame:
    """(input, product_id): the smallest product of that brand and name."""
    a = inputs.select("input", brand_key_sql("brand").alias("_b"), compare_key("name").alias("_n"))
    b = products.select("product_id", brand_key_sql("brand").alias("_b"), compare_key("name").alias("_n"))
    return a.join(b, ["_b", "_n"]).groupBy("input").agg(F.min("product_id").alias("product_id"))


def _fitting(entry: Column, right: Column, used: Column) -> Column:
    """Places of right that aren't used and share a spelling with an entry, ascending."""
    places = F.transform(right, lambda x, i: F.when(F.arrays_overlap(entry, x), i))
    return F.filter(places, lambda i: i.isNotNull() & ~F.array_contains(used, i))


def first_fits(left: Column, right: Column) -> Column:
    """For each entry of left (arrays of spellings) the first entry of right that isn't taken and shares a spelling, or -1; a fold from left to right."""
    take = lambda used, x: F.concat(used, F.array(F.coalesce(F.get(_fitting(x, right, used), 0), F.lit(-1))))
    return F.aggregate(left, F.array().cast("array<int>"), take)


def _spelled(names: Column | str) -> Column:
    names = F.col(names) if isinstance(names, str) else names
    return F.transform(names, lambda x: F.coalesce(overlap_alternatives(x), F.array().cast("array<string>")))


def coverage(submitted: Column | str, online: Column | str) -> Column:
    """Shares of two lists of entries that pair off one to one, first fit from the left: struct<left, right>; 0 where one is null or empty."""

    def shares(both: Column) -> Column:
        a, b = both["a"], both["b"]
        hits = F.size(F.filter(first_fits(a, b), lambda i: i >= 0))
        share = lambda x: F.coalesce(F.when((F.size(a) > 0) & (F.size(b) > 0), hits / F.size(x)), F.lit(0.0))
        return F.struct(share(a).alias("left"), share(b).alias("right"))

    return let(F.struct(_spelled(submitted).alias("a"), _spelled(online).alias("b")), shares)


def donated_names(tokens: Column, unresolved: Column, online: Column, threshold: float = 0.9) -> Column:
    """Array of the online spelling for each token that is unresolved and fits exactly one unused entry, if the lists cover each other; else nulls."""

    def give(x: Column) -> Column:
        def step(so_far: Column, i: Column) -> Column:
            fits = F.when(F.get(x["open"], i), _fitting(F.get(x["a"], i), x["b"], so_far["used"]))
            one = F.coalesce(F.size(fits) == 1, F.lit(False))
            used = F.when(one, F.concat(so_far["used"], fits)).otherwise(so_far["used"])
            return F.struct(used.alias("used"), F.concat(so_far["names"], F.array(F.when(one, F.btrim(F.get(x["names"], F.get(fits, 0)))))).alias("names"))

        none = F.transform(x["a"], lambda _: F.lit(None).cast("string"))
        places = F.transform(x["a"], lambda _, i: i)
        start = F.struct(F.array().cast("array<int>").alias("used"), F.array().cast("array<string>").alias("names"))
        enough = lambda c: (c["left"] >= threshold) & (c["right"] >= threshold)
        return F.when(enough(x["c"]), F.aggregate(places, start, step, lambda r: r["names"])).otherwise(none)

    return let(F.struct(_spelled(tokens).alias("a"), _spelled(online).alias("b"), unresolved.alias("open"), online.alias("names"), coverage(tokens, online).alias("c")), give)


def same_numbers(a: Column | str, b: Column | str) -> Column:
    """Whether two names have the same digit sequences in order."""
    return F.regexp_extract_all(a, F.lit("(\\d+)"), 1) == F.regexp_extract_all(b, F.lit("(\\d+)"), 1)
