"""First-fit pairing of lists of names, with its SQL: a recursion over the entries of the left list."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import formulas
from .queries import LINES, lines, norm, query, read


def _spellings(names: str) -> str:
    """SQL of the spellings of each name of a list."""
    parts = "string_split(array_to_string(list_concat([c], regexp_extract_all(c, '\\(([^)]*)\\)', 1), [regexp_replace(c, '\\([^)]*\\)', ' ', 'g')]), '/'), '/')"
    water = f"list_transform({parts}, lambda x: CASE WHEN {norm('x')} IN ('aqua', 'water', 'eau') THEN 'water' ELSE {norm('x')} END)"
    return f"list_transform({names}, lambda c: list_filter({water}, lambda x: x <> ''))"


_FITS = "list_filter(range(1, len(b) + 1), lambda j: NOT list_contains(used, j) AND list_has_any(a[i + 1], b[j]))"
_NAME = "CASE WHEN l_partkey % 3 = 0 THEN p_name || ' (' || p_brand || '/' || p_type || ')' WHEN l_partkey % 3 = 1 THEN p_name ELSE p_brand || '/Aqua' END"


def _lists(spark, d, name):
    met = lines(spark, d).join(read(spark, d, "part"), F.col("p_partkey") == F.col("l_partkey"))
    l = met.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("position", F.expr(name).alias("v"), F.expr("p_name || ' (' || p_brand || ')'").alias("w"), (F.col("l_partkey") % 4 > 0).alias("o")))).alias("l"))
    return l.select("l_orderkey", F.col("l.v").alias("v"), F.col("l.w").alias("w"), F.col("l.o").alias("o"))


@query(
    f"""WITH RECURSIVE {LINES}, l AS (SELECT l_orderkey, {_spellings(f"list({_NAME} ORDER BY position)")} AS v FROM lines JOIN part ON p_partkey = l_partkey GROUP BY 1),
    p AS (SELECT x.l_orderkey, x.v AS a, y.v AS b FROM l x JOIN l y ON y.l_orderkey = x.l_orderkey + 1),
    r(l_orderkey, i, used) AS (SELECT l_orderkey, 0, []::BIGINT[] FROM p UNION ALL SELECT p.l_orderkey, i + 1, list_append(used, coalesce({_FITS}[1], -1)) FROM r JOIN p USING (l_orderkey) WHERE i < len(a)),
    h AS (SELECT l_orderkey, len(list_filter(used, lambda x: x > 0)) AS hits, len(a) AS n, len(b) AS m FROM r JOIN p USING (l_orderkey) WHERE i = len(a))
    SELECT l_orderkey, hits / n AS "left", hits / m AS "right" FROM h"""
)
def bidirectional_coverage(spark, d):
    own = _lists(spark, d, _NAME)
    pair = own.select("l_orderkey", F.col("v").alias("a")).join(own.select((F.col("l_orderkey") - 1).alias("l_orderkey"), F.col("v").alias("b")), "l_orderkey")
    return pair.select("l_orderkey", formulas.coverage("a", "b").alias("c")).select("l_orderkey", "c.left", "c.right")


@query(
    f"""WITH RECURSIVE {LINES}, l AS (SELECT l_orderkey, list({_NAME} ORDER BY position) AS v, list(p_name || ' (' || p_brand || ')' ORDER BY position) AS w, list(l_partkey % 4 > 0 ORDER BY position) AS o FROM lines JOIN part ON p_partkey = l_partkey GROUP BY 1),
    p AS (SELECT l_orderkey, o, list_reverse(w) AS names, {_spellings("v")} AS a, {_spellings("list_reverse(w)")} AS b FROM l),
    c(l_orderkey, i, used) AS (SELECT l_orderkey, 0, []::BIGINT[] FROM p UNION ALL SELECT p.l_orderkey, i + 1, list_append(used, coalesce({_FITS}[1], -1)) FROM c JOIN p USING (l_orderkey) WHERE i < len(a)),
    k AS (SELECT p.* FROM c JOIN p USING (l_orderkey) WHERE i = len(a) AND len(list_filter(used, lambda x: x > 0)) >= 0.7 * len(a)),
    r(l_orderkey, i, used, got) AS (SELECT l_orderkey, 0, []::BIGINT[], []::VARCHAR[] FROM k UNION ALL SELECT k.l_orderkey, i + 1, CASE WHEN o[i + 1] AND len({_FITS}) = 1 THEN list_append(used, {_FITS}[1]) ELSE used END, list_append(got, CASE WHEN o[i + 1] AND len({_FITS}) = 1 THEN names[{_FITS}[1]] ELSE '-' END) FROM r JOIN k USING (l_orderkey) WHERE i < len(a)),
    g AS (SELECT l_orderkey, array_to_string(got, '|') AS got FROM r JOIN k USING (l_orderkey) WHERE i = len(a))
    SELECT l_orderkey, coalesce(got, array_to_string(list_transform(a, lambda x: '-'), '|')) AS names FROM p LEFT JOIN g USING (l_orderkey)"""
)
def spelling_donation(spark, d):
    """Names that a list in other spellings and the reverse order gives to the open entries of an order, where the two cover each other by 70 %."""
    own = _lists(spark, d, _NAME)
    names = formulas.donated_names(F.col("v"), F.col("o"), F.reverse("w"), threshold=0.7)
    return own.select("l_orderkey", F.array_join(names, "|", "-").alias("names"))
