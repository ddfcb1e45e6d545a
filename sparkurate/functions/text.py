"""Names, slugs and keys as Column expressions, all inside whole-stage code generation."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _folds() -> tuple[str, str]:
    """Letters of U+00C0 to U+024F that are an ASCII letter with marks, and that letter."""
    pairs = []
    for code in range(0xC0, 0x250):
        base = [c for c in unicodedata.normalize("NFKD", chr(code)) if not unicodedata.combining(c)]
        if len(base) == 1 and base[0].isascii() and base[0].isalpha():
            pairs.append((chr(code), base[0]))
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


FOLD_FROM, FOLD_TO = _folds()

# Compatibility characters that NFKD expands.
EXPANSIONS = {"™": "TM", "℠": "SM", "№": "No", "ﬁ": "fi", "ﬂ": "fl", "½": "1⁄2", "¼": "1⁄4"}
#: Letters without a decomposition, which a full transliteration spells out and NFKD keeps.
TRANSLITERATIONS = {"ß": "ss", "æ": "ae", "Æ": "AE", "œ": "oe", "Œ": "OE", "ø": "o", "Ø": "O", "ł": "l", "Ł": "L", "đ": "d", "Đ": "D"}


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def fold_accents(c: Column | str, expand: bool = False, transliterate: bool = False) -> Column:
    """Letters without their marks; others stay."""
    out = _col(c)
    for table in ([EXPANSIONS] if expand else []) + ([TRANSLITERATIONS] if transliterate else []):
        for a, b in table.items():
            out = F.replace(out, F.lit(a), F.lit(b))
    return F.translate(out, FOLD_FROM, FOLD_TO)


def inci_normalize(c: Column | str, transliterate: bool = False) -> Column:
    """Lower-case ASCII letters, digits and single spaces; null stays null."""
    kept = F.lower(F.regexp_replace(fold_accents(c, transliterate=transliterate), "[^a-zA-Z0-9 ]", ""))
    return F.btrim(F.regexp_replace(kept, " +", " "))


def normalize_name(c: Column | str) -> Column:
    """As inci_normalize, with compatibility characters expanded; null is empty."""
    kept = F.regexp_replace(F.lower(fold_accents(c, expand=True)), "[^a-z0-9 ]+", "")
    return F.coalesce(F.btrim(F.regexp_replace(kept, " +", " ")), F.lit(""))


def register_sql_functions(spark) -> None:
    """inci_normalize as a SQL function, which Catalyst inlines."""
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION inci_normalize(input STRING) RETURNS STRING RETURN "
        f"btrim(regexp_replace(lower(regexp_replace(translate(input, '{FOLD_FROM}', '{FOLD_TO}'), '[^a-zA-Z0-9 ]', '')), ' +', ' '))"
    )


def slug(c: Column | str) -> Column:
    """Words of letters and digits, joined by hyphens."""
    return F.btrim(F.regexp_replace(F.lower(fold_accents(c, expand=True)), "[^a-z0-9]+", "-"), F.lit("-"))


def hashed_slug(c: Column | str) -> Column:
    """The slug with six digits of the name's MD5."""
    return F.concat(slug(c), F.lit("-"), F.substring(F.md5(_col(c)), 1, 6))


def unique_slugs(df: DataFrame, name: str, order: list[str]) -> DataFrame:
    """df with `slug`: the first name in `order` has the plain one, later ones six digits of their SHA-1.

    Ranking is per slug; a slug that very many names share sorts them in one task, on disk if need be.
    """
    plain = df.withColumn("_base", slug(name))
    nth = F.row_number().over(Window.partitionBy("_base").orderBy(*order))
    return plain.withColumn("slug", F.when(nth == 1, F.col("_base")).otherwise(F.concat("_base", F.lit("-"), F.substring(F.sha1(F.col(name)), 1, 6)))).drop("_base")


def brand_key(c: Column | str) -> Column:
    """Trimmed, in upper case, white space collapsed; null is empty."""
    return F.coalesce(F.upper(F.btrim(F.regexp_replace(_col(c), "\\s+", " "))), F.lit(""))


def brand_key_sql(c: Column | str) -> Column:
    """Trimmed of spaces and in upper case only, as a stored key has it; null stays null."""
    return F.upper(F.btrim(_col(c)))


def first_brand(c: Column | str) -> Column:
    """The first brand that is not blank of a list with commas or semicolons."""
    parts = F.filter(F.transform(F.split(_col(c), "[,;]"), lambda x: F.btrim(x)), lambda x: x != "")
    return F.get(parts, F.lit(0))


def product_slug(brand: Column | str, name: Column | str) -> Column:
    joined = slug(F.concat_ws(" ", _col(brand), _col(name)))
    return F.when(joined == "", F.substring(F.sha1(F.concat_ws("|", _col(brand), _col(name))), 1, 6)).otherwise(joined)


def compare_key(c: Column | str) -> Column:
    """Product names to compare: normalized, all white space collapsed."""
    return F.regexp_replace(inci_normalize(F.btrim(_col(c))), "\\s+", " ")


def diff_key(c: Column | str) -> Column:
    """ASCII letters and digits in lower case; accented letters and spaces go."""
    return F.regexp_replace(F.lower(_col(c)), "[^a-z0-9]", "")


def fingerprint(tokens: Column | str) -> Column:
    """MD5 of an array of tokens in their order, in upper case, blanks left out."""
    kept = F.filter(F.transform(_col(tokens), lambda x: F.upper(F.btrim(x))), lambda x: x.isNotNull() & (x != ""))
    return F.md5(F.array_join(kept, "|"))


def group_fingerprint(df: DataFrame, group: str, order: list[str], value: str) -> DataFrame:
    """(group, fingerprint) of the values in order."""
    parts = F.array_sort(F.collect_list(F.struct(*order, F.col(value).cast("string").alias("_v"))))
    return df.groupBy(group).agg(parts.alias("_p")).select(group, fingerprint(F.col("_p._v")).alias("fingerprint"))


def unique_or_null(df: DataFrame, value: str) -> DataFrame:
    """df with `value` nulled where several rows have it; counts are summed before they are shuffled."""
    counts = df.groupBy(value).count().where("count = 1").select(F.col(value).alias("_v"))
    return df.join(counts, F.col(value) == F.col("_v"), "left").withColumn(value, F.col("_v")).drop("_v")


def overlap_alternatives(c: Column | str) -> Column:
    """Spellings that one entry stands for: whole, each bracket, without brackets; each cut at slashes."""
    c = _col(c)
    spellings = F.concat(F.array(c), F.regexp_extract_all(c, F.lit("\\(([^)]*)\\)"), 1), F.array(F.regexp_replace(c, "\\([^)]*\\)", " ")))
    parts = F.transform(F.split(F.array_join(spellings, "/"), "/"), normalize_name)
    water = F.transform(parts, lambda x: F.when(x.isin("aqua", "water", "eau"), F.lit("water")).otherwise(x))
    return F.array_distinct(F.filter(water, lambda x: x != ""))


def is_rename(submitted: Column | str, published: Column | str, brand: Column | str) -> Column:
    """Whether a published name says something that the submitted one does not, its brand in front aside."""
    own, new = (normalize_name(F.regexp_replace(_col(x), "[™®©]", "")) for x in (submitted, published))
    maker = normalize_name(brand)
    new = F.when((maker != "") & F.startswith(new, F.concat(maker, F.lit(" "))), F.btrim(F.substr(new, F.length(maker) + 1))).otherwise(new)
    return (own != "") & (new != "") & (own != new) & (F.size(F.array_except(F.split(new, " "), F.split(own, " "))) > 0)


def title_case(c: Column | str) -> Column:
    """Each run of letters with its first letter in upper case, as in Peg-40 Castor/Oil."""
    parts = F.regexp_extract_all(F.lower(_col(c)), F.lit("(\\p{L}+|[^\\p{L}]+)"), 1)
    return F.array_join(F.transform(parts, lambda x: F.concat(F.upper(F.substring(x, 1, 1)), F.substr(x, F.lit(2)))), "")
