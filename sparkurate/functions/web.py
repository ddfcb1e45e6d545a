"""URLs, pages and dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import _col


def host(url: Column | str) -> Column:
    """Host of an https URL without user info, in lower case and without www.; else null."""
    u = _col(url)
    h = F.regexp_replace(F.rtrim(F.lower(F.try_parse_url(u, F.lit("HOST"))), F.lit(".")), "^www\\.", "")
    return F.when((F.try_parse_url(u, F.lit("PROTOCOL")) == "https") & F.try_parse_url(u, F.lit("USERINFO")).isNull() & (h != ""), h)


def matches_domain(h: Column, domain: Column) -> Column:
    """Whether a host is the domain or under it."""
    d = F.regexp_replace(F.rtrim(F.lower(F.btrim(domain)), F.lit(".")), "^www\\.", "")
    return (d != "") & ((h == d) | F.endswith(h, F.concat(F.lit("."), d)))


# Character references that pages use in titles.
REFERENCES = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&apos;": "'", "&nbsp;": "\u00a0", "&copy;": "©", "&reg;": "®", "&middot;": "·", "&amp;": "&"}


def element_text(page: Column | str, tag: str) -> Column:
    """Text of the first such element: tags dropped, references decoded, white space collapsed; null if there is none."""
    inner = F.regexp_replace(F.regexp_extract(_col(page), f"(?is)<{tag}\\b[^>]*>(.*?)</{tag}\\s*>", 1), "(?s)<[^>]*>", " ")
    for a, b in REFERENCES.items():
        inner = F.replace(inner, F.lit(a), F.lit(b))
    text = F.btrim(F.regexp_replace(inner, "\\s+", " "))
    return F.when(text != "", text)


def first_link(page: Column | str) -> Column:
    link = F.regexp_extract(_col(page), "(?is)<a\\b[^>]*?href\\s*=\\s*[\"']([^\"']+)", 1)
    return F.when(link != "", link)


def link_to(page: Column | str, folder: str) -> Column:
    """The first link of a page whose path has that folder, up to its query or fragment; null if there is none."""
    link = F.regexp_extract(_col(page), f"(?is)<a\\b[^>]*?\\shref\\s*=\\s*[\"']([^\"'#?]*{folder}[^\"'#?]+)", 1)
    return F.when(link != "", link)


_URL = r"(?s)^([A-Za-z][A-Za-z0-9+.-]*:)?(//[^/?#]*)?([^?#]*)(\?[^#]*)?(#.*)?$"


def _without_dots(path: Column) -> Column:
    """A path without the segments . and .., which never lead above its start."""

    def step(kept: Column, x: Column) -> Column:
        above = F.when(F.size(kept) > 1, F.slice(kept, F.lit(1), F.size(kept) - 1)).otherwise(kept)
        return F.when(x == ".", kept).when(x == "..", above).otherwise(F.concat(kept, F.array(x)))

    parts = F.split(path, "/", -1)
    kept = F.aggregate(parts, F.array().cast("array<string>"), step)
    return F.array_join(F.when(F.element_at(parts, -1).isin(".", ".."), F.concat(kept, F.array(F.lit("")))).otherwise(kept), "/")


def resolved_link(base: Column | str, link: Column | str) -> Column:
    """A link as seen from the address of its page; links with a scheme or host of their own stay as they are."""
    b, r = ([F.regexp_extract(_col(c), _URL, i) for i in range(1, 6)] for c in (base, link))
    folder = F.when((b[1] != "") & (b[2] == ""), "/").otherwise(F.regexp_replace(b[2], "[^/]*$", ""))
    path = F.when(F.startswith(r[2], F.lit("/")), _without_dots(r[2])).otherwise(_without_dots(F.concat(folder, r[2])))
    here = F.concat(b[0], b[1], b[2], F.when(r[3] != "", r[3]).otherwise(b[3]), r[4])
    there = F.when(r[2] == "", here).otherwise(F.concat(b[0], b[1], path, r[3], r[4]))
    return F.when(r[0] != "", _col(link)).when(r[1] != "", F.concat(b[0], _col(link))).otherwise(there)


def end_of_day(text: Column | str, end: bool = False) -> Column:
    """A date or time in ISO form as UTC; a plain date as an end is the next day's start."""
    c = _col(text)
    t = F.to_timestamp(c)
    return F.when(F.lit(end) & c.rlike("^\\s*\\d{4}-\\d{2}-\\d{2}\\s*$"), t + F.expr("interval 1 day")).otherwise(t)


def age_bucket(since: Column, now: Column) -> Column:
    """'< 1 hour', '5 hours' or '3 days'."""
    micros = lambda c: F.unix_micros(c.cast("timestamp"))  # noqa: E731  whole seconds would make an hour of 59:59.6
    whole = lambda c, n: F.call_function("div", c, F.lit(n))
    hours = whole(micros(now) - micros(since), 3_600_000_000)
    return F.when(hours < 1, "< 1 hour").when(hours < 48, F.concat(hours.cast("string"), F.lit(" hours"))).otherwise(F.concat(whole(hours, 24).cast("string"), F.lit(" days")))
