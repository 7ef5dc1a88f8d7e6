"""Normal forms of names and rule tables as expressions; no Python workers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Endings that the first normal form strips, one after the other (fixed values, order matters).
SUFFIXES = " inc| inc.| llc| llc.| corp| corp.| co| co.| ltd| ltd.| company| corporation| group| industries| international".split("|")
#: Legal words that the second normal form drops wherever they stand (fixed values).
LEGAL = r"(?iU)\b(?:incorporated|inc|llc|l\.l\.c|corp|corporation|co|company|ltd|limited|lp|l\.p|plc|p\.l\.c|pllc)\b\.?"


def strip(c: Column) -> Column:
    """Without white space of any kind at both ends."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def norm_suffix(c: Column) -> Column:
    """Lower case, stripped, with the listed endings taken off once each in order."""
    cut = lambda n, s: F.when(F.endswith(n, s), strip(F.left(n, F.length(n) - F.length(s)))).otherwise(n)
    return F.aggregate(F.array(*(F.lit(s) for s in SUFFIXES)), strip(F.lower(F.coalesce(c, F.lit("")))), cut)


def norm_words(c: Column) -> Column:
    """Lower case without legal words and punctuation, blanks squeezed."""
    out = F.regexp_replace(strip(F.lower(F.coalesce(c, F.lit("")))), LEGAL, " ")
    out = F.regexp_replace(out, r"(?U)[^\w\s]", " ")
    return strip(F.regexp_replace(out, r"(?U)\s{2,}", " "))


def norm_brand(c: Column) -> Column:
    """Lower case without punctuation at the end, blanks squeezed."""
    out = F.regexp_replace(strip(F.lower(F.coalesce(c, F.lit("")))), r"(?U)[^\w\s]+$", "")
    return strip(F.regexp_replace(out, r"(?U)\s{2,}", " "))


def contains_any(c: Column, words: list[str]) -> Column:
    """True if one of the words is a part of the text: one alternation of quoted literals."""
    return c.rlike("|".join(r"\Q" + w + r"\E" for w in words)) if words else F.lit(False)


def first_rule(c: Column, rules: dict[str, list[str]], default: str = "") -> Column:
    """The first label, in table order, one of whose words is a part of the text."""
    out = None
    for label, words in rules.items():
        out = F.when(contains_any(c, words), label) if out is None else out.when(contains_any(c, words), label)
    return F.lit(default) if out is None else out.otherwise(default)


def lookup(c: Column, table: dict[str, str], default: str = "") -> Column:
    """Label of an exact key."""
    if not table:
        return F.lit(default)
    m = F.create_map(*(F.lit(x) for kv in table.items() for x in kv))
    return F.coalesce(F.try_element_at(m, c), F.lit(default))


def address_parts(c: Column) -> Column:
    """struct<city,state,zip> of a comma-separated address of three or more parts; else blanks."""
    parts = F.transform(F.split(F.coalesce(c, F.lit("")), ","), lambda p: strip(p))
    region = F.split(F.try_element_at(parts, F.lit(-2)), r"\s+")
    ok = F.size(parts) >= 3
    pick = lambda x: F.when(ok, F.coalesce(x, F.lit(""))).otherwise("")
    return F.struct(pick(F.try_element_at(parts, F.lit(-3))).alias("city"), pick(F.get(region, F.lit(0))).alias("state"), pick(F.get(region, F.lit(1))).alias("zip"))


def is_unknown(c: Column) -> Column:
    """Null, blank, or a word for unknown."""
    return F.coalesce(strip(F.lower(c)).isin("", "unknown", "nan"), F.lit(True))
