"""Amounts in tables and prose.

A number between 1990 and 2030 is taken for a year and is no amount.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BLANKS = r"[\s\x{00A0}]"
BLANK_CHARS = " \t\n\x0b\f\r\u00a0"
FIRST_YEAR, LAST_YEAR = 1990, 2030


def _plains(raws: Column) -> Column:
    """Of each text of an array: digits without blanks, negative if a minus is among the first two characters; else null.

    Each step is a list of its own, so what a later one names more than once is worked out once.
    """
    bare = F.transform(raws, lambda r: F.trim(r, F.lit(BLANK_CHARS)))
    parts = F.transform(bare, lambda b: F.struct(F.when(F.contains(F.substring(b, 1, 2), F.lit("-")), -1.0).otherwise(1.0).alias("sign"), F.translate(F.ltrim(b, F.lit("-")), BLANK_CHARS, "").alias("c")))
    return F.transform(parts, lambda p: F.when((p["c"] != "") & (F.translate(p["c"], "0123456789", "") == ""), p["c"].try_cast("double")) * p["sign"])


def _plain(raw: Column) -> Column:
    return F.get(_plains(F.array(raw)), F.lit(0))


def _year(v: Column) -> Column:
    return F.abs(v).between(FIRST_YEAR, LAST_YEAR)


def item_amount(raw: Column) -> Column:
    """An amount of a statement's cell, signed."""
    return F.get(F.filter(_plains(F.array(raw)), lambda v: ~_year(v)), F.lit(0))


def cell_amount(cell: Column) -> Column:
    """The first amount in a table cell."""
    found = _plains(F.regexp_extract_all(cell, F.lit(r"(-?[0-9][0-9\s\x{00A0}]{2,})"), F.lit(1)))
    return F.get(F.filter(found, lambda v: ~_year(v)), F.lit(0))


def table_amount(text: Column, label: str, signed: bool = False) -> Column:
    """Amount of the first table row that names ``label`` and holds one over 5000."""
    rows = F.regexp_extract_all(text, F.lit(r"(\|\s*.+?\s*\|\s*-?[0-9\s]{4,}\s*\|)"), F.lit(1))
    named = F.filter(rows, lambda r: F.contains(F.lower(r), F.lit(label.lower())))
    found = _plains(F.transform(named, lambda r: F.trim(F.regexp_extract(r, r"\|\s*(-?[0-9\s]{4,})\s*\|$", 1))))
    big = F.filter(found, lambda v: (F.abs(v) > 5000) & ~_year(v))
    first = F.get(big, F.lit(0))
    return first if signed else F.abs(first)


def amount_near(text: Column, keyword: str, window: int = 300) -> Column:
    """Amount behind a keyword: of a table row there, else the first number over 1000."""
    at = F.locate(keyword.lower(), F.lower(text))
    chunk = F.when(at > 0, F.substring(text, at, F.lit(window)))
    prose = _plains(F.regexp_extract_all(chunk, F.lit(r"(?<![0-9])([0-9]{4,}(?:[\s\x{00A0}][0-9]{3})*)\b"), F.lit(1)))
    return F.coalesce(table_amount(chunk, keyword.split()[-1]), F.get(F.filter(prose, lambda v: v > 1000), F.lit(0)))


def context(text: Column, keyword: str, radius: int = 500) -> Column:
    """Text around the first hit of a keyword; null without one."""
    at = F.locate(keyword.lower(), F.lower(text))
    start = F.greatest(F.lit(1), at - radius)
    return F.when(at > 0, F.substring(text, start, at + radius - start))


def strict_amount(raw: Column) -> Column:
    """Any of the number formats seen: blanks or points for thousands, decimal comma or point, parentheses or minus, a dash for zero, percentages.

    A blank cell is null; so is what has no such form.
    """
    c = F.regexp_replace(F.trim(raw), BLANKS, "")
    body = F.regexp_replace(F.regexp_replace(c, r"^\((.*)\)$", "-$1"), "%$", "")
    grouped = F.regexp_like(body, F.lit(r"^-?[0-9]{1,3}(\.[0-9]{3})+(,[0-9]+)?$"))
    number = F.when(grouped, F.regexp_replace(F.regexp_replace(body, r"\.", ""), ",", ".")).when(F.regexp_like(body, F.lit(r"^-?[0-9]+([.,][0-9]+)?$")), F.regexp_replace(body, ",", "."))
    return F.when(body.isin("-", "–"), 0.0).otherwise(number.try_cast("double"))
