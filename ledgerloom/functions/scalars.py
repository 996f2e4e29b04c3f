"""Small column functions: hashes, times, coercions, paths, JSON."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def content_id(raw: Column) -> Column:
    return F.substring(F.sha2(raw, 256), 1, 16)


def paragraph_key(text: Column) -> Column:
    return F.substring(F.md5(text), 1, 16)


def unix_or_zero(iso: Column) -> Column:
    """Whole seconds of an ISO time; null, empty and malformed ones are 0."""
    return F.coalesce(F.unix_seconds(F.try_to_timestamp(iso)), F.lit(0)).cast("long")


def unix_strict(iso: Column) -> Column:
    """Whole seconds of an ISO time; null stays null, and text that is no time is an error."""
    return F.unix_seconds(F.to_timestamp(iso)).cast("long")


def year_start(year: Column) -> Column:
    return F.unix_seconds(F.make_timestamp(year, F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0), F.lit("UTC")))


def stamps(now: Column) -> tuple[Column, Column]:
    """Collection date and time of a run, from one given instant."""
    return F.date_format(now, "yyyy-MM-dd").alias("collection_date"), F.date_format(now, "HHmmss").alias("collection_time")


def cursor_date(patch: Column, dump: Column, now: Column) -> Column:
    """Where the change feed goes on: the patch cursor, else the dump's date (yyyyMMdd), else now."""
    return F.coalesce(F.try_to_timestamp(patch), F.try_to_timestamp(dump, F.lit("yyyyMMdd")), now)


def to_int(value: Column) -> Column:
    """Truncated towards zero; what is no number is null."""
    return value.cast("string").try_cast("double").try_cast("bigint")


def to_float(value: Column) -> Column:
    return value.cast("string").try_cast("double")


def truthy(value: Column) -> Column:
    """False for null and the empty string, else true."""
    return F.coalesce(value.cast("string") != "", F.lit(False))


def yes_no(value: Column) -> Column:
    return F.when(F.contains(value, F.lit("Ja")), True).when(F.contains(value, F.lit("Nei")), False)


def filing_path(orgnr: Column, year: Column, version: Column, kind: str = "pdf") -> Column:
    """Path of a stored filing; the first version has no suffix."""
    suffix = F.when(version > 1, F.concat(F.lit("_v"), version.cast("string"))).otherwise("")
    return F.concat(F.lit("regnskap/"), orgnr.cast("string"), F.lit("/aarsregnskap_"), year.cast("string"), suffix, F.lit(f".{kind}"))


def _group(text: Column, pattern: str, group: int) -> Column:
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))


def parse_filing_path(path: Column) -> Column:
    """struct(orgnr, year, version) of a stored filing's path; nulls if it is none."""
    p = r"regnskap/(\d{9})/aarsregnskap_(\d{4})(?:_v(\d+))?\.pdf$"
    known = F.regexp_like(path, F.lit(p))
    return F.struct(_group(path, p, 1).alias("orgnr"), _group(path, p, 2).try_cast("int").alias("year"), F.when(known, F.coalesce(_group(path, p, 3).try_cast("int"), F.lit(1))).alias("version"))


# The names of files in archives.
ARCHIVE_NAMES = (r"(?i)aarsregnskap_(\d{4})_(\d{9})\.pdf$", r"(?i)KopiAvAarsregnskap_(\d{9})_(\d{4})\.pdf$")


def parse_file_name(path: Column) -> Column:
    """struct(orgnr, year) of the two names that archives use, in any case."""
    name = F.element_at(F.split(path, "/"), -1)
    a, b = ARCHIVE_NAMES
    return F.struct(F.coalesce(_group(name, a, 2), _group(name, b, 1)).alias("orgnr"), F.coalesce(_group(name, a, 1), _group(name, b, 2)).try_cast("int").alias("year"))


def holding_name(path: Column) -> Column:
    """struct(orgnr, year) of ``{orgnr}_{year}.pdf``."""
    p = r"([^/_]+)_(\d+)\.pdf$"
    return F.struct(_group(path, p, 1).alias("orgnr"), _group(path, p, 2).try_cast("int").alias("year"))


def accounts_header(raw: Column) -> Column:
    """struct(journalnr, json_year) of an accounts object, or of the first of a list."""
    def get(path: str) -> Column:
        return F.coalesce(F.get_json_object(raw, f"$[0].{path}"), F.get_json_object(raw, f"$.{path}"))

    year = F.substring(get("regnskapsperiode.tilDato"), 1, 4)
    return F.struct(get("journalnr").alias("journalnr"), F.when(F.regexp_like(year, F.lit(r"^\d{4}$")), year).try_cast("int").alias("json_year"))


def encode_json(value: Column) -> Column:
    """Nested values as JSON with null fields kept."""
    return F.to_json(value, {"ignoreNullFields": "false"})


def unfence(answer: Column) -> Column:
    """An answer without the fence lines around it."""
    return F.regexp_replace(answer, r"^\s*```[^\n]*\n|\s*```\s*$", "")


def redact(text: Column) -> Column:
    """National ids (11 digits, or 6 and 5), account numbers (4, 2 and 5 with points between) and addresses of e-mail are replaced; other numbers stay."""
    return F.regexp_replace(F.regexp_replace(text, r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}", "<mail>"), r"\b(?:[0-9]{6} ?[0-9]{5}|[0-9]{4}\.[0-9]{2}\.[0-9]{5})\b", "<number>")


def has_any(text: Column, words: list[str]) -> Column:
    """Whether a text has any of the words (given in lower case), whatever its case; null texts have none."""
    low = F.lower(F.coalesce(text, F.lit("")))
    out = F.lit(False)
    for w in words:
        out = out | F.contains(low, F.lit(w))
    return out


# How the fields of a cover page are printed.
COVER = {
    "year": r"REGNSKAPSÅRET\s+(\d{4})",
    "journal": r"(\d{4})\s+(\d{4,7})",
    "period": r"(\d{2}\.\d{2}\.\d{4})\s*[-–]?\s*\n?\s*(\d{2}\.\d{2}\.\d{4})",
    "rules": r"(Regnskapslovens alminnelige regler|Forenklet IFRS|IFRS)",
    "settled": r"(?s)fastsettelse.*?(\d{2}\.\d{2}\.\d{4})",
    "unaudited": "ikke skal revideres",
}


def cover_fields(text: Column) -> Column:
    """Fields of a filing's cover page."""
    year, number = _group(text, COVER["journal"], 1), _group(text, COVER["journal"], 2)
    return F.struct(
        _group(text, COVER["year"], 1).try_cast("int").alias("regnskapsaar"), F.when(number.isNotNull(), F.concat_ws("/", year, number)).alias("journalnr"),
        _group(text, COVER["period"], 1).alias("periode_start"), _group(text, COVER["period"], 2).alias("periode_slutt"), _group(text, COVER["rules"], 1).alias("regnskapsregler"),
        F.coalesce(F.contains(text, F.lit(COVER["unaudited"])), F.lit(False)).alias("fravalgt_revisjon"), _group(text, COVER["settled"], 1).alias("dato_fastsettelse"),
    )
