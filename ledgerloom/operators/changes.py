"""The change feed: JSON patches of entities."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FIELD = "sisteInnsendteAarsregnskap"
UPDATE_SCHEMA = "oppdateringsid long, organisasjonsnummer string, dato string, endringstype string, endringer array<struct<op: string, path: string, value: string>>"


def concerns_accounts(kind: Column, patches: Column, field: str = FIELD) -> Column:
    """New entities, and patches that touch the field."""
    return (kind == "Ny") | F.coalesce(F.exists(patches, lambda p: F.contains(p["path"], F.lit(field))), F.lit(False))


def patched_year(kind: Column, patches: Column, field: str = FIELD) -> Column:
    """The year the first such patch sets; null for new entities and for what is not all digits."""
    first = F.get(F.filter(patches, lambda p: F.contains(p["path"], F.lit(field))), F.lit(0))["value"]
    return F.when(kind != "Ny", F.when(F.regexp_like(first, F.lit(r"^[0-9]+$")), first).try_cast("int"))


def since_date(updates: DataFrame, date: str) -> DataFrame:
    """Updates of a day (ISO text) and later; their times are text that sorts as it reads."""
    return updates.where(F.substring("dato", 1, 10) >= date)


def relevant_updates(updates: DataFrame, since_id: int | None = None) -> DataFrame:
    """(oppdateringsid, orgnr, year) after an id; pages repeat their last entry, so ids are made unique."""
    u = updates if since_id is None else updates.where(F.col("oppdateringsid") > since_id)
    u = u.where(concerns_accounts(F.col("endringstype"), F.col("endringer"))).dropDuplicates(["oppdateringsid"])
    return u.select("oppdateringsid", F.col("organisasjonsnummer").alias("orgnr"), patched_year(F.col("endringstype"), F.col("endringer")).alias("year"))


def entities_with_accounts(entities: DataFrame, field: str = FIELD) -> DataFrame:
    return entities.where(F.col(field).isNotNull() & (F.col(field) != ""))
