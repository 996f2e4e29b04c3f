"""Where things are kept under a storage root."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Places under the root; {version} is "" or "_v<n>" for n > 1, {shard} is "" or "_shard_<digit>".
LAYOUT = {
    "manifest": "manifest{shard}.parquet",
    "checkpoint": "checkpoint{shard}.json",
    "shard_manifest": "manifest-{first}-{last}.parquet",
    "accounts": "regnskap/{orgnr}/regnskap_{year}{version}.json",
    "filing": "regnskap/{orgnr}/aarsregnskap_{year}{version}.pdf",
    "dump": "entities/enheter_dump_{date}.json.gz",
    "notes": "notes/{orgnr}/notes_{year}.json",
    "page_text": "notes/{orgnr}/ocr_{year}.txt",
    "items": "notes/{orgnr}/regnskap_{year}.json",
    "all_notes": "notes/extractions.parquet",
    "all_items": "notes/regnskap_items.parquet",
    "queue_shard": "orderflow/shard_{digit}.parquet",
    "etag": "metadata/etag.json",
    "patch_cursor": "metadata/patch_cursor.json",
    "work_list": "coord/work_list.parquet",
    "collect_cursor": "coord/cursor.json",
    "holding": "holding",
}


def suffix(version: Column) -> Column:
    """``_v<n>`` of later versions."""
    return F.when(version > 1, F.concat(F.lit("_v"), version.cast("string"))).otherwise("")


def shard_suffix(shard: Column) -> Column:
    return F.coalesce(F.concat(F.lit("_shard_"), shard.cast("string")), F.lit(""))


def path(root: str, kind: str, **parts: Column) -> Column:
    """Path of a kind; ``version`` and ``shard`` are given as numbers (none: the first, and all)."""
    given = {k: c.cast("string") for k, c in parts.items() if k not in ("version", "shard")}
    given["version"] = suffix(parts["version"]) if "version" in parts else F.lit("")
    given["shard"] = shard_suffix(parts["shard"]) if "shard" in parts else F.lit("")
    out, rest = [], f"{root}/{LAYOUT[kind]}"
    while "{" in rest:
        before, _, rest = rest.partition("{")
        name, _, rest = rest.partition("}")
        out += [F.lit(before), given[name]]
    return F.concat(*out, F.lit(rest))
