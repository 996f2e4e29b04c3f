"""The change feed as a data source: ``spark.readStream.format("updates")`` or ``spark.read.format("updates")``.

The client is a function ``(since_id) -> list of updates`` given by its place
(``module:function``), so tests and other services need no network here.
"""

from __future__ import annotations

import importlib
import json
import sys

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition, SimpleDataSourceStreamReader

SCHEMA = "oppdateringsid long, organisasjonsnummer string, dato string, endringstype string, endringer string"


def _row(u: dict) -> tuple:
    return int(u["oppdateringsid"]), u.get("organisasjonsnummer"), u.get("dato"), u.get("endringstype"), json.dumps(u.get("endringer") or [])


def pages(client, since: int):
    """Updates after ``since``, page by page.

    Pages begin with the update asked for, so the walk ends on an empty page
    or one that brings nothing new.
    """
    while found := [u for u in client(since) if int(u["oppdateringsid"]) > since]:
        yield from found
        since = max(int(u["oppdateringsid"]) for u in found)


def _client(options):
    """The client; ``path`` names a folder or archive that holds its module, where that is not on Python's path (offsets are asked for in a process that ``addPyFile`` does not reach)."""
    if (path := options.get("path")) and path not in sys.path:
        sys.path.append(path)
    module, _, name = options["client"].partition(":")
    return getattr(importlib.import_module(module), name)


class UpdatesSource(DataSource):
    @classmethod
    def name(cls):
        return "updates"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return _Batch(self.options)

    def simpleStreamReader(self, schema):
        return _Stream(self.options)


class _Batch(DataSourceReader):
    def __init__(self, options):
        self.options = options

    def partitions(self):
        return [InputPartition(int(self.options.get("since", "0")))]

    def read(self, partition):
        return map(_row, pages(_client(self.options), partition.value))


class _Stream(SimpleDataSourceStreamReader):
    def __init__(self, options):
        self.options = options

    def initialOffset(self):
        return {"id": int(self.options.get("since", "0"))}

    def read(self, start):
        found = [u for u in _client(self.options)(start["id"]) if int(u["oppdateringsid"]) > start["id"]]
        return iter([_row(u) for u in found]), {"id": max([start["id"], *(int(u["oppdateringsid"]) for u in found)])}

    def readBetweenOffsets(self, start, end):
        found = pages(_client(self.options), start["id"])
        return iter([_row(u) for u in found if int(u["oppdateringsid"]) <= end["id"]])
