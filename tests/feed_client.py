"""A change feed for tests: pages of events, each beginning with the event asked for."""

import functools

import pyarrow.parquet as pq

PATH, PAGE = "/root/testdata/sf0.001/events.parquet", 150


@functools.cache
def _events():
    return sorted((e["event_id"], e["user_id"], e["event_type"]) for e in pq.read_table(PATH).to_pylist())


def page(since: int) -> list[dict]:
    found = [e for e in _events() if e[0] >= since][:PAGE]
    return [{"oppdateringsid": i, "organisasjonsnummer": str(u), "endringstype": t, "endringer": [{"k": i}]} for i, u, t in found]
