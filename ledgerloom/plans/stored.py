"""Queries through the library's own stores: what Spark derives from a table is written, published, landed or streamed, and read back."""

from __future__ import annotations

import io
import uuid
import zipfile

import pandas as pd
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..sources import files, sinks, tables
from ..sources.scratch import shared_dir
from ..streaming import flows
from . import commands
from .queries import M, Q, manifest, query, table, waiting


def _folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


@query(f"WITH {Q} SELECT orgnr, year, create_time, processing_priority, CAST(CAST(orgnr AS BIGINT) % 10 AS VARCHAR) AS shard FROM q")
def stored_shards(spark, sf):
    """The queue written by shard, twice for some shards, and each shard read by itself."""
    path = _folder(spark, "queue")
    q = waiting(spark, sf).withColumns({"source": F.lit(None).cast("string"), "shard": (F.col("orgnr").cast("bigint") % 10).cast("string")})
    sinks.write_by_shard(q, path)
    sinks.write_by_shard(q.where("shard in ('3', '7')"), path)
    out = None
    for digit in range(10):
        one = tables.read_queue_shard(spark, path, digit)
        out = one if out is None else out.unionByName(one)
    return out.select("orgnr", "year", "create_time", "processing_priority", "shard")


@query(f"WITH {M} SELECT orgnr, version, status, CASE WHEN status = 'success' THEN file_hash END AS file_hash, CASE WHEN status <> 'success' THEN journalnr END AS journalnr FROM m")
def united_shards(spark, sf):
    """Manifests of two ages, each with columns that the other lacks, read as one."""
    path, m = _folder(spark, "shards"), manifest(spark, sf)
    m.where("status = 'success'").select("orgnr", "version", "status", "file_hash").write.parquet(f"{path}/a")
    m.where("status <> 'success'").select("orgnr", "version", "journalnr", "status").write.parquet(f"{path}/b")
    return tables.read_shards(spark, f"{path}/*").select("orgnr", "version", "status", "file_hash", "journalnr")


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE year(o_orderdate) = (SELECT max(year(o_orderdate)) FROM orders)")
def latest_snapshot(spark, sf):
    """A snapshot for each year; two columns of the last one."""
    path = _folder(spark, "snapshots")
    table(spark, sf, "orders").withColumn("y", F.year("o_orderdate")).write.partitionBy("y").parquet(path)
    return tables.latest_snapshot(spark, f"{path}/y=*", ["o_orderkey", "o_totalprice"])


@query("SELECT c_custkey, c_name, c_acctbal, c_nationkey FROM customer")
def entity_dump(spark, sf):
    """Entities as gzip files that hold a JSON array of up to 1,000 each, cut into rows as they are unpacked."""
    path = _folder(spark, "dump")
    c = table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal", "c_nationkey", F.floor(F.col("c_custkey") / 1000).alias("g"))
    arrays = c.groupBy("g").agg(F.to_json(F.collect_list(F.struct("c_custkey", "c_name", "c_acctbal", "c_nationkey"))).alias("value"))
    arrays.write.partitionBy("g").option("compression", "gzip").text(path)
    return tables.read_dump(spark, f"{path}/g=*/*.gz", "c_custkey long, c_name string, c_acctbal double, c_nationkey int", 4)


@query("SELECT page_id || '.html' AS member, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS size, sha256(coalesce(html, '')) AS content FROM pages")
def archived_pages(spark, sf):
    """Pages landed in ZIP archives of up to 50, whose members are found in the directories and read by ranges."""

    def packed(rows: pd.DataFrame) -> pd.DataFrame:
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
            for r in rows.itertuples(index=False):
                z.writestr(f"{r.page_id}.html", r.html)
        return pd.DataFrame({"path": [f"{rows['g'].iloc[0]}.zip"], "content": [out.getvalue()]})

    root = _folder(spark, "archives")
    p = table(spark, sf, "pages").select("page_id", F.coalesce("html", F.lit("")).alias("html"), F.floor(F.col("page_id") / 50).alias("g"))
    files.put_objects(p.groupBy("g").applyInPandas(packed, "path string, content binary"), root).count()
    return files.zip_members(spark, root, ".html").select("member", F.octet_length("content").cast("long").alias("size"), F.sha2("content", 256).alias("content"))


@query("SELECT CAST(s_suppkey AS VARCHAR) AS orgnr, CAST(2000 + s_nationkey AS INTEGER) AS year FROM supplier")
def held_files(spark, sf):
    """Files landed in the holding area, found again by their names."""
    root = _folder(spark, "holding")
    s = table(spark, sf, "supplier").select(F.concat(F.col("s_suppkey"), F.lit("_"), 2000 + F.col("s_nationkey"), F.lit(".pdf")).alias("path"), F.col("s_name").cast("binary").alias("content"))
    files.put_objects(s, root).count()
    return files.holding(spark, root).select("orgnr", "year")


@query("SELECT user_id, event_type, event_id, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id DESC) = 1")
def streamed_latest(spark, sf):
    """Events that land as files, folded batch by batch into a published table: the last of each user and type."""
    path = _folder(spark, "stream")
    e = table(spark, sf, "events").select("user_id", "event_type", "event_id", "value")
    e.repartition(4, "event_id").write.json(f"{path}/in")
    landed = flows.landed_json(spark, f"{path}/in", "user_id long, event_type string, event_id long, value double", 2)
    flows.upsert_stream(landed, f"{path}/table", ["user_id", "event_type"], "event_id", f"{path}/at").awaitTermination()
    return sinks.current(spark, f"{path}/table")


@query("""WITH r AS (SELECT o_custkey, o_orderkey, o_totalprice, CASE WHEN o_orderkey % 3 = 0 THEN '20240102' ELSE '20240101' END AS d, CASE WHEN o_orderkey % 2 = 0 THEN '0900' ELSE '0030' END AS t FROM orders)
SELECT o_custkey, CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_totalprice, d AS collection_date, t AS collection_time FROM r QUALIFY rank() OVER (PARTITION BY o_custkey ORDER BY d DESC, t DESC) = 1""")
def stored_sections(spark, sf):
    """Runs appended to a section, and of each customer the rows of the last run that has some."""
    store, o = _folder(spark, "store"), table(spark, sf, "orders")
    kinds = {"o_custkey": "bigint", "o_orderkey": "string", "o_totalprice": "double"}
    for d, third in (("20240101", "o_orderkey % 3 <> 0"), ("20240102", "o_orderkey % 3 = 0")):
        for t, half in (("0030", "o_orderkey % 2 = 1"), ("0900", "o_orderkey % 2 = 0")):
            sinks.append_section(o.where(f"{third} and {half}"), store, "totals", kinds, d, t)
    return tables.latest_collection(tables.read_section(spark, store, "totals"), ["o_custkey"])


@query("SELECT o_orderkey, o_orderstatus FROM orders")
def published_table(spark, sf):
    """A table published twice, the second time on the version that was read."""
    path, o = _folder(spark, "table"), table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    sinks.publish(o.where("o_orderstatus <> 'O'"), path)
    base = sinks.versions(spark, path)[-1]
    sinks.publish(sinks.current(spark, path).unionByName(o.where("o_orderstatus = 'O'")), path, base=base)
    return sinks.current(spark, path)



@query("SELECT CAST(l_orderkey AS VARCHAR) AS orgnr, CAST(l_linenumber AS INTEGER) AS year, CAST(1 AS INTEGER) AS version, l_returnflag AS status, CAST(NULL AS VARCHAR) AS pdf_hash FROM lineitem")
def old_manifest(spark, sf):
    """A manifest from before versions and content hashes, with a column of its own, read with today's columns."""
    path = _folder(spark, "manifest")
    table(spark, sf, "lineitem").select(F.col("l_orderkey").cast("string").alias("orgnr"), F.col("l_linenumber").cast("int").alias("year"), F.col("l_returnflag").alias("status"), F.lit(1).alias("gone")).write.parquet(path)
    return tables.read_manifest(spark, path).select("orgnr", "year", "version", "status", "pdf_hash")


@query("""SELECT CAST(to_json({'o_orderkey': o_orderkey, 'o_orderstatus': o_orderstatus, 'none': NULL}) AS VARCHAR) AS value FROM orders""")
def json_lines(spark, sf):
    return sinks.lines_of(table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", F.lit(None).cast("string").alias("none")))


@query(f"""WITH {Q}, w AS (SELECT * FROM q WHERE year IS NOT NULL AND processing_priority = create_time AND NOT EXISTS (
  SELECT 1 FROM supplier WHERE CAST(s_suppkey AS VARCHAR) = q.orgnr AND 2015 + s_suppkey % 7 = q.year AND create_time <= epoch(TIMESTAMP '1996-01-01')))
SELECT *, CAST(row_number() OVER (ORDER BY processing_priority DESC NULLS LAST, orgnr NULLS LAST, year NULLS LAST) - 1 AS BIGINT) AS position FROM w""")
def coordinated(spark, sf):
    """Landed files drained into the first manifest, and the prioritised fast lane without what they have done."""
    root = _folder(spark, "coordinated")
    done = table(spark, sf, "supplier").select(F.concat(F.col("s_suppkey"), F.lit("_"), 2015 + F.col("s_suppkey") % 7, F.lit(".pdf")).alias("path"), F.lit(b"pdf").alias("content"))
    files.put_objects(done, f"{root}/holding").count()
    accounts = spark.createDataFrame([], "orgnr string, json_year int, journalnr string")
    return commands.coordinate(spark, f"{root}/manifest", waiting(spark, sf), f"{root}/holding", accounts, "1996-01-01T00:00:00Z")
