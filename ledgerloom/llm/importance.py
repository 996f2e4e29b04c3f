"""Importance resampling towards a target distribution, over hashed bags of n-grams.

Each partition has a DuckDB of its own: SQL cuts a slice of texts into words,
windows them into n-grams and counts buckets, the hash being a registered
zlib function that sees each different n-gram of a slice once.  What comes out
is spilled to Parquet: a row for each document, and one for the partition's
sums, so a bucket reaches the shuffle once a partition however hot it is.
Spark merges the sums, turns them into gains and scores the rows.

Nulls: a null text has no features (weight 0, never drawn where ``min_words``
is over 0); a null doc_id is written ``null`` in the random key and comes last
among ties.  Rows with one id and text have one score and follow each other.
Empty tables give no rows; with an empty target the gains are those of a
target without features.  Other columns, whatever their names, do not matter.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ..operators.ranking import global_rank
from .shared import discard, materialize, read_table

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Bytes of text in one SQL statement.
SLICE_BYTES = 2 << 20

COUNTS = "n_words long, n_features long, buckets array<int>, counts array<long>, totals boolean"


def features_sql(n_gram: int, buckets: int) -> str:
    """Bucket counts of each row of ``slice`` (row, text): runs of 1 to ``n_gram`` words, joined by one space."""
    runs = ["SELECT row, word AS feature FROM words"]
    for n in range(2, n_gram + 1):
        parts = ", ".join(["word", *(f"lead(word, {k}) OVER w" for k in range(1, n))])
        runs.append(f"SELECT row, concat_ws(' ', {parts}) AS feature FROM words WINDOW w AS (PARTITION BY row ORDER BY pos) QUALIFY lead(word, {n - 1}) OVER w IS NOT NULL")
    return f"""
    WITH cut AS (SELECT row, regexp_extract_all(translate(text, '{UPPER}', '{UPPER.lower()}'), '{WORD}') AS ws FROM slice WHERE text IS NOT NULL),
    words AS (SELECT row, unnest(ws) AS word, generate_subscripts(ws, 1) AS pos FROM cut),
    features AS (SELECT row, feature, count(*) AS n FROM ({" UNION ALL ".join(runs)}) GROUP BY ALL),
    hashed AS (SELECT feature, crc32(feature) % {buckets} AS bucket FROM (SELECT DISTINCT feature FROM features)),
    summed AS (SELECT row, bucket, sum(n)::BIGINT AS n FROM features JOIN hashed USING (feature) GROUP BY ALL),
    listed AS (SELECT row, list(bucket::INTEGER ORDER BY bucket) AS buckets, list(n ORDER BY bucket) AS counts, sum(n)::BIGINT AS n_features FROM summed GROUP BY row)
    SELECT cut.row, len(ws)::BIGINT AS n_words, coalesce(n_features, 0)::BIGINT AS n_features, buckets, counts FROM cut LEFT JOIN listed USING (row) ORDER BY cut.row
    """


def _crc32(features: pa.Array) -> pa.Array:
    if isinstance(features, pa.ChunkedArray):
        features = features.combine_chunks()
    return pa.array([zlib.crc32(f) for f in features.cast(pa.binary()).to_pylist()], pa.int64())


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about SLICE_BYTES of text, or one longer text, each."""
    ends = pc.cumulative_sum(pc.fill_null(pc.binary_length(batch["text"].cast(pa.large_string())), 0).cast(pa.int64())).to_numpy()
    at = 0
    while at < len(ends):
        before = int(ends[at - 1]) if at else 0
        upto = max(at + 1, int(ends.searchsorted(before + SLICE_BYTES, "right")))
        yield batch.slice(at, upto - at)
        at = upto


def spill_counts(docs: DataFrame, n_gram: int, buckets: int, keep: list[str]) -> DataFrame:
    """Written table of (row: the columns ``keep``, COUNTS); rows with ``totals`` hold the sums of a partition."""
    sql = features_sql(n_gram, buckets)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import duckdb

        con = duckdb.connect(config={"threads": 1, "memory_limit": "512MB", "temp_directory": ""})
        con.create_function("crc32", _crc32, ["VARCHAR"], "BIGINT", type="arrow")
        con.execute("CREATE TABLE totals (bucket INTEGER PRIMARY KEY, n BIGINT)")
        schema = None
        for batch in batches:
            for part in _slices(batch):
                text = part["text"].cast(pa.large_string())
                con.register("slice", pa.table({"row": pa.array(range(len(text)), pa.int64()), "text": text}))
                got = con.sql(sql).to_arrow_table()
                con.register("got", got)
                con.execute("INSERT INTO totals SELECT bucket, sum(n)::BIGINT FROM (SELECT unnest(buckets) AS bucket, unnest(counts) AS n FROM got) GROUP BY bucket ON CONFLICT DO UPDATE SET n = n + excluded.n")
                place = pc.index_in(pa.array(range(len(text)), pa.int64()), got["row"].combine_chunks())
                got = got.take(place).combine_chunks()
                zero = lambda c: pc.fill_null(got[c].combine_chunks(), 0)
                out = pa.RecordBatch.from_arrays(
                    [part["row"], zero("n_words"), zero("n_features"), got["buckets"].combine_chunks().cast(pa.list_(pa.int32())), got["counts"].combine_chunks().cast(pa.list_(pa.int64())), pa.array([False] * len(text))],
                    names=["row", "n_words", "n_features", "buckets", "counts", "totals"],
                )
                schema = out.schema
                yield out
        if schema is not None:
            sums = con.execute("SELECT list(bucket ORDER BY bucket), list(n ORDER BY bucket), coalesce(sum(n), 0)::BIGINT FROM totals").fetchone()
            yield pa.RecordBatch.from_arrays([pa.nulls(1, schema.field("row").type), *(pa.array([v], schema.field(k).type) for k, v in (("n_words", 0), ("n_features", sums[2]), ("buckets", sums[0]), ("counts", sums[1]), ("totals", True)))], schema=schema)
        con.close()

    rows = docs.select(F.struct(*[F.col(c) for c in keep]).alias("row"), F.col("text").cast("string").alias("text"))
    return materialize(rows.mapInArrow(count, f"row {rows.schema['row'].dataType.simpleString()}, {COUNTS}"), "bucket-counts")


def _totals(counts: DataFrame, name: str) -> DataFrame:
    pairs = counts.where("totals").select(F.explode(F.arrays_zip("buckets", "counts")).alias("p"))
    zero = F.lit(0).cast("long")
    return pairs.select(F.col("p.buckets").alias("bucket"), *((F.col("p.counts") if c == name else zero).alias(c) for c in ("s", "t")))


def gains(docs: DataFrame, target: DataFrame, buckets: int) -> DataFrame:
    """One row: floor(1000 * log ratio) of every bucket, with one added to each count; ``buckets`` numbers, whatever the input."""
    zero = F.lit(0).cast("long")
    every = docs.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket"), zero.alias("s"), zero.alias("t"))
    by_bucket = every.union(_totals(docs, "s")).union(_totals(target, "t")).groupBy("bucket").agg(F.sum("s").alias("s"), F.sum("t").alias("t"))
    row = by_bucket.agg(F.sort_array(F.collect_list(F.struct("bucket", "s", "t"))).alias("all"), F.sum("s").alias("ss"), F.sum("t").alias("tt"))
    up = lambda c: c.cast("double")
    gain = lambda x: F.floor(1000 * F.log((up(x["t"]) + 1) * (up(F.col("tot.ss")) + buckets) / ((up(x["s"]) + 1) * (up(F.col("tot.tt")) + buckets))))
    return row.select("all", F.struct("ss", "tt").alias("tot")).select(F.transform("all", gain).alias("gains"))


def _weighed(rows: DataFrame, table: np.ndarray) -> DataFrame:
    """Add ``weight``, the floored mean of the gains over a row's features; buckets and counts go."""
    kept = [f for f in rows.schema if f.name not in ("buckets", "counts")]

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            each = pc.multiply(pa.array(table).take(pc.list_flatten(b["buckets"])), pc.list_flatten(b["counts"])).to_numpy(zero_copy_only=False)
            ends = np.cumsum(pc.fill_null(pc.list_value_length(b["buckets"]), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
            sums = np.concatenate([[0], np.cumsum(each, dtype=np.int64)])
            total = sums[ends] - sums[np.concatenate([[0], ends[:-1]]).astype(np.int64)] if len(ends) else ends
            n = b["n_features"].to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([*(b[f.name] for f in kept), pa.array(total // np.maximum(n, 1), pa.int64())], names=[*(f.name for f in kept), "weight"])

    return rows.mapInArrow(weigh, StructType([*kept, StructField("weight", LongType())]))


def ranked(docs: DataFrame, target: DataFrame, keep: list[str], n_gram: int = 1, buckets: int = 10_000, seed: int = 2024, percent: int = 10, min_words: int = 20) -> DataFrame:
    """(row, n_words, n_features, weight, score, rank) of every row; ``percent`` of those with ``min_words`` words or more are drawn and have a rank.

    ``row`` holds the columns ``keep`` (with doc_id).  Drawing the highest
    sums of weight and Gumbel noise is sampling without replacement in
    proportion to the exponentials of the weights.
    """
    spilled = spill_counts(docs, n_gram, buckets, keep)
    aim = spill_counts(target, n_gram, buckets, [target.columns[0]])
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("row.doc_id").cast("string"), F.lit("null"))), 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296)))
    table = np.array(gains(spilled, aim, buckets).first()["gains"], np.int64)
    rows = _weighed(spilled.where("not totals").select("row", "n_words", "n_features", "buckets", "counts"), table)
    rows = rows.select("*", (F.col("weight") + noise).alias("score"), (F.col("n_words") >= min_words).alias("_may"))
    order = [F.col("_may").desc(), F.col("score").desc(), F.col("row.doc_id").asc_nulls_last(), F.col("n_features"), F.col("n_words")]
    out = global_rank(rows, order, "_position")
    discard(spilled, aim)
    drawn = out.where("_may").count() * percent // 100
    return out.select("row", "n_words", "n_features", "weight", "score", F.when(F.col("_may") & (F.col("_position") < drawn), F.col("_position") + 1).alias("rank"))


def resample(docs: DataFrame, target: DataFrame, **how) -> DataFrame:
    """The drawn rows of ``docs``, all columns, in no order; ``how`` as in ``ranked``."""
    return ranked(docs, target, docs.columns, **how).where("rank is not null").select("row.*")


def op11_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = ranked(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"), ["doc_id"])
    return out.select("row.doc_id", "n_features", "weight", "score", "rank", "n_words")


ORACLE_SQL = rf"""
WITH bits AS (SELECT list(list_reduce(list_prepend(b::BIGINT, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY b) AS crc FROM range(256) AS r(b)),
w AS (SELECT doc_id, kind, unnest(regexp_extract_all(translate(text, '{UPPER}', '{UPPER.lower()}'), '{WORD}')) AS word
      FROM (SELECT doc_id, text, 's' AS kind FROM documents UNION ALL SELECT item_id, text, 't' FROM benchmark)),
h AS (SELECT word, hex(encode(word)) AS x FROM (SELECT DISTINCT word FROM w)),
v AS (SELECT word, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, len(x) + 1, 2), lambda p: (instr('0123456789ABCDEF', x[p]) - 1) * 16 + instr('0123456789ABCDEF', x[p + 1]) - 1)),
                                   lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1])), 4294967295) % 10000 AS bucket FROM h, bits),
f AS (SELECT doc_id, kind, bucket FROM w JOIN v USING (word)),
n AS (SELECT count(*) FILTER (WHERE kind = 's')::DOUBLE AS s, count(*) FILTER (WHERE kind = 't')::DOUBLE AS t FROM f),
g AS (SELECT bucket, floor(1000 * ln((count(*) FILTER (WHERE kind = 't') + 1::DOUBLE) * (n.s + 10000) / ((count(*) FILTER (WHERE kind = 's') + 1::DOUBLE) * (n.t + 10000))))::BIGINT AS gain FROM f, n GROUP BY bucket, n.s, n.t),
m AS (SELECT doc_id, count(*) AS n_features, floor(sum(gain)::DOUBLE / count(*))::BIGINT AS weight FROM f JOIN g USING (bucket) WHERE kind = 's' GROUP BY doc_id),
k AS (SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight, ('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT AS h FROM documents LEFT JOIN m USING (doc_id)),
z AS (SELECT doc_id, n_features, weight, weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score, n_features >= 20 AS may FROM k),
o AS (SELECT *, row_number() OVER (PARTITION BY may ORDER BY score DESC, doc_id) AS r, count(*) OVER (PARTITION BY may) AS n FROM z)
SELECT doc_id, n_features, weight, score, CASE WHEN may AND r <= n * 10 // 100 THEN r END AS rank, n_features AS n_words FROM o
"""
