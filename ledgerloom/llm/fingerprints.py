"""Document fingerprints: a Merkle tree over paragraphs and sections, in DataFrame functions only.

A section is a line of the text, a paragraph a stretch of it that ends behind
punctuation of any script (and its space, if the script has one).  Stretches of
over LONG characters are cut further at white space behind words with a
certain hash, runs without white space behind characters whose hash with the
two before is a certain one, and at last after MOST characters; so an edit
moves few boundaries beyond itself.  Leaf: hash of a paragraph; node: hash of
its section's leaves; root: hash of the nodes.  The fingerprint spells the tree
``root|node:leaf,leaf|node:leaf``: equal roots tell equal texts, and differing
nodes and leaves tell where an edit is.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .shared import read_table

PARAGRAPH = r"(?<=[\p{P}\p{S}]\s)|(?<=[\p{P}&&[^\x00-\x{2E7F}]])"
LONG, MOST, WORDS_A_LEAF, CHARS_A_LEAF = 64, 256, 4, 32
MARK = "\x01"
ROWS_A_RANGE = 4000
ROOT, NODE = 64, 32


def _marked(parts: Column, mark) -> Column:
    """The parts cut anew behind those that ``mark(part, place)`` holds for; a mark of the text itself is told apart."""
    def part(c: Column, k: Column) -> Column:
        own = F.replace(c, F.lit(MARK), F.lit(MARK + "\x02"))
        return F.when(mark(c, k), F.concat(own, F.lit(MARK))).otherwise(own)

    return F.split(F.array_join(F.transform(parts, part), ""), "(?<=\x01)(?!\x02)")


def _cutter(over: int, how):
    """A function that has parts of more than ``over`` characters cut by ``how``."""
    def cut(parts: Column) -> Column:
        new = F.flatten(F.transform(parts, lambda c: F.when(F.length(c) > over, F.filter(how(c), lambda x: x != "")).otherwise(F.array(c))))
        return F.when(F.exists(parts, lambda c: F.length(c) > over), new).otherwise(parts)

    return cut


def _by_words(c: Column) -> Column:
    return _marked(F.split(c, r"(?<=\s)(?=\S)"), lambda w, _: F.pmod(F.xxhash64(w), F.lit(WORDS_A_LEAF)) == 0)


def _by_characters(c: Column) -> Column:
    chars = F.split(c, "(?s)(?<=.)(?=.)")
    return F.flatten(F.transform(F.array(chars), lambda all_: _marked(all_, lambda x, k: F.pmod(F.xxhash64(x, F.get(all_, k - 1), F.get(all_, k - 2)), F.lit(CHARS_A_LEAF)) == 0)))


def _let(c: Column, then) -> Column:
    """``then(c)``, with ``c`` evaluated once."""
    return F.get(F.transform(F.array(c), then), F.lit(0))


def leaves_of(line: Column) -> Column:
    """The paragraphs of a line."""
    parts = F.split(line, PARAGRAPH)
    for over, how in [(LONG, _by_words), (MOST, _by_characters), (MOST, lambda c: F.regexp_extract_all(c, F.lit(f"(?s).{{1,{MOST}}}"), F.lit(0)))]:
        parts = _let(parts, _cutter(over, how))
    return parts


def fingerprint(text: Column) -> Column:
    """The tree of a text (null: empty)."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    leaves = F.transform(F.split(text, "\n"), lambda line: F.array_join(F.transform(leaves_of(line), F.md5), ","))
    nodes = F.transform(leaves, lambda c: F.concat(F.md5(c), F.lit(":"), c))
    return _let(nodes, lambda n: F.concat(F.sha2(F.array_join(F.transform(n, lambda c: F.substring(c, 1, NODE)), ","), 256), F.lit("|"), F.array_join(n, "|")))


def likeness(a: Column, b: Column) -> Column:
    """0 to 1: equal roots 1, else the share of distinct leaves in common."""
    def leaves(c: Column) -> Column:
        return F.regexp_extract_all(c, F.lit("(?<=[:,])[0-9a-f]{32}"), F.lit(0))

    common = F.size(F.array_intersect(leaves(a), leaves(b)))
    return F.when(F.substring(a, 1, ROOT) == F.substring(b, 1, ROOT), 1.0).otherwise(common / F.greatest(F.lit(1), F.size(F.array_union(leaves(a), leaves(b)))))


def changed_sections(a: Column, b: Column) -> Column:
    """Numbers (from 0) of the sections of ``a`` whose node ``b`` lacks: where the edits are."""
    def nodes(c: Column) -> Column:
        return F.transform(F.split(F.substring(c, ROOT + 2, 2**31 - 1), "\\|"), lambda s: F.substring(s, 1, NODE))

    return F.filter(F.transform(nodes(a), lambda s, k: F.when(~F.array_contains(nodes(b), s), k)), lambda k: k.isNotNull())


def _range_of(id_: Column, cuts: list[int]) -> Column:
    """Number of cuts that are <= id, by binary search in one constant array."""
    array = F.from_json(F.lit(json.dumps(cuts)), "array<bigint>")
    steps = F.sequence(F.lit(1), F.lit(len(cuts).bit_length() + 1))

    def half(s: Column, _: Column) -> Column:
        middle = F.shiftright(s["low"] + s["high"], 1)
        up = (s["low"] < s["high"]) & (F.get(array, middle) <= id_)
        return F.struct(F.when(up, middle + 1).otherwise(s["low"]).alias("low"), F.when(up, s["high"]).otherwise(F.when(s["low"] < s["high"], middle).otherwise(s["high"])).alias("high"))

    return F.aggregate(steps, F.struct(F.lit(0).alias("low"), F.lit(len(cuts)).alias("high")), half, lambda s: s["low"])


def with_next(docs: DataFrame, key: str, carry: list[str]) -> DataFrame:
    """Add ``next_<c>`` of the row that follows in descending ``key`` (the last row is followed by the first).

    Rows are dealt out by ranges of the key, each sorted on its own; the first
    row of a range (one for each ROWS_A_RANGE rows) is also given to the range
    before it, so no task sees more than its range.  Null keys come last; ties
    are in order of the carried columns.
    """
    spark = docs.sparkSession
    k = F.coalesce(F.col(key), F.lit(-(2**63)))
    rows = docs.count()
    n = max(64, rows // ROWS_A_RANGE)
    cuts = docs.select(F.percentile_approx(k, [i / n for i in range(1, n)] or [0.5], 20 * n)).first()[0] or []
    ranged = docs.withColumns({"_k": k, "_range": _range_of(k, sorted(set(cuts)))})
    heads = ranged.groupBy("_range").agg(F.max("_k").alias("_k"))  # a row for each range
    heads = heads.withColumn("_to", F.coalesce(F.lead("_range").over(Window.orderBy("_range")), F.min("_range").over(Window.partitionBy(F.lit(1)))))
    first = ranged.join(F.broadcast(heads), ["_range", "_k"]).withColumn("_n", F.row_number().over(Window.partitionBy("_range").orderBy(*carry))).where("_n = 1")
    ghosts = first.select(*docs.columns, "_k", F.col("_to").alias("_range"), F.lit(True).alias("_ghost"))
    w = Window.partitionBy("_range").orderBy("_ghost", F.desc("_k"), *carry)
    both = ranged.withColumn("_ghost", F.lit(False)).unionByName(ghosts).repartition(n // 2, "_range")  # partitions grow with the ranges
    return both.withColumns({f"next_{c}": F.lead(c).over(w) for c in carry}).where("not _ghost").drop("_k", "_range", "_ghost")


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    d = with_next(docs, "doc_id", ["text"])
    n = F.length("text").cast("long")
    cut = F.floor(n / 3).cast("int")
    d = d.withColumns({"n_chars": n, "edited": F.concat(F.substring(F.col("text"), F.lit(1), n.cast("int") - cut), F.substring(F.col("next_text"), F.lit(1), cut))})
    d = d.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), fingerprint(F.col("text")).alias("fingerprint"), fingerprint(F.col("edited")).alias("edited_fingerprint"), fingerprint(F.col("next_text")).alias("_next"))
    return d.withColumns({"near_edited": likeness(F.col("fingerprint"), F.col("edited_fingerprint")), "near_next": likeness(F.col("fingerprint"), F.col("_next"))}).drop("_next")
