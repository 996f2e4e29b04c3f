"""From documents to sampled token ids: five stages, each reading what the one before wrote.

All but the last return the columns of ``documents``.  ``n_chars`` is set anew
where a stage shortens texts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import decontamination, ngram_join, quality, sentencepiece_codec, suffix_dedup
from ledgerloom.llm.shared import discard, materialize, read_table, temporary

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return quality.keep_good(docs, read_table(spark, sf_dir, "labels")).select(COLUMNS)


def near_duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, that with the smallest doc_id; documents that share an id, or have none, are told apart by their texts."""
    return ngram_join.keep_one(docs).select(COLUMNS)


def repeated_passages_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 bytes and more that a smaller doc_id has are cut; documents that are nothing but such passages go."""
    marked = docs.select(*COLUMNS, (F.coalesce("text", F.lit("")) == "").alias("was_empty"))
    cut = suffix_dedup.cut_repeats(marked).where("was_empty or text <> ''")
    return cut.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), "n_chars")).select(COLUMNS)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which a twentieth or more is benchmark text go."""
    return decontamination.decontaminate(docs, read_table(spark, sf_dir, "benchmark")).select(COLUMNS)


def sentencepiece_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and distinct sampled segmentations with inclusion scores, as digests."""
    import public_tokenizers

    return sentencepiece_codec.digest(sentencepiece_codec.encode(docs, public_tokenizers.path("piece_bpe_32k.model")))


STAGES = [
    ("quality classifier", quality_stage),
    ("n-gram Jaccard join", near_duplicates_stage),
    ("suffix-array dedup", repeated_passages_stage),
    ("benchmark decontamination", decontamination_stage),
    ("SentencePiece encoding and decoding", sentencepiece_stage),
]

#: Trained and tokenizer stages have no SQL; tests/llm holds brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        with temporary() as keep:  # what a stage has written on its way goes once its result is
            kept = keep(materialize(stage(spark, docs, sf_dir), name.replace(" ", "-")))
        discard(docs)  # nothing reads an earlier stage's table any more
        docs = kept
    return STAGES[-1][1](spark, docs, sf_dir)
