"""Token ids in compressed files with a shared dictionary.

A zstandard dictionary is trained on serialized id arrays (of a bounded
sample) and shared by all documents; each document is compressed on its own,
so a short one can be read without its neighbours.  Files are Parquet rows of
up to BLOCK_BYTES of frames, in ascending doc_id order, with the documents'
ids, offsets and counts as an index and the dictionary's SHA-256.
"""

from __future__ import annotations

import hashlib
import os
import re
import unicodedata
import uuid
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .blocks import release
from .shared import discard, materialize, read_table, shared_dir

END_ID = 1
BLOCK_BYTES = 1 << 20
#: The dictionary is trained on this many documents (smallest hash of doc_id), PIECES stretches of PIECE_IDS ids spread over each.
SAMPLE_DOCS, PIECES, PIECE_IDS, DICT_BYTES = 512, 4, 1024, 64 << 10
#: Distinct words and letter runs whose ids a Python worker remembers; then it forgets them all.
CACHE_WORDS = 600_000

FRAME_SCHEMA = "doc_id long, n_tokens long, frame binary"
BLOCK_SCHEMA = "shard int, block int, first_id long, last_id long, dict_sha256 string, total long, doc_ids binary, counts binary, offsets binary, frames binary"
DOC_SCHEMA = "shard int, block int, doc_id long, inside long, n_tokens long, ids_crc32 long"

#: Marks before and after a run of letters, which the tokenizer cuts off.
_MARKS = "[!-&(-/:;=?@\\[-`{}~]*"
_WORD = re.compile(rf"({_MARKS})([^\W\d_]+)({_MARKS})")
#: Letter runs encoded as one text.
JOINED = 512


def _stays_letter(c: str) -> bool:
    """Whether the tokenizer sees one letter whatever stands beside it."""
    return unicodedata.category(c)[0] == "L" and all(len(x) == 1 and unicodedata.category(x)[0] == "L" for x in (c.lower(), unicodedata.normalize("NFC", c), unicodedata.normalize("NFC", c.lower())))


class Encoder:
    """Ids as little-endian bytes.

    The tokenizer drops white space and merges nothing across it, so words
    between ASCII white space are encoded once and remembered.  It also cuts letters
    from marks, so a word is put together from its letters and its marks, and
    many letter runs are encoded as one text, whose ids are split where a token
    ends a word.  Where there are not as many ends as runs, the text is halved.
    A word with a letter that is no single letter once lower-cased and composed
    (dotted capital I leaves a combining dot, which joins the marks behind it)
    is encoded whole, as are words with anything but letters and ASCII marks.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks are the threads; others would each keep memory of their own
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.ends = np.zeros(self.tokenizer.get_vocab_size(), bool)
        self.ends[[i for token, i in self.tokenizer.get_vocab().items() if token.endswith("</w>")]] = True
        self.known: dict[str, bytes] = {"": b""}
        self.letters: set[str] = set()  # known to stay letters

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, "<u4") for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _stay_letters(self, run: str) -> bool:
        if not self.letters.issuperset(run):
            if not all(map(_stays_letter, new := set(run) - self.letters)):
                return False
            self.letters |= new
        return True

    def _learn_runs(self, runs: list[str]) -> None:
        groups = [runs[at : at + JOINED] for at in range(0, len(runs), JOINED)]
        while groups:
            halves = []
            for group, ids in zip(groups, self._ids([" ".join(g) for g in groups]), strict=True):
                cuts = np.flatnonzero(self.ends[ids]) + 1
                if len(group) == 1:
                    self.known[group[0]] = ids.tobytes()
                elif len(cuts) == len(group) and cuts[-1] == len(ids):
                    raw, at = ids.tobytes(), [0, *(4 * cuts).tolist()]
                    self.known.update((w, raw[i:j]) for w, i, j in zip(group, at, at[1:], strict=False))
                else:
                    halves += [group[: len(group) // 2], group[len(group) // 2 :]]
            groups = halves

    def _learn(self, words: set[str]) -> None:
        known, parts, odd = self.known, {}, []
        for w in words:
            if (m := _WORD.fullmatch(w)) and (w.isascii() or self._stay_letters(m[2])):
                parts[w] = m.groups()
            else:
                odd.append(w)
        marks = {p for before, _, after in parts.values() for p in (before, after)}
        odd += [p for p in marks - words if p not in known]
        for at in range(0, len(odd), 10_000):
            known.update((w, ids.tobytes()) for w, ids in zip(odd[at : at + 10_000], self._ids(odd[at : at + 10_000]), strict=True))
        self._learn_runs([r for r in {run for _, run, _ in parts.values()} if r not in known])
        known.update((w, known[before] + known[run] + known[after]) for w, (before, run, after) in parts.items() if w != run)

    def encode(self, texts: pa.Array) -> list[bytes]:
        words = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        coded = words.flatten().dictionary_encode()
        # words hold no line breaks: one string, split again, is far quicker than to_pylist()
        distinct = pc.binary_join(pa.ListArray.from_arrays([0, len(coded.dictionary)], coded.dictionary), "\n")[0].as_py().split("\n")[: len(coded.dictionary)]
        if len(self.known) > CACHE_WORDS:
            self.known = {"": b""}
            release()
        self._learn({w for w in distinct if w not in self.known})
        pieces = list(map(self.known.__getitem__, distinct))
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces)) // 4
        pool, begins = np.frombuffer(b"".join(pieces), "<u4"), np.cumsum(sizes) - sizes
        codes = coded.indices.to_numpy()
        ends = np.concatenate([[0], np.cumsum(sizes[codes])])
        ids = pool[np.repeat(begins[codes] - ends[:-1], sizes[codes]) + np.arange(ends[-1])]
        cuts = ends[np.concatenate([[0], np.cumsum(pc.list_value_length(words).to_numpy())])].tolist()
        return [ids[i:j].tobytes() for i, j in zip(cuts, cuts[1:], strict=False)]


@lru_cache(1)
def encoder(path: str) -> Encoder:
    """One encoder a Python worker, whose later tasks know the words of its earlier ones."""
    return Encoder(path)


def spread(ids: np.ndarray) -> list[bytes]:
    """The whole array, or PIECES stretches of it from begin to end."""
    if len(ids) <= PIECES * PIECE_IDS:
        return [ids.tobytes()] if len(ids) else []
    return [ids[int(k) : int(k) + PIECE_IDS].tobytes() for k in np.linspace(0, len(ids) - PIECE_IDS, PIECES)]


def train_dictionary(docs: DataFrame, path: str) -> bytes:
    """A dictionary for the ids of ``docs``.

    The sampled texts are also encoded by the tokenizer itself, and it is an
    error if ``Encoder`` gives other ids: then the tokenizer is none of the
    kind that ``Encoder`` can put together from words.
    """
    place = F.xxhash64("doc_id")
    # hashes first: no task sends more texts than the sample has
    last = docs.select(place.alias("place")).orderBy("place").limit(SAMPLE_DOCS).agg(F.max("place").alias("last")).first()["last"]
    sample = docs.where(place <= F.lit(last).cast("long")).select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).orderBy(F.xxhash64("doc_id"), "text").limit(SAMPLE_DOCS)

    def run(batches):
        enc = encoder(path)
        for batch in batches:
            texts = batch.column(1)
            found = enc.encode(texts)
            for text, raw in zip(texts.to_pylist(), found, strict=True):
                ids = np.frombuffer(raw, "<u4")
                if ids.tolist() != enc.tokenizer.encode(text, add_special_tokens=False).ids:
                    raise ValueError("this tokenizer's ids of a text are not those of its words put together")
                parts = spread(ids)
                yield pa.RecordBatch.from_arrays([pa.array(parts, pa.binary())], ["ids"])

    ids = [bytes(r["ids"]) for r in sample.mapInArrow(run, "ids binary").collect()]  # at most SAMPLE_DOCS * PIECES * PIECE_IDS ids
    try:
        return zstandard.train_dictionary(DICT_BYTES, ids).as_bytes()
    except zstandard.ZstdError:  # too few or too short samples
        return b""


def encode_frames(docs: DataFrame, path: str, dictionary: bytes, end_id: int = END_ID) -> DataFrame:
    """doc_id, n_tokens and the compressed ids of each document, the end id appended (null text: only that)."""

    def run(batches):
        enc = encoder(path)
        c = zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                ids = [b + end for b in enc.encode(part.column(1))]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([len(b) // 4 for b in ids], pa.int64()), pa.array([c.compress(b) for b in ids], pa.binary())], ["doc_id", "n_tokens", "frame"])
        release()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, FRAME_SCHEMA)


def write_token_files(docs: DataFrame, out: str, path: str, end_id: int = END_ID) -> None:
    """Write ``out/blocks`` and ``out/dictionary``; null doc_ids come first, equal ones side by side."""
    spark = docs.sparkSession
    dictionary = train_dictionary(docs, path)
    sha = hashlib.sha256(dictionary).hexdigest()
    spark.createDataFrame([(sha, bytearray(dictionary))], "dict_sha256 string, dictionary binary").coalesce(1).write.parquet(f"{out}/dictionary")
    frames = materialize(encode_frames(docs, path, dictionary, end_id), "frames")

    def run(batches):
        from pyspark import TaskContext

        shard, block = TaskContext.get().partitionId(), 0
        held, size = [], 0

        def flush():
            ids, counts, blobs = zip(*held, strict=True)
            lens = np.cumsum([0, *map(len, blobs)])
            present = np.array([i is not None for i in ids])
            known = [i for i in ids if i is not None]
            raw = np.array([i or 0 for i in ids], "<i8").tobytes() + np.packbits(present).tobytes()
            return pa.RecordBatch.from_pydict({
                "shard": pa.array([shard], pa.int32()), "block": pa.array([block], pa.int32()), "first_id": pa.array([min(known, default=None)], pa.int64()), "last_id": pa.array([max(known, default=None)], pa.int64()), "dict_sha256": pa.array([sha]), "total": pa.array([sum(counts)], pa.int64()), "doc_ids": pa.array([raw], pa.binary()),
                "counts": pa.array([np.array(counts, "<i8").tobytes()], pa.binary()), "offsets": pa.array([lens.astype("<i8").tobytes()], pa.binary()), "frames": pa.array([b"".join(blobs)], pa.binary()),
            })

        for batch in batches:
            for row in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                held.append(row)
                size += len(row[2])
                if size >= BLOCK_BYTES:
                    yield flush()
                    held, size, block = [], 0, block + 1
        if held:
            yield flush()

    order = ["doc_id", "n_tokens", F.xxhash64("frame")]  # the whole order, so that rows with one or no doc_id are split too
    ordered = frames.repartitionByRange(*order).sortWithinPartitions(*order)
    # small row groups: a reader of a few documents skips the others by first_id and last_id
    ordered.mapInArrow(run, BLOCK_SCHEMA).write.option("compression", "none").option("parquet.block.size", 8 * BLOCK_BYTES).parquet(f"{out}/blocks")
    discard(frames)


def _decode_block(row: dict, dictionary: bytes, wanted: set[int] | None = None):
    """(doc_id, ids as bytes) of each document of a block, or of the wanted ones: no other frame is decompressed."""
    d = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)
    off = np.frombuffer(row["offsets"], "<i8")
    n = len(off) - 1
    ids = np.frombuffer(row["doc_ids"][: 8 * n], "<i8")
    present = np.unpackbits(np.frombuffer(row["doc_ids"][8 * n :], np.uint8), count=n)
    frames = memoryview(row["frames"])
    for k in range(n):
        one = int(ids[k]) if present[k] else None
        if wanted is None or one in wanted:
            yield one, d.decompress(frames[off[k] : off[k + 1]])


def dictionary_of(spark: SparkSession, out: str) -> bytes:
    row = spark.read.parquet(f"{out}/dictionary").first()
    dictionary = bytes(row["dictionary"])
    if hashlib.sha256(dictionary).hexdigest() != row["dict_sha256"]:
        raise ValueError("the dictionary does not have the SHA-256 it is kept under")
    return dictionary


def read_token_files(spark: SparkSession, out: str) -> DataFrame:
    """Per document: place (``start``: ids of all documents before it), number and CRC-32 of its ids, all from the files."""
    dictionary = dictionary_of(spark, out)
    sha = hashlib.sha256(dictionary).hexdigest()

    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                if row["dict_sha256"] != sha:
                    raise ValueError("a block was written with another dictionary")
                docs = list(_decode_block(row, dictionary))
                counts = np.array([len(b) // 4 for _, b in docs])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["shard"]] * len(docs), pa.int32()), pa.array([row["block"]] * len(docs), pa.int32()), pa.array([i for i, _ in docs], pa.int64()),
                     pa.array(np.cumsum(counts) - counts, pa.int64()), pa.array(counts, pa.int64()), pa.array([zlib.crc32(b) for _, b in docs], pa.int64())],
                    ["shard", "block", "doc_id", "inside", "n_tokens", "ids_crc32"],
                )

    blocks = spark.read.parquet(f"{out}/blocks")
    before = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    totals = blocks.select("shard", "block", "total")
    shards = totals.groupBy("shard").agg(F.sum("total").alias("all"))  # a row for each partition of the writer
    shards = shards.withColumn("shard_start", F.coalesce(F.sum("all").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("all")
    places = totals.withColumn("block_start", F.coalesce(F.sum("total").over(before), F.lit(0))).join(shards, "shard").select("shard", "block", (F.col("block_start") + F.col("shard_start")).alias("base"))
    docs = blocks.mapInArrow(run, DOC_SCHEMA)
    return docs.join(places, ["shard", "block"]).select("doc_id", (F.col("base") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")


def lookup(spark: SparkSession, out: str, doc_ids: list[int]) -> dict[int, list[int]]:
    """Ids of a few documents; of repeated doc_ids one.

    Blocks are chosen by their first and last doc_id, which the scan skips row
    groups by; in a block only the wanted frames, by their offsets, are
    decompressed.
    """
    dictionary = dictionary_of(spark, out)
    wanted = {int(i) for i in doc_ids}
    if not wanted:
        return {}
    inside = F.exists(F.array(*(F.lit(i).cast("long") for i in sorted(wanted))), lambda i: (F.col("first_id") <= i) & (F.col("last_id") >= i))
    blocks = spark.read.parquet(f"{out}/blocks").where((F.col("first_id") <= max(wanted)) & (F.col("last_id") >= min(wanted)) & inside).select("doc_ids", "offsets", "frames")

    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                for i, raw in _decode_block(batch.slice(k, 1).to_pylist()[0], dictionary, wanted):
                    yield pa.RecordBatch.from_arrays([pa.array([i], pa.int64()), pa.array([np.frombuffer(raw, "<u4").tolist()], pa.list_(pa.int64()))], ["doc_id", "ids"])

    return {r["doc_id"]: r["ids"] for r in blocks.mapInArrow(run, "doc_id long, ids array<long>").collect()}


def op7_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    out = f"{shared_dir(spark)}/tokens-{uuid.uuid4().hex}"
    write_token_files(read_table(spark, sf_dir, "documents"), out, public_tokenizers.path("word_bpe_49k.json"))
    return read_token_files(spark, out)
