"""Token-ID / binary output: zstandard frames with one shared, trained dictionary.

File format (a folder, written and read by Spark alone, so any store that Spark reaches will do):

* ``dictionary/``: one row ``dict_hash, dictionary, width`` (``width``: bytes of an id, 2 or 4).
* ``blocks/``: one row per block in ascending document order:
  ``part, seq, first_doc, last_doc, n_docs, n_ids, dict_hash, blob``.  ``blob`` is

  ===============  ==================================================================
  8 bytes          ``TOKIDS01``
  16 bytes         hash of the dictionary its frames need (first half of its SHA-256)
  4 + 4 bytes      id width, number of documents n (unsigned, little-endian)
  8 n bytes        document ids (signed; the smallest 64-bit integer stands for null)
  4 n bytes        ids per document (unsigned)
  8 (n+1) bytes    offset index: where each document's frame starts after the index
  rest             one zstandard frame per document
  ===============  ==================================================================

A short document is read by one footer filter on ``first_doc``/``last_doc`` and one small
frame (``read_document``).  The dictionary is trained on a bounded sample
(``sample_docs`` documents by hash order, none above ``sample_doc_bytes``) of serialized id arrays;
with too few samples to train on, it is empty.

Rules: null text is empty (the end id alone); repeated document ids keep all their rows,
next to each other; a null document id comes first; extra columns are ignored; an empty
table gives empty files and no rows.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard as zstd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import pick, stage_path, staged
from .units import encoder

MAGIC = b"TOKIDS01"
NO_ID = -(2**63)
BLOCK_BYTES = 4 << 20

_BLOCKS = (
    "part int, seq int, first_doc long, last_doc long, n_docs int, n_ids long, dict_hash binary, blob binary"
)


def encode_documents(
    docs: DataFrame, *, vocabulary: str, kind: str, end_id: int, width: int = 4, id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """doc_id, ids: the ids of every whole text, then ``end_id``, ``width`` little-endian bytes each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = encoder(vocabulary, kind), struct.pack("<I", end_id)
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                ids = [encode(t) + end for t in part.column(1).to_pylist()]
                if width == 2:
                    ids = [np.frombuffer(x, "<u4").astype("<u2").tobytes() for x in ids]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.binary())], ["doc_id", "ids"])

    return pick(docs, doc_id=id_col, text=text_col).withColumn("doc_id", F.col("doc_id").cast("long")).mapInArrow(
        run, "doc_id long, ids binary"
    )


def train_dictionary(
    encoded: DataFrame, *, size: int = 64 << 10, sample_docs: int = 2000, sample_doc_bytes: int = 16 << 10
) -> bytes:
    """A zstandard dictionary from about ``sample_docs`` arrays (twice that at most) of at most ``sample_doc_bytes`` each."""
    rows = encoded.filter(F.length("ids").between(8, sample_doc_bytes))
    share = int(min(1.0, sample_docs / max(1, rows.count())) * 2**32)
    sample = rows.filter(F.pmod(F.xxhash64("doc_id", "ids"), F.lit(2**32)) <= share).select("ids").limit(2 * sample_docs)
    sample = sorted(bytes(r.ids) for r in sample.collect())
    try:
        return zstd.train_dictionary(size, sample, k=512, d=8).as_bytes()
    except (zstd.ZstdError, ValueError):
        return b""


def dictionary_hash(dictionary: bytes) -> bytes:
    return hashlib.sha256(dictionary).digest()[:16]


def _pack_block(rows: list[tuple[int | None, int, bytes]], width: int, dict_hash: bytes) -> bytes:
    ids = np.array([NO_ID if r[0] is None else r[0] for r in rows], "<i8")
    counts = np.array([r[1] for r in rows], "<u4")
    offsets = np.zeros(len(rows) + 1, "<u8")
    np.cumsum([len(r[2]) for r in rows], out=offsets[1:])
    head = MAGIC + dict_hash + struct.pack("<II", width, len(rows))
    return b"".join([head, ids.tobytes(), counts.tobytes(), offsets.tobytes(), *(r[2] for r in rows)])


class Block:
    """A blob's documents; frames are decompressed one by one on demand."""

    def __init__(self, blob: bytes, dictionary: bytes):
        if blob[:8] != MAGIC:
            raise ValueError("not a token-id block")
        if blob[8:24] != dictionary_hash(dictionary):
            raise ValueError("the block was written with another dictionary")
        self.width, n = struct.unpack_from("<II", blob, 24)
        at = 32
        self.doc_ids = np.frombuffer(blob, "<i8", n, at)
        self.counts = np.frombuffer(blob, "<u4", n, at + 8 * n)
        self.offsets = np.frombuffer(blob, "<u8", n + 1, at + 12 * n)
        self.base, self.blob = at + 20 * n + 8, blob
        self.reader = zstd.ZstdDecompressor(dict_data=zstd.ZstdCompressionDict(dictionary) if dictionary else None)

    def ids(self, k: int) -> np.ndarray:
        lo, hi = self.base + int(self.offsets[k]), self.base + int(self.offsets[k + 1])
        raw = self.reader.decompress(self.blob[lo:hi], max_output_size=max(1, int(self.counts[k]) * self.width))
        return np.frombuffer(raw, f"<u{self.width}").astype("<u4")


def write_token_files(encoded: DataFrame, path: str, *, width: int, level: int = 3, **training) -> None:
    """Write ``encoded`` (doc_id, ids) as the format above, in ascending order of doc_id."""
    spark = encoded.sparkSession
    dictionary = train_dictionary(encoded, **training)
    dict_hash = dictionary_hash(dictionary)
    spark.createDataFrame([(dict_hash, dictionary, width)], "dict_hash binary, dictionary binary, width int").coalesce(
        1
    ).write.parquet(f"{path}/dictionary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = zstd.ZstdCompressor(level=level, dict_data=zstd.ZstdCompressionDict(dictionary) if dictionary else None)
        part, seq, rows, held = TaskContext.get().partitionId(), 0, [], 0

        def block() -> pa.RecordBatch:
            known = [r[0] for r in rows if r[0] is not None]
            values = [part, seq, min(known, default=None), max(known, default=None), len(rows), sum(r[1] for r in rows),
                      dict_hash, _pack_block(rows, width, dict_hash)]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, kinds)],
                                              [c.split()[0] for c in _BLOCKS.split(", ")])

        for batch in batches:
            for doc_id, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
                raw = raw.as_buffer()
                rows.append((doc_id, raw.size // width, writer.compress(raw)))
                held += len(rows[-1][2])
                if held >= BLOCK_BYTES:
                    yield block()
                    seq, rows, held = seq + 1, [], 0
        if rows:
            yield block()

    ordered = encoded.withColumn("tie", F.xxhash64("ids")).repartitionByRange("doc_id", "tie")
    ordered.sortWithinPartitions("doc_id", "tie").select("doc_id", "ids").mapInArrow(run, _BLOCKS).write.option(
        "compression", "uncompressed"
    ).parquet(f"{path}/blocks")


def _dictionary(spark: SparkSession, path: str) -> bytes:
    return bytes(spark.read.parquet(f"{path}/dictionary").first().dictionary)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids_crc32, ids (32-bit little-endian)."""
    dictionary = _dictionary(spark, path)
    blocks = spark.read.parquet(f"{path}/blocks")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, seq, blob in zip(*(batch.column(i).to_pylist() for i in range(3))):
                block = Block(blob, dictionary)
                before = np.concatenate([[0], np.cumsum(block.counts, dtype="i8")])
                for lo in range(0, len(block.counts), 2048):
                    hi = min(lo + 2048, len(block.counts))
                    ids = [block.ids(k).tobytes() for k in range(lo, hi)]
                    own = block.doc_ids[lo:hi]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([part] * len(ids), pa.int32()), pa.array([seq] * len(ids), pa.int32()),
                         pa.array(own, pa.int64(), mask=own == NO_ID), pa.array(before[lo:hi], pa.int64()),
                         pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(map(zlib.crc32, ids), pa.int64()),
                         pa.array(ids, pa.binary())],
                        ["part", "seq", "doc_id", "inside", "n_tokens", "ids_crc32", "ids"],
                    )

    # Totals per part first: the one unpartitioned window sees a row per part, not per block.
    sizes = blocks.select("part", "seq", "n_ids")
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("n"))
    parts = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("part_start"))
    inside = F.sum("n_ids").over(Window.partitionBy("part").orderBy("seq")) - F.col("n_ids")
    starts = sizes.withColumn("seq_start", inside).join(parts, "part").select(
        "part", "seq", (F.col("part_start") + F.col("seq_start")).alias("block_start")
    )
    documents = blocks.select("part", "seq", "blob").mapInArrow(
        run, "part int, seq int, doc_id long, inside long, n_tokens long, ids_crc32 long, ids binary"
    )
    return documents.join(starts, ["part", "seq"]).select(
        "doc_id", (F.col("block_start") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32", "ids"
    )


def read_document(spark: SparkSession, path: str, doc_id: int) -> list[int] | None:
    """The ids of one document: block filter by range, then a single frame."""
    dictionary = _dictionary(spark, path)
    found = spark.read.parquet(f"{path}/blocks").filter(F.lit(doc_id).between(F.col("first_doc"), F.col("last_doc")))
    for row in found.select("blob").toLocalIterator():
        block = Block(bytes(row.blob), dictionary)
        at = np.flatnonzero(block.doc_ids == doc_id)
        if len(at):
            return block.ids(int(at[0])).tolist()
    return None


def token_files(
    spark: SparkSession, docs: DataFrame, *, vocabulary: str, kind: str, end_id: int, vocabulary_size: int,
    path: str | None = None, **training,
) -> DataFrame:
    """Encode, write and read back ``docs``; the files stay at ``path`` (default: the shared stage folder)."""
    width = 2 if vocabulary_size <= 1 << 16 else 4
    path = path or stage_path(spark, "token-ids")
    encoded = staged(encode_documents(docs, vocabulary=vocabulary, kind=kind, end_id=end_id, width=width), "encoded")
    write_token_files(encoded, path, width=width, **training)
    return read_token_files(spark, path)
