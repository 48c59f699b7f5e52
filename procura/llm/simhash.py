"""SimHash near-duplicates: tiled exact comparison of fingerprints.

A document's words are lower-cased (A-Z) and cut at ASCII white space; every shingle of
``words`` words is hashed (XXH64, seed 42) and a fingerprint bit is 1 if set in more than half of
the hashes.  Distinct fingerprints are sorted into tiles by the population counts of their four
16-bit lanes.  Tile pairs whose counts differ by more than ``radius`` in sum hold no
link and are never formed; all others are compared exactly, exclusive-or and bit counts in
numpy.  A tile pair reports its links as a forest (each linked fingerprint to one representative), so
a large group costs no more rows than its members; no link between groups is lost.

Rules: a document without words (null text too) has fingerprint zero and is linked like any
other; with fewer words than a shingle the whole sequence is the one shingle; repeated rows and ids
keep their rows; ``component_id`` is the smallest document id reachable (null only where all
ids are null); extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import col, pick, shuffled, staged
from .components import components

SEED = 42
LANES, LANE_BITS = 4, 16
TILE = 2048
_BITS = np.uint64(1) << np.arange(64, dtype=np.uint64)


def _hash(shingle: bytes) -> int:
    return xxhash.xxh64_intdigest(shingle, SEED)


def fingerprint(text: str | None, words: int = 3) -> int:
    """The unsigned 64-bit fingerprint of a whole text."""
    found = text.encode("utf-8").lower().split() if text else []
    if not found:
        return 0
    shingles = zip(*(found[i:] for i in range(words))) if len(found) >= words else [tuple(found)]
    hashes = np.fromiter(map(_hash, map(b" ".join, shingles)), np.uint64)
    ones = np.zeros(64, np.int64)
    for lo in range(0, len(hashes), 1 << 15):
        part = hashes[lo : lo + (1 << 15)].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(_BITS[2 * ones > len(hashes)].sum(dtype=np.uint64))


def fingerprints(docs: DataFrame, *, words: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, tie (hash of the text), row (unique), fp (the fingerprint as a signed long) for every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 36
        for batch in batches:
            fp = np.array([fingerprint(t.as_py(), words) for t in batch.column(1)], np.uint64).view(np.int64)
            rows = np.arange(row, row + len(fp))
            row += len(fp)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(rows, pa.int64()), pa.array(fp, pa.int64())],
                ["doc_id", "tie", "row", "fp"],
            )

    source = pick(docs, doc_id=id_col, text=text_col).select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("tie"))
    return source.mapInArrow(run, "doc_id long, tie long, row long, fp long")


def lane_offsets(radius: int) -> list[tuple[int, ...]]:
    """Differences of lane counts that a link can have, one of each pair of opposite ones."""
    steps = itertools.product(range(-radius, radius + 1), repeat=LANES)
    return [s for s in steps if sum(map(abs, s)) <= radius and s >= (0,) * LANES]


def linked(left: np.ndarray, right: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of all pairs within the radius."""
    a, b = [], []
    for lo in range(0, len(left), 256):
        near = np.bitwise_count(left[lo : lo + 256, None] ^ right[None, :]) <= radius
        x, y = np.nonzero(near)
        a.append(x + lo)
        b.append(y)
    return np.concatenate(a), np.concatenate(b)


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (values a, b) -> each value and the least value that it is connected with."""
    values, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    label = np.arange(len(values))
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, x, low)
        np.minimum.at(new, y, low)
        new = new[new]
        if (new == label).all():
            return values, values[label]
        label = new


def _compare(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
            for left, right in zip(batch.column(0), batch.column(1)):
                left, right = (np.asarray(v.values).astype(np.int64, copy=False) for v in (left, right))
                x, y = linked(left.view(np.uint64), right.view(np.uint64), radius)
                x, y = left[x], right[y]
                other = x != y
                if other.any():
                    value, root = forest(x[other], y[other])
                    own = value != root
                    a.append(value[own])
                    b.append(root[own])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], ["a", "b"])

    return run


def links(fps: DataFrame, radius: int = 3, tile: int = TILE) -> DataFrame:
    """a, b: links between different fingerprints (column fp) that connect all that lie within the radius."""
    lane = lambda i: F.bit_count(F.shiftrightunsigned("fp", LANE_BITS * i).bitwiseAND(F.lit(2**LANE_BITS - 1)))
    key = F.array(*[lane(i).cast("int") for i in range(LANES)])
    distinct = fps.select("fp").distinct().withColumn("lanes", key)
    # At most 17^4 lane counts exist, so this table is small whatever the input.
    sizes = distinct.groupBy("lanes").agg(F.ceil(F.count("*") / F.lit(tile)).alias("chunks"))
    tiles = (
        distinct.join(F.broadcast(sizes), "lanes")
        .withColumn("chunk", F.pmod(F.xxhash64("fp"), F.col("chunks")))
        .groupBy("lanes", "chunk").agg(F.collect_list("fp").alias("fps"))
    )
    tiles = staged(tiles, "tiles")
    near = F.array(*[F.array(*[F.lit(x) for x in s]) for s in lane_offsets(radius)])
    left = tiles.select(F.col("lanes").alias("own"), F.col("chunk").alias("own_chunk"), F.col("fps").alias("left"),
                        F.explode(near).alias("step"))
    left = left.withColumn("lanes", F.zip_with("own", "step", lambda a, b: a + b))
    keys = tiles.select("lanes").distinct()  # bounded like sizes
    pairs = left.join(F.broadcast(keys), "lanes", "left_semi").join(tiles, "lanes").filter(
        (F.col("own") != F.col("lanes")) | (F.col("own_chunk") <= F.col("chunk"))
    )
    return pairs.select("left", F.col("fps").alias("right")).mapInArrow(_compare(radius), "a long, b long")


def near_duplicates(docs: DataFrame, *, words: int = 3, radius: int = 3, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """doc_id, tie, row, fp, component_id and keeper (the row of the component that stays) for every row."""
    fps = staged(fingerprints(docs, words=words, id_col=id_col, text_col=text_col), "fingerprints")
    roots = components(links(fps, radius))
    # Per fingerprint first: copies (a hot fingerprint) are combined before any join.
    firsts = fps.groupBy("fp").agg(F.min("doc_id").alias("doc"), F.min(F.struct("doc_id", "row")).alias("first"))
    firsts = firsts.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    firsts = staged(firsts, "firsts")
    least = staged(
        firsts.groupBy("root").agg(F.min("doc").alias("component_id"), F.min("first")["row"].alias("keeper")), "least"
    )
    classes = staged(firsts.join(shuffled(least), "root").select("fp", "component_id", "keeper"), "classes")
    return fps.join(shuffled(classes), "fp").select("doc_id", "tie", "row", "fp", "component_id", "keeper")


def unique_documents(docs: DataFrame, *, words: int = 3, radius: int = 3, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """One row of ``docs``, as it is, of each component: that with the smallest id (of equal rows any)."""
    found = near_duplicates(docs, words=words, radius=radius, id_col=id_col, text_col=text_col)
    keepers = staged(found.filter("row = keeper").select(F.col("doc_id").alias("id"), "tie"), "keepers")
    rows = docs.select(col(id_col).cast("long").alias("id"), F.xxhash64(col(text_col)).alias("tie"),
                       F.struct(*map(col, docs.columns)).alias("row"))
    # Sorted by the join already, so the drop streams; it only meets repeated rows.
    same = rows["id"].eqNullSafe(keepers["id"]) & (rows["tie"] == keepers["tie"])
    joined = rows.join(shuffled(keepers), same).select(rows["*"])
    return joined.dropDuplicates(["id", "tie"]).select("row.*")
