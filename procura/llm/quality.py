"""Document quality by a regularised quadratic discriminant over statistics of whole texts.

Every text is counted once (characters by kind, words, different words, the commonest word, compressed size) into a
stage table.  Shares are smoothed towards those of the whole corpus, so that a short text says little, and made
symmetric: arcsines of square roots for shares, logarithms for sizes.  Each class has its mean and a covariance that is
shrunk towards the pooled variances (``shrink``, ``floor``), from sums over *all* labelled rows outside fold 0: moments
are gathered by task and merged in Spark, no row is sampled.  A score is the logistic of the difference of the two
Mahalanobis log densities (with the classes' shares as priors), from Cholesky factors that are computed once and sent
with the task.

Rules: the text alone enters a score; null text is empty; empty texts have the corpus's own shares; repeated rows score
alike, and each row of a labelled id is learned from; null labels are left out, an id that is labelled more than once is
good only if every label says so; a null id is held in; with labels of one class only every score is that class, without
any it is 0.5; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import pick, staged

FOLDS = 5
SHRINK = 0.1
FLOOR = 0.02
#: Words (and six times as many characters) of the corpus that stand beside every text.
PRIOR_WORDS = 20

COUNTS = ("size", "upper", "lower", "digits", "breaks", "spaces", "ends", "marks", "symbols", "words", "different",
          "commonest", "packed")


def _kinds() -> bytes:
    """The kind of every byte of a text in UTF-8: a letter of ``Uldnsepy``."""

    def kind(b: int) -> str:
        c = chr(b)
        if b >= 0x80 or c.islower():
            return "l"
        if c.isupper():
            return "U"
        if c.isdigit():
            return "d"
        if c in "\r\n":
            return "n"
        if c.isspace():
            return "s"
        return "e" if c in ".!?" else "p" if c in ",;:'\"()-" else "y"

    return "".join(map(kind, range(256))).encode()


_KINDS = _kinds()


def counts_of(text: str) -> list[int]:
    """The numbers of ``COUNTS`` for one text."""
    raw = text.encode("utf-8")
    kinds, words = raw.translate(_KINDS), Counter(text.split())
    return [len(raw), *(kinds.count(k) for k in (b"U", b"l", b"d", b"n", b"s", b"e", b"p", b"y")), words.total(),
            len(words), max(words.values(), default=0), len(zlib.compress(raw, 1))]


def statistics(counts: np.ndarray, total: np.ndarray) -> np.ndarray:
    """Transformed statistics, a row for each row of counts; ``total``: the counts of the whole corpus."""
    c = dict(zip(COUNTS, np.asarray(counts, float).T))
    t = dict(zip(COUNTS, np.maximum(np.asarray(total, float), 1e-9)))
    w, many = PRIOR_WORDS, 6 * PRIOR_WORDS

    def share(part: str, whole: str, weight: float) -> np.ndarray:
        p = (c[part] + weight * min(1.0, t[part] / t[whole])) / (c[whole] + weight)
        return np.arcsin(np.sqrt(np.clip(p, 0, 1)))

    letters, all_letters = c["upper"] + c["lower"], t["upper"] + t["lower"]
    c["letters"], t["letters"] = letters, all_letters
    inked = (t["size"] - t["spaces"] - t["breaks"]) / t["words"]
    return np.column_stack([
        share("symbols", "size", many), share("upper", "letters", many), share("digits", "size", many),
        share("breaks", "words", w), share("ends", "words", w), share("marks", "words", w),
        share("commonest", "words", w),
        np.log((c["size"] - c["spaces"] - c["breaks"] + w * max(inked, 0.1)) / (c["words"] + w)),
        np.log(c["different"] + w) / np.log(c["words"] + w + 1),
        np.log((c["packed"] + many) / (c["size"] + 10 * w)),
    ])


WIDTH = statistics(np.zeros((1, len(COUNTS))), np.ones(len(COUNTS))).shape[1]


@dataclass
class Model:
    """Class means, inverse Cholesky factors and log constants; ``constant``: the score where classes are missing."""

    total: np.ndarray
    constant: float | None = None
    mean: list[np.ndarray] = field(default_factory=list)
    inverse: list[np.ndarray] = field(default_factory=list)
    offset: list[float] = field(default_factory=list)

    def add(self, mean: np.ndarray, covariance: np.ndarray, prior: float) -> None:
        factor = np.linalg.cholesky(covariance)
        self.mean.append(mean)
        self.inverse.append(np.linalg.inv(factor))
        self.offset.append(float(np.log(prior) - np.log(np.diag(factor)).sum()))

    def density(self, x: np.ndarray, k: int) -> np.ndarray:
        u = (x - self.mean[k]) @ self.inverse[k].T
        return self.offset[k] - (u * u).sum(1) / 2

    def scores(self, counts: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(counts), self.constant)
        x = statistics(counts, self.total)
        return 1 / (1 + np.exp(-np.clip(self.density(x, 1) - self.density(x, 0), -700, 700)))


def regularised(covariance: np.ndarray, pooled: np.ndarray, shrink: float, floor: float) -> np.ndarray:
    """A class covariance drawn towards its own diagonal, no variance below a share of the pooled one."""
    variance = np.diag(covariance)
    out = (1 - shrink) * covariance + shrink * np.diag(variance)
    return out + np.diag(floor * np.diag(pooled) + 1e-6)


# --- Spark -----------------------------------------------------------------------------------


def text_counts(texts: DataFrame) -> DataFrame:
    """doc_id and the counts of every whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                rows = [counts_of(t or "") for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *(pa.array(list(x), pa.int64()) for x in zip(*rows))], ["doc_id", *COUNTS]
                )

    return texts.mapInArrow(run, "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS))


def _numbers(batch: pa.RecordBatch) -> np.ndarray:
    return np.column_stack([batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in COUNTS])


def class_moments(rows: DataFrame, total: np.ndarray) -> dict[int, tuple[int, np.ndarray, np.ndarray]]:
    """n, mean and covariance of the statistics of each class (column ``good``), over all rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = {k: (0, np.zeros(WIDTH), np.zeros((WIDTH, WIDTH))) for k in (0, 1)}
        for batch in batches:
            x, good = statistics(_numbers(batch), total), batch.column(batch.schema.get_field_index("good")).to_numpy()
            for k in (0, 1):
                own = x[good == k]
                if len(own):
                    n, mean, spread = held[k]
                    centre = own.mean(0)
                    off, both = centre - mean, n + len(own)
                    spread = spread + (own - centre).T @ (own - centre) + np.outer(off, off) * (n * len(own) / both)
                    held[k] = (both, mean + off * (len(own) / both), spread)
        i, j = np.triu_indices(WIDTH)
        for k, (n, mean, spread) in held.items():
            if n:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k] * len(i), pa.int32()), pa.array(i, pa.int32()), pa.array(j, pa.int32()),
                     pa.array([n] * len(i), pa.int64()), pa.array(spread[i, j]), pa.array(mean[i]), pa.array(mean[j])],
                    ["good", "i", "j", "n", "spread", "mi", "mj"],
                )

    parts = rows.mapInArrow(run, "good int, i int, j int, n long, spread double, mi double, mj double")
    n = F.sum("n")
    si, sj = F.sum(F.col("n") * F.col("mi")), F.sum(F.col("n") * F.col("mj"))
    product = F.sum(F.col("n") * F.col("mi") * F.col("mj"))
    merged = parts.groupBy("good", "i", "j").agg(
        n.alias("n"), (si / n).alias("mean"), ((F.sum("spread") + product - si * sj / n) / n).alias("covariance")
    )
    out: dict[int, tuple[int, np.ndarray, np.ndarray]] = {}
    for r in merged.collect():  # a row for each class and pair of statistics
        _, mean, covariance = out.setdefault(r.good, (r.n, np.zeros(WIDTH), np.zeros((WIDTH, WIDTH))))
        covariance[r.i, r.j] = covariance[r.j, r.i] = r.covariance
        if r.i == r.j:
            mean[r.i] = r.mean
    return out


def fit(counts: DataFrame, labels: DataFrame, fold: Column, *, shrink: float = SHRINK, floor: float = FLOOR,
        id_col: str = "doc_id", label_col: str = "quality") -> Model:
    """The two class densities from all labelled rows for which ``fold`` (of ``doc_id``) is not 0."""
    total = counts.agg(*[F.sum(c).alias(c) for c in COUNTS]).first()
    total = np.array([float(x or 0) for x in total])
    known = pick(labels, doc_id=id_col, good=label_col).filter("doc_id is not null and good is not null")
    known = known.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("good").cast("int").alias("good"))
    known = known.groupBy("doc_id").agg(F.min("good").alias("good")).filter(fold != 0)
    found = class_moments(counts.join(known, "doc_id").select("good", *COUNTS), total)
    rows = {k: v[0] for k, v in found.items()}
    if len(rows) < 2:
        return Model(total, constant=float(next(iter(rows), 0.5)))
    n = sum(rows.values())
    pooled = sum(rows[k] * found[k][2] for k in (0, 1)) / n
    model = Model(total)
    for k in (0, 1):
        model.add(found[k][1], regularised(found[k][2], pooled, shrink, floor), rows[k] / n)
    return model


def score_counts(counts: DataFrame, model: Model) -> DataFrame:
    """doc_id, score of every row of counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.scores(_numbers(batch)))], ["doc_id", "score"])

    return counts.mapInArrow(run, "doc_id long, score double")


def quality(docs: DataFrame, labels: DataFrame, *, threshold: float = 0.3, id_col: str = "doc_id", text_col: str = "text",
            **training) -> DataFrame:
    """doc_id, held_out, score, predicted for every row."""
    texts = pick(docs, doc_id=id_col, text=text_col).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    counts = staged(text_counts(texts), "counts")
    fold = F.crc32(F.col("doc_id").cast("string")) % FOLDS
    return score_counts(counts, fit(counts, labels, fold, id_col=id_col, **training)).select(
        "doc_id", F.coalesce(fold == 0, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
