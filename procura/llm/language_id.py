"""Language identification by Bayesian evidence fusion.

Four kinds of evidence about a text are combined as log probabilities per language:

* the text: hashed character trigrams, counted per language over all training documents in
  Spark; the log likelihood is tempered, since neighbouring trigrams overlap;
* the language that the markup declares, and the suffix of the address: how often each value goes with a
  language, from the texts' own posteriors, summed by grouped aggregation over all rows;
* the host: its posterior sums, smoothed towards those of its domain, which are smoothed towards
  all rows' (a row's own share is taken out, so it is no evidence for itself).

Rules: an empty or null text has no text evidence and is told by the rest; documents
without markup or address have neither kind and their source stands for the host; trainings rows
without a language are left out; without any training row every language is null; repeated
rows are rows like any other; ties go to the first language by name; whole texts are read.
More than ``MAX_LANGUAGES`` languages raise (their table would be broadcast).
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import col, importable, staged
from .html_extract import host_of, main_text

BUCKET_BITS = 16
#: Share of a trigram's log likelihood that counts as independent.
TEMPER = 1 / 3
#: Pseudo-rows of the smoothing towards domain and corpus, and of declared language and suffix.
SMOOTH_HOST, SMOOTH_VALUE = 5.0, 2.0
MAX_LANGUAGES = 256
FOLDS = 5

_LANG = re.compile(r"<html\b[^>]*?\slang\s*=\s*[\"']?([a-zA-Z]{2,3})", re.I)


def buckets(text: str | None) -> np.ndarray:
    """The hashed trigrams of a whole text (lower case, white space as one space, padded)."""
    words = text.lower().split() if text else []
    if not words:
        return np.empty(0, np.int64)
    points = np.frombuffer(f" {' '.join(words)} ".encode("utf-32-le", "replace"), "<u4").astype(np.uint64)
    mixed = points[:-2] * np.uint64(0x9E3779B1) + points[1:-1] * np.uint64(0x85EBCA77) + points[2:] * np.uint64(0xC2B2AE3D)
    mixed ^= mixed >> np.uint64(15)
    mixed *= np.uint64(0x2C1B3C6D)
    return ((mixed >> np.uint64(12)) & np.uint64((1 << BUCKET_BITS) - 1)).astype(np.int64)


def train(docs: DataFrame, *, held_out: bool = False, id_col: str = "doc_id", text_col: str = "text",
          lang_col: str = "lang") -> tuple[list[str], np.ndarray]:
    """Languages (by name) and log P(bucket | language), from all labelled rows; with ``held_out`` those outside fold 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            for text, lang in zip(batch.column(0), batch.column(1).to_pylist()):
                own = totals.setdefault(lang, np.zeros(1 << BUCKET_BITS, np.int64))
                own += np.bincount(buckets(text.as_py()), minlength=1 << BUCKET_BITS)
        for lang, counts in totals.items():
            at = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(counts[at], pa.int64())],
                ["lang", "bucket", "n"],
            )

    importable(docs.sparkSession)
    rows = docs.select(col(id_col).alias("doc_id"), col(text_col).alias("text"), col(lang_col).alias("lang"))
    rows = rows.filter("lang is not null")
    if held_out:
        rows = rows.filter(F.coalesce(F.crc32(F.col("doc_id").cast("string")) % FOLDS, F.lit(1)) != 0)
    counts = rows.select("text", "lang").mapInArrow(run, "lang string, bucket int, n long")
    counts = staged(counts.groupBy("lang", "bucket").agg(F.sum("n").alias("n")), "trigrams")
    langs = sorted(r.lang for r in counts.select("lang").distinct().limit(MAX_LANGUAGES + 1).collect())
    if len(langs) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    table = np.full((len(langs), 1 << BUCKET_BITS), 0.5)
    # At most languages x buckets rows, whatever the number of documents.
    found = counts.toPandas()
    if len(found):
        table[found["lang"].map(langs.index).to_numpy(), found["bucket"].to_numpy()] += found["n"].to_numpy()
    return langs, np.log(table / table.sum(axis=1, keepdims=True)).astype(np.float32)


def text_evidence(rows: DataFrame, langs: list[str], table: np.ndarray, read) -> DataFrame:
    """``rows`` (key columns, then text) with ``logp``: normalised log likelihoods; ``read`` turns a batch into texts."""
    shared = rows.sparkSession.sparkContext.broadcast(table)  # languages x buckets
    keys = [f for f in rows.schema.fields if f.name != "text"]
    names = [f.name for f in keys]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = np.ascontiguousarray(shared.value.T)
        for batch in batches:
            texts, declared = read(batch.column("text").to_pylist())
            out = np.zeros((len(texts), len(langs)))
            for k, text in enumerate(texts):
                at = buckets(text)
                for lo in range(0, len(at), 1 << 16):
                    out[k] += weights[at[lo : lo + (1 << 16)]].sum(axis=0, dtype=float)
            out *= TEMPER
            if len(langs):
                out -= out.max(axis=1, keepdims=True)
                out -= np.log(np.exp(out).sum(axis=1, keepdims=True))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in names), pa.array(declared, pa.string()), pa.array(list(out), pa.list_(pa.float64()))],
                [*names, "declared", "logp"],
            )

    schema = ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in keys), "declared string", "logp array<double>"])
    return rows.mapInArrow(run, schema)


def read_plain(texts: list[str | None]) -> tuple[list[str | None], list[str]]:
    return texts, [""] * len(texts)


def read_pages(pages: list[str | None]) -> tuple[list[str | None], list[str]]:
    """Main text and declared language of each page."""
    declared = [_LANG.search(p) if p else None for p in pages]
    return [main_text(p) for p in pages], [m.group(1).lower() if m else "" for m in declared]


def fuse(rows: DataFrame, langs: list[str]) -> DataFrame:
    """``rows`` (with host, domain, suffix, declared, logp) plus ``posterior``, an array over the languages."""
    many = range(len(langs))
    p = [F.exp(F.col("logp")[i]) for i in many]
    sums = [F.sum(p[i]).alias(f"s{i}") for i in many]
    kinds = ["host", "domain", "suffix", "declared"]
    seen = staged(rows.groupBy(*kinds).agg(F.count("*").alias("n"), *sums), "evidence")

    def totals(by: str, name: str) -> DataFrame:
        return seen.groupBy(by).agg(F.sum("n").alias(f"{name}_n"), *[F.sum(f"s{i}").alias(f"{name}{i}") for i in many])

    every = seen.agg(F.sum("n"), *[F.sum(f"s{i}") for i in many]).first()
    n_all, all_ = float(every[0] or 0), [float(x or 0) for x in every[1:]]
    known = seen.select(*kinds)
    for by, name in (("host", "h"), ("domain", "g"), ("suffix", "x"), ("declared", "d")):
        known = known.join(totals(by, name), by)
    known = staged(known, "totals")
    joined = rows.join(known, kinds)

    def score(i: int) -> Column:
        own = p[i]
        broad = F.lit((all_[i] + 1) / (n_all + len(langs)))
        domain = (F.col(f"g{i}") - own + SMOOTH_HOST * broad) / (F.col("g_n") - 1 + SMOOTH_HOST)
        host = (F.col(f"h{i}") - own + SMOOTH_HOST * domain) / (F.col("h_n") - 1 + SMOOTH_HOST)

        def value(name: str) -> Column:  # P(value | language), smoothed towards the value's share of all rows
            base = F.col(f"{name}_n") / F.lit(max(n_all, 1.0))
            return (F.col(f"{name}{i}") - own + SMOOTH_VALUE * base) / (F.lit(all_[i]) - own + SMOOTH_VALUE)

        floor = lambda c: F.log(F.greatest(c, F.lit(1e-9)))
        return floor(host) + F.col("logp")[i] + floor(value("x")) + floor(value("d"))

    scores = joined.withColumn("scores", F.array(*[score(i) for i in many]))
    scores = scores.withColumn("best", F.array_max("scores"))
    mass = F.transform("scores", lambda x: F.exp(x - F.col("best")))
    scores = scores.withColumn("mass", mass).withColumn("total", F.aggregate("mass", F.lit(0.0), lambda a, x: a + x))
    return scores.select(*rows.columns, F.transform("mass", lambda x: x / F.col("total")).alias("posterior"))


def identify(docs: DataFrame, pages: DataFrame) -> DataFrame:
    """kind, doc_id, page_id, language, confidence, text_language, declared for every document and page."""
    langs, table = train(docs)
    none = F.lit(None).cast("long")
    plain = docs.select(F.lit("document").alias("kind"), F.col("doc_id").cast("long"), none.alias("page_id"),
                        F.coalesce("source", F.lit("")).alias("host"), F.coalesce("source", F.lit("")).alias("domain"),
                        F.lit("").alias("suffix"), "text")
    host = host_of("url")
    labels = F.split(host, r"\.")
    web = pages.select(F.lit("page").alias("kind"), none.alias("doc_id"), F.col("page_id").cast("long"), host.alias("host"),
                       F.array_join(F.slice(labels, F.greatest(F.lit(1), F.size(labels) - 1), 2), ".").alias("domain"),
                       F.element_at(labels, -1).alias("suffix"), F.col("html").alias("text"))
    rows = text_evidence(plain, langs, table, read_plain).unionAll(text_evidence(web, langs, table, read_pages))
    rows = staged(rows, "text-evidence")
    out = ["kind", "doc_id", "page_id"]
    if not langs:
        nothing = [F.lit(None).cast(t).alias(c) for c, t in (("language", "string"), ("confidence", "double"), ("text_language", "string"))]
        return rows.select(*out, *nothing, "declared")
    names = F.array(*[F.lit(x) for x in langs])
    best = lambda c: F.element_at(names, F.array_position(c, F.array_max(c)).cast("int"))
    return fuse(rows, langs).select(
        *out, best(F.col("posterior")).alias("language"), F.array_max("posterior").alias("confidence"),
        best(F.col("logp")).alias("text_language"), "declared",
    )
