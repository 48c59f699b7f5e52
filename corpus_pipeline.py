"""The corpus pipeline: toxicity, line dedup, near-duplicates, decontamination, packing.

Every stage works on all that its predecessor kept and is written to the shared folder and
read again before the next one.  All but the last return the columns of ``documents``.

* ``toxicity`` drops documents that score 0.5 or more.
* ``line_dedup`` takes repeated lines out of the texts and drops documents of which nothing is left.
* ``simhash`` keeps one document of each group of near-duplicates, the one with the smallest id.
* ``decontaminate`` drops documents in which a benchmark item occurs.
* ``packing`` cuts and packs the token ids of what is left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from procura.llm import decontaminate, line_dedup, queries, simhash, toxicity
from procura.llm.common import col, free_name, staged, table

#: SQL has no conditional random fields, XXH64, edit automata or tokenizers: tested by brute force instead.
ORACLE_SQL = None


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    score, spans = free_name(docs, "toxic score"), free_name(docs, "toxic spans")
    scored = toxicity.score_documents(docs, model, names=(score, spans))
    return scored.filter(col(score) < 0.5).select(*map(col, docs.columns))


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(docs)
    left = (F.col("n_removed") == 0) | (F.col("n_lines") - F.col("n_removed") > F.col("n_blank"))
    now = {"text": F.col("text"), "n_chars": F.char_length("text").cast(docs.schema["n_chars"].dataType)}
    return out.filter(left).select(*[now.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns])


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.unique_documents(docs)


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return queries.pack_all(docs)


STAGES = [
    ("toxicity", toxicity_stage),
    ("line_dedup", line_dedup_stage),
    ("simhash", simhash_stage),
    ("decontaminate", decontaminate_stage),
    ("packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
