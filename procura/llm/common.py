"""Helpers shared by the training-data operators: tables, stage files, text units."""

from __future__ import annotations

import gc
import os
import uuid
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


ROOT = str(Path(__file__).resolve().parents[2])


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it.

    A cluster installs the package or ships it with ``--py-files``; the path then adds nothing.
    """
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if ROOT not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([*paths, ROOT])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table (a parquet file or folder) of ``sf_dir``."""
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the cluster's shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    importable(spark)
    path = stage_path(spark, name)
    df.write.option("compression", codec).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stage_path = path
    return out


def discard(*stages: DataFrame) -> None:
    """Delete stage tables that no later plan reads, and let the driver drop the shuffle files behind them.

    Spark removes shuffle files once the driver's collector finds their plans unused, which a long loop of small
    jobs would not bring about for hours.
    """
    if stages:
        gc.collect()
        stages[0].sparkSession.sparkContext._jvm.System.gc()
    for df in stages:
        context = df.sparkSession.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(df.stage_path)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def col(name: str) -> Column:
    """A column by its exact name, dots and back-ticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def free_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def positional(df: DataFrame) -> DataFrame:
    """``df`` with plain names, in place of any that Spark's own Python functions cannot quote."""
    return df.select(*[col(c).alias(f"c{i}") for i, c in enumerate(df.columns)])


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """Project exactly the named input columns; extra columns (whatever their names) do not matter."""
    importable(df.sparkSession)
    return df.select(*[col(source).alias(name) for name, source in columns.items()])


def table_bytes(df: DataFrame) -> int:
    """Size of a frame as Catalyst estimates it (file sizes for a stage table)."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def shuffled(df: DataFrame) -> DataFrame:
    """``df`` as a side of a join that is never broadcast, whatever Spark takes the two sides for.

    Rows made by an explode count as one, and compressed files as what they unpack to; a broadcast planned on such a
    size stays in the plan once the rows are there, and the driver must hold them.
    """
    return df.hint("merge")


_HELD: dict[tuple, object] = {}


def held(key: tuple, make):
    """What ``make`` gives, kept by the Python worker until an operator asks for something else.

    One such object at a time: a worker that runs several operators never holds the memories of two.
    """
    if key not in _HELD:
        _HELD.clear()
        _HELD[key] = make()
    return _HELD[key]


def tokenizer(path: str):
    """The tokenizer of a file."""
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def tokenizer_path(name: str) -> str:
    """Where the public vocabulary file of that name lies on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)
