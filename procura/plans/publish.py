"""Publish an extract as a whole or not at all.

A version is written aside (``versions/<id>/data``), read back once for its manifest (one row per part file: first and
last order number, rows, checksum of the rows) and compared with what was counted while it was written.  Only then the
small file ``CURRENT`` is replaced by a rename.  Readers follow ``CURRENT``, so a run that breaks before the switch leaves the
version before it as it was.  Older versions stay until ``retire``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..config import ExtractConfig
from ..sources.tables import Tables
from .extracts import TAX_HEADERS, extract_pipeline, write_extract

CURRENT = "CURRENT"
ORDER_HEADER = TAX_HEADERS["order_number"]


def _checksum(columns: list[str]):
    """Sum of row hashes: independent of the order of rows, and doubled rows count."""
    quoted = [F.col("`" + c.replace("`", "``") + "`") for c in columns]
    return F.sum(F.xxhash64(*quoted).cast("decimal(38,0)"))


def manifest_of(data: DataFrame) -> DataFrame:
    """One row per part file of a written extract."""
    number = F.col(f"`{ORDER_HEADER}`")
    part = F.element_at(F.split(F.input_file_name(), "/"), -1)
    columns = data.columns
    return data.withColumn("__part", part).groupBy(F.col("__part").alias("part")).agg(
        F.min(number).alias("first_order"), F.max(number).alias("last_order"), F.count(F.lit(1)).alias("rows"),
        _checksum(columns).alias("checksum"),
    )


def _files(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path
    return jvm, conf, p, p(path).getFileSystem(conf)


def _switch(spark: SparkSession, path: str, version: str) -> None:
    """Replace ``CURRENT`` by a rename of a file that is complete."""
    jvm, conf, p, fs = _files(spark, path)
    aside = p(f"{path}/{CURRENT}-{version}")
    out = fs.create(aside, True)
    out.write(bytearray(version.encode()))
    out.close()
    over = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    array = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    array[0] = over
    target = fs.makeQualified(p(f"{path}/{CURRENT}"))
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), conf).rename(fs.makeQualified(aside), target, array)


def current_version(spark: SparkSession, path: str) -> str | None:
    """The published version, None before the first one."""
    _, _, p, fs = _files(spark, path)
    if not fs.exists(p(f"{path}/{CURRENT}")):
        return None
    return spark.read.text(f"{path}/{CURRENT}").first()[0].strip()


def published(spark: SparkSession, path: str, version: str | None = None) -> DataFrame:
    """The rows of a version, the published one by default."""
    version = version or current_version(spark, path)
    if version is None:
        raise FileNotFoundError(f"nothing is published in {path}")
    return spark.read.parquet(f"{path}/versions/{version}/data")


def differing_parts(spark: SparkSession, path: str, version: str | None = None) -> DataFrame:
    """Part files that are not as their manifest says (none for an intact version)."""
    version = version or current_version(spark, path)
    now = manifest_of(published(spark, path, version))
    then = spark.read.parquet(f"{path}/versions/{version}/manifest")
    return now.exceptAll(then).unionByName(then.exceptAll(now)).select("part").distinct()


def publish(df: DataFrame, path: str, kind: str) -> str:
    """Write an extract as a new version and switch to it; the version's id."""
    spark = df.sparkSession
    version = uuid.uuid4().hex[:12]
    home = f"{path}/versions/{version}"
    written = Observation(f"publish-{version}")
    write_extract(df, f"{home}/data", kind, mode="error", counted=written)
    manifest_of(spark.read.parquet(f"{home}/data")).coalesce(1).write.parquet(f"{home}/manifest")
    rows = spark.read.parquet(f"{home}/manifest").agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
    if rows != written.get["rows"]:
        raise RuntimeError(f"{home}: {rows} rows read back of {written.get['rows']} written")
    _switch(spark, path, version)
    return version


def publish_extract(tables: Tables, cfg: ExtractConfig, path: str, kind: str) -> str:
    """Compute an extract, publish it and remove its stage tables."""
    with extract_pipeline(tables, cfg, kind) as p:
        return publish(p.tax_extract if kind == "tax" else p.accounting_extract, path, kind)


def retire(spark: SparkSession, path: str, keep: tuple[str, ...] = ()) -> None:
    """Delete every version but the published one and those in ``keep``."""
    _, _, p, fs = _files(spark, path)
    stay = {current_version(spark, path), *keep}
    for status in fs.listStatus(p(f"{path}/versions")):
        if status.getPath().getName() not in stay:
            fs.delete(status.getPath(), True)
