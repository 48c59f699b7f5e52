"""Column helpers for the numeric and null semantics of the extracts."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

AMOUNT = "decimal(18,6)"   # quantities, prices and amounts as stored
WIDE = "decimal(36,18)"    # outstanding quantity / amount columns
RESULT = "decimal(38,6)"   # split and tax formulas (type of the arithmetic)


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def amount(c: str | Column) -> Column:
    """Store a value as ``decimal(18,6)`` (rounds half away from zero)."""
    return col(c).cast(AMOUNT)


def stored(c: Column, kind: str, cfg=None) -> Column:
    """A computed value as its stored type; one that does not fit raises, or is NULL with the reject channel."""
    return c.try_cast(kind) if cfg is not None and cfg.on_overflow == "reject" else c.cast(kind)


def nz(c: str | Column, default=0) -> Column:
    """Two-argument null replacement typed as the first argument."""
    c = col(c)
    return F.coalesce(c, F.lit(default))


def ts_lit(value) -> Column:
    """A timestamp literal read in the session time zone (not the Python
    process's), constant-folded so comparisons still reach the scan."""
    return F.lit(value.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp")


def is_blank(c: str | Column) -> Column:
    """``ISNULL(c, '') = ''`` with trailing-blank padding semantics."""
    return F.coalesce(F.rtrim(col(c)), F.lit("")) == F.lit("")


#: Longest value list that is broadcast; a longer one is joined by a shuffle.
BROADCAST_VALUES = 100_000


def collated(c: str | Column, collation: str | None) -> Column:
    """A string column under the configured collation (binary when unset)."""
    return F.collate(col(c), collation) if collation else col(c)


def keep_in(df: DataFrame, column: str, values: Iterable, limit: int = 1000, collation: str | None = None) -> DataFrame:
    """Keep rows whose ``column`` is in ``values``.

    Short lists are inlined as ``IN (...)`` so the filter reaches the scan;
    longer ones become a left-semi join with the list, broadcast up to
    ``BROADCAST_VALUES`` values.
    """
    values = list(values)
    target = collated(column, collation)
    if len(values) <= limit:
        return df.filter(target.isin([collated(F.lit(v), collation) for v in values] if collation else values))
    spark = df.sparkSession
    ids = spark.createDataFrame([(v,) for v in values], f"__v {df.schema[column].dataType.simpleString()}")
    if len(values) <= BROADCAST_VALUES:
        ids = F.broadcast(ids)
    return df.join(ids, target == collated("__v", collation), "left_semi")


def drop_in(df: DataFrame, column: str, values: Iterable) -> DataFrame:
    """``column NOT IN (values)``; NULL is dropped as in SQL."""
    return df.filter(~F.col(column).isin(list(values)))
