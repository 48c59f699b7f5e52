"""Connected components of a link table by contraction, in Spark joins.

Each round every vertex joins its smallest neighbour in an order that is hashed anew per
round (so chains shrink by a constant factor), and links are rewritten to the joined
vertices until none is left.  Minima are grouped aggregations (combined before the shuffle);
rewriting joins a link table that may have a hot vertex with a stored table of unique
vertices, which adaptive execution can split.  Every round is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, root (one of its component's nodes) for every node with a link to another node."""
    links = links.select(F.col(a).alias("a"), F.col(b).alias("b")).filter("a <> b")
    links = staged(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    out, turn = None, 0
    while not links.isEmpty():
        order = lambda c: F.struct(F.xxhash64(F.col(c), F.lit(turn)), F.col(c).alias("v"))  # noqa: E731, B023
        ends = links.select("a", "b").unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = ends.groupBy("a").agg(F.min(order("b")).alias("least"))
        joined = staged(
            least.select(F.col("a").alias("v"), F.least(order("a"), F.col("least"))["v"].alias("to")), "joined"
        )
        if out is None:
            out = joined.select(F.col("v").alias("node"), F.col("to").alias("root"))
        else:
            out = staged(
                out.join(joined.withColumnRenamed("v", "root"), "root", "left").select(
                    "node", F.coalesce("to", "root").alias("root")
                ),
                "roots",
            )
        links = links.join(joined.select(F.col("v").alias("a"), F.col("to").alias("x")), "a").join(
            joined.select(F.col("v").alias("b"), F.col("to").alias("y")), "b"
        )
        links = links.filter("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
        links = staged(links.distinct(), "links")
        turn += 1
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")) if out is None else out
