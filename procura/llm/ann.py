"""Approximate nearest neighbours: an NN-descent graph and greedy graph search, as Spark joins.

Index.  Equal vectors collapse to one node.  A start graph comes from hash blocks (every
node's nearest ones among about ``block`` nodes of its block, a few times over).  Then
rounds of NN-descent: by way of each node ``v``, the nodes that link to it and its own neighbours meet
its neighbours (two nodes that both merely link to ``v`` do not meet: a hub's in-links would be all pairs);
distances are taken in numpy, and only pairs that could enter one of
the two lists leave the task.  Pairs met before (both links old) are not taken again.  A node with
very many in-links is met in chunks, so no link is sampled away and no task holds more than a
chunk.  The rounds ship vectors as 16-bit whole numbers of one common scale, a quarter of the stored
doubles: links are ranked by them, answers never are.  Rounds end when few lists change; if the lists still
change after the last round, a warning says so, as it does if a beam has unopened nodes after the last step.
Every row is indexed.

Search.  A query starts from the nearest of ``entries`` nodes (the smallest hashes, a bounded list)
and, if its own vector is indexed, from there; each step opens the nearest unopened nodes of
its beam, joins their links (both ways), and keeps the best ``beam`` nodes, until a beam holds no
unopened node.  All queries advance together, one join per step.

Distances are Euclidean in double precision on the original vectors; ties go to the smaller
id.  Rules: vectors that are null, zero, of another length than most rows', or with null or
non-finite components take no part; a repeated id counts once (its smallest vector); with
fewer than ``k`` candidates all are returned; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, importable, staged

NEIGHBOURS = 20
BLOCK = 256
CHUNK = 512
ROUNDS = 12
ENTRIES = 256
BEAM = 192
OPEN = 48
STEPS = 40


def nodes(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """id, vec: the rows that take part, one per id."""
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vec"))
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = rows.filter(F.col("id").isNotNull() & F.col("vec").isNotNull() & (F.size("vec") > 0))
    rows = rows.filter(finite & F.exists("vec", lambda x: x != 0))
    rows = rows.groupBy("id").agg(F.min("vec").alias("vec"))
    size = rows.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.filter(F.size("vec") == F.lit(size.n if size else 0))


def _matrix(column: pa.Array) -> np.ndarray:
    """A list<double> column of equal lengths as a matrix."""
    flat = np.asarray(column.flatten(), np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 1)


def quantised(points: DataFrame) -> DataFrame:
    """id, vec: the vectors as 16-bit whole numbers (little-endian bytes) of one common scale."""
    largest = points.agg(F.max(F.aggregate("vec", F.lit(0.0), lambda m, x: F.greatest(m, F.abs(x))))).first()[0] or 1.0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = np.rint(_matrix(batch.column(1)) * (32767 / largest)).astype("<i2")
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([c.tobytes() for c in codes], pa.binary())], ["id", "vec"])

    return points.select("id", "vec").mapInArrow(run, "id long, vec binary")


def _codes(column: pa.Array) -> np.ndarray:
    """Quantised vectors as a matrix of floats."""
    flat = np.frombuffer(b"".join(column.to_pylist()), "<i2").astype(np.float32)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 1)


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances of all rows of a to all rows of b (by the dot product; used for ranking)."""
    square = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * (a @ b.T)
    return np.sqrt(np.maximum(square, 0))


def _keep_best(pairs: DataFrame, k: int) -> DataFrame:
    """id, links, fresh: the k nearest of the pairs (id, other, d, old) of each id, and which of them are not old."""
    pairs = pairs.groupBy("id", "other").agg(F.min("d").alias("d"), F.max("old").alias("old"))
    rank = F.row_number().over(Window.partitionBy("id").orderBy("d", "other"))
    pairs = pairs.withColumn("rank", rank).filter(F.col("rank") <= k)
    links = F.array_sort(F.collect_list(F.struct("d", F.col("other").alias("id"))))
    fresh = F.collect_list(F.when(~F.col("old"), F.col("other")))
    return pairs.groupBy("id").agg(links.alias("links"), fresh.alias("fresh"))


def _pairs_schema() -> str:
    return "id long, other long, d double"


def _pairs(ids: list[np.ndarray], others: list[np.ndarray], d: list[np.ndarray]) -> pa.RecordBatch:
    join = lambda x, kind: pa.array(np.concatenate([np.empty(0, kind), *x]))
    return pa.RecordBatch.from_arrays([join(ids, np.int64), join(others, np.int64), join(d, float)], ["id", "other", "d"])


def start_graph(points: DataFrame, k: int, block: int, times: int) -> DataFrame:
    """id, links: each node's nearest ones among the nodes of its hash blocks."""
    count = points.count()
    blocks = max(1, -(-count // block))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for members in batch.column(0):
                rows = members.values
                ids, vec = np.asarray(rows.field("id")), _codes(rows.field("vec"))
                d = distances(vec, vec)
                np.fill_diagonal(d, np.inf)
                n = min(k, len(ids) - 1)
                near = np.argpartition(d, n - 1, axis=1)[:, :n] if n > 0 else np.empty((len(ids), 0), int)
                yield _pairs([np.repeat(ids, n)], [ids[near].ravel()], [np.take_along_axis(d, near, 1).ravel().astype(float)])

    grouped = points.select("id", "vec", F.explode(F.array(*[F.lit(t) for t in range(times)])).alias("turn"))
    grouped = grouped.groupBy("turn", F.pmod(F.xxhash64("id", "turn"), F.lit(blocks)).alias("block"))
    members = grouped.agg(F.collect_list(F.struct("id", "vec")).alias("members")).select("members")
    return _keep_best(members.mapInArrow(run, _pairs_schema()).withColumn("old", F.lit(False)), k)


def _meet(k: int):
    """For one v and a chunk of the nodes that link with it: their distances to v's neighbours."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, others, ds = [], [], []
            for left, right in zip(batch.column(0), batch.column(1)):
                a, b = left.values, right.values
                d = distances(_codes(a.field("vec")), _codes(b.field("vec"))).astype(float)
                ia, ib = np.asarray(a.field("id")), np.asarray(b.field("id"))
                fresh = np.asarray(a.field("fresh")).astype(bool)[:, None] | np.asarray(b.field("fresh")).astype(bool)[None, :]
                fresh &= ia[:, None] != ib[None, :]
                for near, x, y in ((d <= np.asarray(a.field("reach"))[:, None], 0, 1), (d <= np.asarray(b.field("reach"))[None, :], 1, 0)):
                    at = np.nonzero(near & fresh)
                    pick = (ia[at[0]], ib[at[1]])
                    ids.append(pick[x])
                    others.append(pick[y])
                    ds.append(d[at])
            yield _pairs(ids, others, ds)

    return run


def descend(points: DataFrame, graph: DataFrame, k: int, chunk: int) -> DataFrame:
    """One round: id, links, fresh (ids that entered) from id, links, fresh."""
    reach = F.when(F.size("links") >= k, F.element_at("links", -1)["d"]).otherwise(F.lit(float("inf")))
    rows = graph.join(points, "id")
    rows = rows.select("id", "vec", reach.alias("reach"), "links", "fresh")
    links = rows.select("id", "vec", "reach", F.explode("links").alias("link"), "fresh")
    links = links.select(
        F.col("id").alias("u"), F.col("link.id").alias("v"), F.array_contains("fresh", F.col("link.id")).alias("fresh"),
        "vec", "reach",
    )
    # Only links that can bring a new meeting: new themselves, or to a node with new neighbours.
    lively = graph.filter(F.size("fresh") > 0).select(F.col("id").alias("v"), F.lit(True).alias("lively"))
    useful = links.join(lively, "v", "left").filter(F.col("fresh") | F.col("lively"))
    # Out-lists of the nodes in between: their own neighbours with vectors (k rows per node at most).
    between = useful.select(F.col("v").alias("u")).unionAll(lively.select(F.col("v").alias("u"))).distinct()
    ends = links.select("u", "v", "fresh").join(between, "u").join(rows.select(F.col("id").alias("v"), "vec", "reach"), "v")
    out = ends.groupBy(F.col("u").alias("v")).agg(
        F.collect_list(F.struct(F.col("v").alias("id"), "vec", "reach", "fresh")).alias("out")
    )
    # Nodes that meet them by way of v: those that link to v, in chunks, and v's neighbours themselves.
    degree = useful.groupBy("v").agg(F.ceil(F.count("*") / F.lit(chunk)).alias("chunks"))
    into = useful.join(degree, "v").groupBy("v", F.pmod(F.xxhash64("u"), F.col("chunks")).alias("chunk")).agg(
        F.collect_list(F.struct(F.col("u").alias("id"), "vec", "reach", "fresh")).alias("into")
    )
    among = out.join(lively, "v").select(F.col("out").alias("into"), "out")
    meets = into.join(out, "v").select("into", "out").unionAll(among)
    pairs = meets.mapInArrow(_meet(k), _pairs_schema())
    old = graph.select("id", F.explode("links").alias("link")).select(
        "id", F.col("link.id").alias("other"), F.col("link.d").alias("d"), F.lit(True).alias("old"))
    return _keep_best(pairs.withColumn("old", F.lit(False)).unionAll(old), k)


def build_graph(points: DataFrame, *, k: int = NEIGHBOURS, block: int = BLOCK, chunk: int = CHUNK, rounds: int = ROUNDS,
                settled: float = 0.01) -> DataFrame:
    """id, links (nearest first) of every node that has another one."""
    codes = staged(quantised(points), "codes")
    graph = staged(start_graph(codes, k, block, 3), "graph")
    for _ in range(rounds):
        before, graph = graph, staged(descend(codes, graph, k, chunk), "graph")
        discard(before)
        moved, all_links = graph.agg(F.sum(F.size("fresh")), F.sum(F.size("links"))).first()
        if not all_links or moved <= settled * all_links:
            break
    else:
        warnings.warn(f"the neighbour graph still changed after {rounds} rounds: {moved} of {all_links} links are new", stacklevel=2)
    discard(codes)
    return graph.select("id", "links")


def both_ways(graph: DataFrame) -> DataFrame:
    """id, other: links in both directions, each once."""
    links = graph.select("id", F.explode("links").alias("link")).select("id", F.col("link.id").alias("other"))
    return links.unionAll(links.select(F.col("other").alias("id"), F.col("id").alias("other"))).distinct()


def _distance(a: str, b: str) -> Column:
    square = F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x)
    return F.sqrt(square)


def _enter(points: DataFrame, entries: int):
    """Distances of queries to the entry nodes (a bounded list)."""
    names = [r.id for r in points.select("id").orderBy(F.xxhash64("id"), "id").limit(entries).collect()]
    gates = points.filter(F.col("id").isin(names)).orderBy("id").collect()
    ids, at = np.array([g.id for g in gates], np.int64), np.array([g.vec for g in gates], float)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            asked, d = np.asarray(batch.column(0)), distances(_matrix(batch.column(1)), at)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(asked, len(ids))), pa.array(np.tile(ids, len(asked))), pa.array(d.ravel())],
                ["query", "node", "d"],
            )

    return run


def search(points: DataFrame, graph: DataFrame, queries: DataFrame, *, k: int, entries: int = ENTRIES, beam: int = BEAM,
           opened: int = OPEN, steps: int = STEPS) -> DataFrame:
    """query, node, d: the beam of each query (query, vec, own: its node or null) after greedy search."""
    links = staged(both_ways(graph), "links")
    queries = staged(queries, "queries")
    start = queries.select("query", "vec").mapInArrow(_enter(points, entries), "query long, node long, d double")
    own = queries.filter("own is not null").select("query", F.col("own").alias("node"), F.lit(0.0).alias("d"))

    def best(rows: DataFrame) -> DataFrame:
        rows = rows.groupBy("query", "node").agg(F.min("d").alias("d"), F.max("done").alias("done"))
        order = Window.partitionBy("query").orderBy("d", "node")
        return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= beam).drop("rank")

    stage = state = staged(best(start.unionAll(own).withColumn("done", F.lit(False))), "beam")
    for _ in range(steps):
        rank = F.row_number().over(Window.partitionBy("query", "done").orderBy("d", "node"))
        state = state.withColumn("open", ~F.col("done") & (rank <= opened))
        front = state.filter("open").select("query", F.col("node").alias("id"))
        met = front.join(links, "id").select("query", F.col("other").alias("node")).distinct()
        met = met.join(state.select("query", "node"), ["query", "node"], "left_anti")
        met = met.join(points.select(F.col("id").alias("node"), F.col("vec").alias("at")), "node")
        met = met.join(queries.select("query", "vec"), "query").select("query", "node", _distance("vec", "at").alias("d"))
        seen = state.select("query", "node", "d", (F.col("done") | F.col("open")).alias("done"))
        before, state = stage, staged(best(seen.unionAll(met.withColumn("done", F.lit(False)))), "beam")
        stage = state
        discard(before)
        if state.filter("not done").isEmpty():
            break
    else:
        warnings.warn(f"some beams had unopened nodes after {steps} steps", stacklevel=2)
    return state.select("query", "node", "d")


def nearest(vectors: DataFrame, is_query: Column, *, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding",
            **build) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found for the rows where ``is_query`` holds on their ids."""
    importable(vectors.sparkSession)
    rows = staged(nodes(vectors, id_col, vector_col), "vectors")
    # One node per different vector, named by its smallest id; its members' k + 1 smallest ids answer for it.
    named = rows.join(rows.groupBy("vec").agg(F.min("id").alias("node")), "vec").select("id", "vec", "node")
    named = staged(named, "named")
    discard(rows)
    points = staged(named.filter("id = node").select("id", "vec"), "points")
    graph = build_graph(points, **build)
    asked = named.filter(is_query).select(F.col("id").alias("query"), "vec", F.col("node").alias("own"))
    found = search(points, graph, asked, k=k)
    member = named.select("node", F.col("id").alias("vec_id"), F.col("vec").alias("at"))
    member = member.withColumn("n", F.row_number().over(Window.partitionBy("node").orderBy("vec_id"))).filter(F.col("n") <= k + 1)
    answers = found.select("query", "node").join(member, "node").filter("vec_id <> query")
    answers = answers.join(asked.select("query", "vec"), "query").select("query", "vec_id", _distance("vec", "at").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query").orderBy("score", "vec_id"))
    return answers.withColumn("rank", rank).filter(F.col("rank") <= k).select(
        F.col("query").alias("query_id"), "rank", "vec_id", "score"
    )
