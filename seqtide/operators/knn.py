"""Exact nearest neighbours of many queries at once.

A Voronoi join at every size: base vectors belong to the cell of their nearest pivot; a
query first searches the cells around it, which bounds its k-th distance, then only the
cells that bound cannot rule out. Exact for any data; how much is ruled out depends on
how clustered it is. For very large tables use ``ivf.search`` instead.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seqtide.functions.vectors import doubles, finite, matrix, norm, normalise, vector_key
from seqtide.operators.blocks import Cosine, Euclidean, Scorer, blocked_topk, nearest_found
from seqtide.operators.skew import salted_join
from seqtide.session import materialise

SLACK = 1e-9


def prepared(rows: DataFrame, key: str, vector: str, metric: str) -> DataFrame:
    """id, payload, digest of the vectors that have a distance: finite, and for cosine
    of non-zero length. Cosine payloads are unit vectors."""
    ok = F.col(vector).isNotNull() & finite(vector)
    payload = doubles(vector)
    if metric == "cosine":
        ok, payload = ok & (norm(doubles(vector)) > 0), normalise(vector)
    return (rows.where(ok).select(F.col(key).alias("id"), payload.alias("payload"))
            .withColumn("digest", vector_key("payload")))


def distinct_base(base: DataFrame, k: int) -> DataFrame:
    """One row per distinct vector with its k smallest ids.

    No other copy can be among k neighbours when ties go to the smaller id, so a group
    of copies of any size costs k ids. The row limit is applied on the map side first.
    """
    w = Window.partitionBy("digest").orderBy("id")
    few = base.withColumn("n", F.row_number().over(w)).where(F.col("n") <= k)
    return (few.groupBy("digest").agg(F.sort_array(F.collect_list("id")).alias("ids"),
                                      F.any_value("payload").alias("payload")))


def pairwise(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances of the rows of two matrices."""
    square = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * (a @ b.T)
    return np.sqrt(np.maximum(square, 0))


def nearest_pivot_udf(pivots: np.ndarray):
    @F.arrow_udf("struct<cell:int,radius:double>")
    def nearest(vectors: pa.Array) -> pa.Array:
        if len(vectors) == 0:
            return pa.array([], pa.struct([("cell", pa.int32()), ("radius", pa.float64())]))
        d = pairwise(matrix(vectors), pivots)
        cell = d.argmin(axis=1)
        return pa.StructArray.from_arrays(
            [pa.array(cell, pa.int32()), pa.array(d[np.arange(len(d)), cell])], ["cell", "radius"])
    return nearest


def home_cells_udf(pivots: np.ndarray, cells: np.ndarray, counts: np.ndarray, k: int):
    """The nearest cells of a query that hold at least k ids together."""
    @F.arrow_udf("array<int>")
    def home(vectors: pa.Array) -> pa.Array:
        if len(vectors) == 0:
            return pa.array([], pa.list_(pa.int32()))
        d = pairwise(matrix(vectors), pivots[cells])
        order = np.argsort(d, axis=1, kind="stable")
        filled = np.cumsum(counts[order], axis=1)
        need = np.minimum((filled < k).sum(axis=1) + 1, len(cells))
        return pa.array([cells[o[:n]] for o, n in zip(order, need)], pa.list_(pa.int32()))
    return home


def remaining_cells_udf(pivots: np.ndarray, cells: np.ndarray, low: np.ndarray, high: np.ndarray):
    """Cells not searched yet that may hold something nearer than the bound.

    A member of a cell lies between ``low`` and ``high`` from its pivot, and nearer to
    that pivot than to any other; both facts bound its distance from below.
    """
    between = pairwise(pivots, pivots)

    @F.arrow_udf("array<int>")
    def remaining(vectors: pa.Array, bound: pa.Array, searched: pa.Array) -> pa.Array:
        if len(vectors) == 0:
            return pa.array([], pa.list_(pa.int32()))
        to_all = pairwise(matrix(vectors), pivots)
        d, own = to_all[:, cells], to_all.argmin(axis=1)
        gap = between[own][:, cells]
        plane = (d ** 2 - to_all[np.arange(len(d)), own][:, None] ** 2) / np.where(gap == 0, np.inf, 2 * gap)
        least = np.maximum(np.maximum(d - high, low - d), plane)
        limit = np.array([np.inf if b is None else b for b in bound.to_pylist()])
        keep = least <= limit[:, None] + SLACK * (1 + d)
        return pa.array([np.setdiff1d(cells[m], s) for m, s in zip(keep, searched.to_pylist())],
                        pa.list_(pa.int32()))
    return remaining


def choose_pivots(base: DataFrame, count: int) -> np.ndarray:
    """``count`` vectors picked by digest: dense regions get more."""
    rows = (base.orderBy(F.xxhash64("digest"), "digest").limit(count)
            .select("payload").toArrow())
    return matrix(rows["payload"])


def exact_knn(queries: DataFrame, base: DataFrame, k: int, *, query_id: str, base_id: str,
              vector: str = "embedding", metric: str = "cosine", exclude_self: bool = False,
              pivots: int | None = None, block_rows: int = 2048) -> DataFrame:
    """query_id, neighbour_id, distance, rn for the k nearest (ties: smaller id), stored.

    ``metric`` is ``cosine`` (1 - cos) or ``euclidean``. ``exclude_self`` drops the
    neighbour with the query's own id.
    """
    want = k + 1 if exclude_self else k
    q_all = prepared(queries, query_id, vector, metric)
    base_rows = materialise(distinct_base(prepared(base, base_id, vector, metric), want), "base")
    n = base_rows.count()
    if n == 0:
        raise ValueError("the base table holds no usable vector")
    q_map = q_all.select("id", F.col("digest").alias("query_key"))
    if queries is base and query_id == base_id:  # the distinct vectors are stored already
        q_rows = base_rows.select(F.col("digest").alias("query_key"), F.col("payload").alias("payload"))
    else:
        q_rows = materialise(q_all.groupBy(F.col("digest").alias("query_key"))
                             .agg(F.any_value("payload").alias("payload")), "queries")
    score = Cosine() if metric == "cosine" else Euclidean()
    # with sqrt(n) / 4 pivots a cell and the list of pivots grow alike
    scored = voronoi_topk(q_rows, base_rows, n, want, metric, score,
                          pivots or math.ceil(math.sqrt(n) / 4), block_rows)
    return materialise(unfold(q_map, nearest_found(scored, want), k, exclude_self), "neighbours")


def voronoi_topk(q_rows: DataFrame, base_rows: DataFrame, n: int, want: int, metric: str,
                 score: Scorer, pivots: int, block_rows: int) -> DataFrame:
    """Candidates that are sure to hold the ``want`` nearest ids of every query."""
    pivot = choose_pivots(base_rows, pivots)
    near = nearest_pivot_udf(pivot)
    celled = materialise(
        base_rows.withColumn("p", near("payload"))
        .select(F.col("p.cell").alias("cell"), F.col("p.radius").alias("radius"), "ids", "payload"),
        "celled")
    stats = (celled.groupBy("cell").agg(F.min("radius").alias("low"), F.max("radius").alias("high"),
                                        F.sum(F.size("ids")).alias("n"))
             .orderBy("cell").toArrow())  # one row per pivot
    cells = stats["cell"].to_numpy()
    home = home_cells_udf(pivot, cells, stats["n"].to_numpy(), want)
    q_rows = q_rows.withColumn("home", home("payload"))  # read from a stored table, cheap to find twice
    members = celled.select("cell", "ids", "payload")
    none = F.lit(None).cast("double").alias("limit")
    first = materialise(blocked_topk(q_rows.select("query_key", "payload", F.col("home").alias("cells"), none), members, want, score,
                                     pivot.shape[1], block_rows), "first")
    # the bound counts ids, not distinct vectors: ids of one row share a distance
    bound = nearest_found(first, want).select("query_key", F.when(F.size("near") >= want, F.element_at("near.score", -1)).alias("limit"))
    chord = F.sqrt(F.greatest(2 * F.col("limit"), F.lit(0.0))) if metric == "cosine" else F.col("limit")
    rest = remaining_cells_udf(pivot, cells, stats["low"].to_numpy(), stats["high"].to_numpy())
    more = (q_rows.join(bound, "query_key").withColumn("bound", chord)
            .withColumn("cells", rest("payload", "bound", "home"))
            .select("query_key", "payload", "cells", F.col("limit") + SLACK))
    more = materialise(more.toDF("query_key", "payload", "cells", "limit"), "more")
    return first.unionByName(blocked_topk(more, members, want, score, pivot.shape[1], block_rows))


def unfold(q_map: DataFrame, best: DataFrame, k: int, exclude_self: bool) -> DataFrame:
    """Give every copy of a query vector its neighbours: ``best`` (query_key, near) has them in order."""
    joined = salted_join(q_map, best, "query_key", stored=True)  # computing the keys again is less than storing them
    near = F.col("near")
    if exclude_self:
        near = F.slice(F.filter(near, lambda s: s["neighbour"] != F.col("id")), 1, k)
    return (joined.select("id", F.posexplode(near).alias("at", "s"))
            .select(F.col("id").alias("query_id"), F.col("s.neighbour").alias("neighbour_id"),
                    F.col("s.score").alias("distance"), (F.col("at") + 1).alias("rn")))
