"""Fuzzy neighbour graph, low-dimensional layout, and projection of new points."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqtide.functions.vectors import matrix, normalise
from seqtide.operators.skew import dense_index, salted_join
from seqtide.session import Rounds, materialise

BISECTIONS = 64
START_WIDTH = 10.0


def bandwidth_udf(k: int):
    """Sorted neighbour distances -> rho (nearest non-zero) and sigma, chosen so that the
    memberships exp(-(d - rho) / sigma) add up to log2(k)."""
    target = math.log2(k)
    kind = pa.struct([("rho", pa.float64()), ("sigma", pa.float64())])

    @F.arrow_udf("struct<rho:double,sigma:double>")
    def bandwidth(distances: pa.Array) -> pa.Array:
        rows = distances.to_pylist()
        if not rows:
            return pa.array([], kind)
        d = np.full((len(rows), max(map(len, rows))), np.inf)
        for i, r in enumerate(rows):
            d[i, :len(r)] = r
        positive = np.where(d > 0, d, np.inf).min(axis=1)
        rho = np.where(np.isfinite(positive), positive, 0.0)
        excess = np.maximum(d - rho[:, None], 0)
        low, high, sigma = np.zeros(len(d)), np.full(len(d), np.inf), np.ones(len(d))
        for _ in range(BISECTIONS):
            above = np.exp(-excess / sigma[:, None]).sum(axis=1) > target
            high, low = np.where(above, sigma, high), np.where(above, low, sigma)
            sigma = np.where(np.isinf(high), sigma * 2, (low + high) / 2)
        return pa.StructArray.from_arrays([pa.array(rho), pa.array(sigma)], ["rho", "sigma"])
    return bandwidth


def memberships(neighbours: DataFrame, k: int) -> DataFrame:
    """Adds ``weight`` in (0, 1] to each neighbour row; k rows per query are grouped."""
    near = F.sort_array(F.collect_list(F.struct("distance", "rn", "neighbour_id")))
    packed = neighbours.groupBy("query_id").agg(near.alias("near"))
    spread = packed.withColumn("b", bandwidth_udf(k)(F.col("near.distance")))
    excess = F.greatest(F.col("s.distance") - F.col("b.rho"), F.lit(0.0))
    return (spread.select("query_id", "b", F.explode("near").alias("s"))
            .select("query_id", "s.neighbour_id", "s.distance", "s.rn", "b.rho", "b.sigma",
                    F.exp(-excess / F.col("b.sigma")).alias("weight")))


def fuzzy_graph(neighbours: DataFrame, k: int) -> DataFrame:
    """Undirected edges a < b with the fuzzy union x + y - xy of both memberships."""
    w = memberships(neighbours.where(F.col("query_id") != F.col("neighbour_id")), k)
    pair = w.groupBy(F.least("query_id", "neighbour_id").alias("a"),
                     F.greatest("query_id", "neighbour_id").alias("b"))
    both = F.max("weight") + F.min("weight") - F.max("weight") * F.min("weight")
    return pair.agg(F.when(F.count("*") == 2, both).otherwise(F.max("weight")).alias("weight"))


def principal_layout(points: DataFrame, dims: int, vector: str = "embedding") -> DataFrame:
    """id, coords: first principal components of the unit vectors (d x d on the driver),
    scaled so that clusters start well apart."""
    rows = points.select("id", array_to_vector(normalise(vector)).alias("features"))
    model = PCA(k=dims, inputCol="features", outputCol="components").fit(rows)
    placed = materialise(model.transform(rows).select("id", vector_to_array("components").alias("coords")), "start")
    # one number: the widest coordinate becomes START_WIDTH
    width = placed.agg(F.max(F.array_max(F.transform("coords", lambda x: F.abs(x))))).first()[0] or 1.0
    return placed.select("id", F.transform("coords", lambda x: x * (START_WIDTH / width)).alias("coords"))


def curve(min_dist: float, spread: float = 1.0) -> tuple[float, float]:
    """a, b of 1 / (1 + a x^2b) fitted to a plateau of min_dist with an exponential tail."""
    x = np.linspace(1e-3, 3 * spread, 300)
    y = np.where(x < min_dist, 1.0, np.exp(-(x - min_dist) / spread))
    a, b = 1.0, 1.0
    for _ in range(100):
        p = x ** (2 * b)
        f = 1 / (1 + a * p)
        jac = np.stack([-p * f ** 2, -2 * a * p * np.log(x) * f ** 2], axis=1)
        step = np.linalg.lstsq(jac, y - f, rcond=None)[0]
        a, b = max(a + 0.5 * step[0], 1e-3), max(b + 0.5 * step[1], 1e-3)
    return float(a), float(b)


def _squared(u: Column, v: Column) -> Column:
    return F.aggregate(F.zip_with(u, v, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x)


def _pull(scale: Column, u: Column, v: Column) -> Column:
    return F.zip_with(u, v, lambda x, y: F.least(F.greatest(scale * (x - y), F.lit(-4.0)), F.lit(4.0)))


def layout(points: DataFrame, graph: DataFrame, dims: int = 10, epochs: int = 20,
           min_dist: float = 0.0, seed: int = 42, negatives: int = 5,
           vector: str = "embedding") -> DataFrame:
    """id, coords: the graph drawn in ``dims`` dimensions.

    Every epoch moves all points at once: neighbours attract by edge weight, hashed
    partners repel. Partners come from a hash of point, epoch and seed, so a retried
    task or another partitioning gives the same layout.
    """
    a, b = curve(min_dist)
    start = dense_index(principal_layout(points, dims, vector), ["id"])
    rounds = Rounds(points.sparkSession, "layout")
    state = rounds.keep(start.select("id", "idx", "coords"))
    n = state.count()
    both = materialise(graph.select("a", "b", "weight").unionByName(
        graph.select(F.col("b").alias("a"), F.col("a").alias("b"), "weight")), "graph")
    degree = materialise(both.groupBy("b").agg(F.count("*").alias("n")), "degree")
    for epoch in range(epochs):
        rate = 1.0 - epoch / epochs
        there = salted_join(both, state.select(F.col("id").alias("b"), F.col("coords").alias("yb")),
                            "b", weights=degree)
        edge = salted_join(there, state.select(F.col("id").alias("a"), F.col("coords").alias("ya")), "a",
                           weights=degree.withColumnRenamed("b", "a"))
        d2 = F.greatest(_squared(F.col("ya"), F.col("yb")), F.lit(1e-12))
        attract = -2 * a * b * F.pow(d2, b - 1) / (1 + a * F.pow(d2, b)) * F.col("weight")
        pulled = edge.select(F.col("a").alias("id"), _pull(attract, F.col("ya"), F.col("yb")).alias("f"),
                             F.col("weight").alias("share"))
        partner = F.pmod(F.xxhash64("idx", F.lit(epoch), "s", F.lit(seed)), F.lit(n))
        chance = state.select("id", F.col("coords").alias("ya"), "idx",
                              F.explode(F.sequence(F.lit(1), F.lit(negatives))).alias("s")).select(
            "id", "ya", "idx", partner.alias("other")).where(F.col("idx") != F.col("other"))
        met = chance.join(state.select(F.col("idx").alias("other"), F.col("coords").alias("yb")), "other")
        r2 = _squared(F.col("ya"), F.col("yb"))
        repel = 2 * b / ((0.001 + r2) * (1 + a * F.pow(r2, b))) / negatives
        pushed = met.select("id", _pull(repel, F.col("ya"), F.col("yb")).alias("f"), F.lit(0.0).alias("share"))
        sums = pulled.withColumn("kind", F.lit(0)).unionByName(pushed.withColumn("kind", F.lit(1))).groupBy("id").agg(
            F.greatest(F.sum("share"), F.lit(1.0)).alias("share"),
            *[F.sum(F.when(F.col("kind") == t, F.col("f")[i]).otherwise(0.0)).alias(f"f{t}_{i}")
              for t in (0, 1) for i in range(dims)])
        force = F.array(*[F.col(f"f0_{i}") / F.col("share") + F.col(f"f1_{i}") for i in range(dims)])
        moved = state.join(sums.select("id", force.alias("force")), "id", "left")
        state = rounds.keep(moved.select("id", "idx", F.when(F.col("force").isNull(), F.col("coords")).otherwise(
            F.zip_with("coords", "force", lambda y, f: y + rate * f)).alias("coords")))
    return state.select("id", "coords")


def project(neighbours: DataFrame, fitted: DataFrame, k: int) -> DataFrame:
    """id, coords of new points: membership-weighted mean of their fitted neighbours.

    ``neighbours`` are the k nearest fitted points of each new one.
    """
    w = memberships(neighbours, k).select(F.col("query_id").alias("id"),
                                          F.col("neighbour_id"), "weight")
    placed = salted_join(w, fitted.select(F.col("id").alias("neighbour_id"), "coords"), "neighbour_id")
    per_dim = (placed.select("id", "weight", F.posexplode("coords").alias("dim", "x"))
               .groupBy("id", "dim").agg((F.sum(F.col("weight") * F.col("x")) / F.sum("weight")).alias("x")))
    packed = F.sort_array(F.collect_list(F.struct("dim", "x")))
    return per_dim.groupBy("id").agg(F.transform(packed, lambda s: s["x"]).alias("coords"))


#: Points whose neighbourhoods are judged at most: their vectors and k distances each go to every task.
JUDGED = 1000


def trustworthiness(points: DataFrame, laid: DataFrame, near: DataFrame, k: int, judged: int = JUDGED, vector: str = "embedding") -> DataFrame:
    """judged, trustworthiness: 1 if the ``k`` nearest points in the layout are the nearest by cosine too, less
    the further down the true order they come.

    ``near`` (query_id, neighbour_id, rn) are neighbours in the layout, without the point itself. ``judged`` points, the first by the digest of
    their id, are compared with all others: one scan counts, per neighbour, how many points are truly nearer.
    """
    spark, n = points.sparkSession, points.count()
    if n < 2 * k + 2:
        raise ValueError("trustworthiness needs more than 2k + 1 points")
    chosen = points.join(laid.select("id"), "id", "left_semi").orderBy(F.md5(F.col("id").cast("string")), "id").limit(judged)
    chosen = materialise(chosen.select("id", normalise(vector).alias("unit")), "judged")
    pairs = near.where(F.col("rn") <= k).join(F.broadcast(chosen.select(F.col("id").alias("query_id"))), "query_id")
    other = points.select(F.col("id").alias("neighbour_id"), normalise(vector).alias("v"))
    reached = salted_join(pairs.select("query_id", "neighbour_id"), other, "neighbour_id").join(
        F.broadcast(chosen.select(F.col("id").alias("query_id"), "unit")), "query_id")
    apart = 1 - F.aggregate(F.zip_with("unit", "v", lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    rows = reached.groupBy("query_id", "unit").agg(F.sort_array(F.collect_list(apart)).alias("far")).collect()  # at most ``judged``
    units, limits = np.array([r["unit"] for r in rows]), [np.array(r["far"]) for r in rows]
    shared = spark.sparkContext.broadcast((units, limits))

    def count(batches):
        units, limits = shared.value
        nearer = np.zeros((len(limits), k), np.int64)
        for batch in batches:
            if batch.num_rows:
                d = 1.0 - units @ matrix(batch.column(0)).T
                for i, limit in enumerate(limits):
                    # the distances were folded in another order: what is as near to 10 digits is not nearer
                    nearer[i, :len(limit)] += np.searchsorted(np.sort(d[i]), limit - 1e-10)
        at = np.argwhere(nearer > 0)
        yield pa.RecordBatch.from_arrays([pa.array(at[:, 0], pa.int32()), pa.array(at[:, 1], pa.int32()), pa.array(nearer[at[:, 0], at[:, 1]], pa.int64())],
                                         names=["i", "j", "n"])
    counted = points.select(normalise(vector).alias("v")).mapInArrow(count, "i int, j int, n long").groupBy("i", "j").agg(F.sum("n").alias("n"))
    # the point itself is among the nearer ones, so ``n`` is the rank
    lost = counted.agg(F.coalesce(F.sum(F.greatest(F.col("n") - k, F.lit(0))), F.lit(0)).alias("lost"))
    scale = 2.0 / (len(rows) * k * (2 * n - 3 * k - 1)) if rows else 0.0
    return lost.select(F.lit(len(rows)).cast("long").alias("judged"), (1 - F.col("lost") * scale).alias("trustworthiness"))
