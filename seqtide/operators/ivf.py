"""Inverted-file index with 1-bit codes: train, assign, encode, search, audit."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seqtide.functions.vectors import doubles, finite, lists, matrix, norm, normalise, settled, sign_code
from seqtide.operators.blocks import blocked_topk, nearest_found, within, within_cosine
from seqtide.operators.knn import pairwise, prepared, unfold
from seqtide.session import materialise


def train_cells(vectors: DataFrame, cells: int, vector: str = "embedding", seed: int = 42,
                sample_rows: int | None = None, max_iter: int = 20, metric: str = "cosine") -> np.ndarray:
    """Centroids (cells, d) by k-means: spherical and of unit length for ``cosine``, plain for ``euclidean``.

    Training may use a sample of ``sample_rows``, since centroids only steer the
    search; assignment and search always cover every vector.
    """
    rows = vectors.where(searchable(vector, metric)).select((normalise(vector) if metric == "cosine" else doubles(vector)).alias("v"))
    if sample_rows is not None:
        fraction = min(1.0, sample_rows / max(1, rows.count()))
        rows = rows.sample(fraction=fraction, seed=seed)
    fit = KMeans(k=cells, seed=seed, maxIter=max_iter, distanceMeasure=metric,
                 featuresCol="features").fit(rows.select(array_to_vector("v").alias("features")))
    centres = np.stack(fit.clusterCenters())
    if metric == "euclidean":
        return centres
    return centres / np.maximum(np.linalg.norm(centres, axis=1, keepdims=True), 1e-300)


def searchable(vector: str = "embedding", metric: str = "cosine"):
    whole = F.col(vector).isNotNull() & finite(vector)
    return whole & (norm(F.col(vector).cast("array<double>")) > 0) if metric == "cosine" else whole


def nearest_cells_udf(centroids: np.ndarray, probes: int, metric: str = "cosine"):
    """vector -> its ``probes`` nearest cells, nearest first (ties: lower cell)."""
    @F.arrow_udf("array<int>")
    def nearest(vectors: pa.Array) -> pa.Array:
        if len(vectors) == 0:
            return pa.array([], pa.list_(pa.int32()))
        rows = unit(matrix(vectors)) if metric == "cosine" else matrix(vectors).astype(np.float64)
        step = max(1, DISTANCES // len(centroids))
        parts = [nearest_few(pairwise(rows[i:i + step], centroids), probes) for i in range(0, len(rows), step)]
        return lists(np.concatenate(parts).astype(np.int32))
    return nearest


#: Distances to centroids that a task holds at a time.
DISTANCES = 4 << 20


def nearest_few(d: np.ndarray, few: int) -> np.ndarray:
    """Columns of the ``few`` smallest values of each row, in order; equal ones by column."""
    if few == 1:
        return d.argmin(axis=1)[:, None]
    if few >= d.shape[1]:
        return np.argsort(d, axis=1, kind="stable")
    bound = np.partition(d, few - 1, axis=1)[:, few - 1:few]
    out = np.empty((len(d), few), np.int64)
    for i in range(len(d)):  # ties at the border may leave more than ``few``
        near = np.flatnonzero(d[i] <= bound[i])
        out[i] = near[np.argsort(d[i, near], kind="stable")[:few]]
    return out


def assign_cells(vectors: DataFrame, centroids: np.ndarray, vector: str = "embedding", metric: str = "cosine") -> DataFrame:
    """Adds ``cell``. The centroid matrix is cells x d, whatever the number of rows."""
    nearest = nearest_cells_udf(centroids, 1, metric)
    return settled(vectors.where(searchable(vector, metric)), vector).withColumn("_c", nearest(vector)) \
        .withColumn("cell", F.col("_c")[0]).drop("_c")


def rotation(dimension: int, seed: int) -> np.ndarray:
    """Seeded random orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dimension, dimension)))
    return q * np.sign(np.diag(r))


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows scaled to length one; zero rows stay zero."""
    rows = rows.astype(np.float64)
    length = np.linalg.norm(rows, axis=1, keepdims=True)
    return rows / np.where(length == 0, 1, length)


def rotated_udf(turn: np.ndarray):
    """vector -> its unit vector, rotated."""
    @F.arrow_udf("array<double>")
    def rotate(vectors: pa.Array) -> pa.Array:
        return lists(unit(matrix(vectors)) @ turn.T) if len(vectors) else pa.array([], pa.list_(pa.float64()))
    return rotate


def quantise(vectors: DataFrame, dimension: int, vector: str = "embedding",
             seed: int | None = None) -> DataFrame:
    """Adds ``code`` (a bit per dimension), ``norm`` and ``align``.

    ``align`` is the inner product of the unit vector and its code direction. With a
    ``seed`` the vector is rotated first, which spreads its energy over the bits.
    """
    turned = normalise(vector) if seed is None else rotated_udf(rotation(dimension, seed))(vector)
    rows = (vectors if seed is None else settled(vectors, vector)).withColumn("_u", turned)
    spread = F.aggregate("_u", F.lit(0.0), lambda s, x: s + F.abs(x))
    return (rows.withColumn("code", sign_code("_u", dimension))
            .withColumn("norm", norm(F.col(vector).cast("array<double>")))
            .withColumn("align", spread / F.sqrt(F.lit(float(dimension)))).drop("_u"))


def offset_udf(centroids: np.ndarray, seed: int | None):
    """vector, cell -> the vector seen from the cell's centroid, rotated."""
    turn = None if seed is None else rotation(centroids.shape[1], seed)

    @F.arrow_udf("array<double>")
    def offset(vectors: pa.Array, cells: pa.Array) -> pa.Array:
        if len(vectors) == 0:
            return pa.array([], pa.list_(pa.float64()))
        rows = matrix(vectors) - centroids[cells.to_numpy()]
        return lists(rows if turn is None else rows @ turn.T)
    return offset


def quantise_offsets(celled: DataFrame, centroids: np.ndarray, vector: str = "embedding", seed: int | None = 42) -> DataFrame:
    """Adds ``code``, ``norm`` and ``align`` of every vector's offset from its centroid, for Euclidean search."""
    dimension = centroids.shape[1]
    rows = settled(settled(celled, vector).withColumn("_o", offset_udf(centroids, seed)(vector, "cell")), "_o")
    rows = rows.withColumn("norm", norm("_o"))
    spread = F.aggregate("_o", F.lit(0.0), lambda s, x: s + F.abs(x)) / F.sqrt(F.lit(float(dimension)))
    return (rows.withColumn("code", sign_code("_o", dimension))
            .withColumn("align", F.when(F.col("norm") > 0, spread / F.col("norm")).otherwise(1.0)).drop("_o"))


def build_index(vectors: DataFrame, centroids: np.ndarray, dimension: int,
                vector: str = "embedding", seed: int | None = 42, metric: str = "cosine") -> DataFrame:
    """cell, code, norm, align next to the input columns; write it by cell."""
    if metric == "euclidean":
        return quantise_offsets(assign_cells(vectors, centroids, vector, metric), centroids, vector, seed)
    return quantise(assign_cells(vectors, centroids, vector), dimension, vector, seed)


#: Ids that a stored code table keeps per equal code, and so the longest shortlist it serves.
STORED_IDS = 1000


def code_table(index: DataFrame, base_id: str, most: int = STORED_IDS, metric: str = "cosine") -> DataFrame:
    """cell, ids, payload (code, align) per distinct code and align of a cell, to be stored beside the index.

    Rows of equal code and align have one estimate and rank by id, so ``most`` ids of
    each are enough for shortlists up to that length; ``search`` refuses longer ones. Tables of several
    disjoint parts of an index, one after another, are the table of the whole.
    """
    marks = ["code", "align"] if metric == "cosine" else ["code", "align", "norm"]
    w = Window.partitionBy("cell", *marks).orderBy(base_id)
    few = (index.select("cell", *marks, base_id).withColumn("n", F.row_number().over(w))
           .where(F.col("n") <= most))
    return few.groupBy("cell", *marks).agg(F.sort_array(F.collect_list(base_id)).alias("ids")) \
        .select("cell", "ids", F.struct(*marks).alias("payload"))


class Codes:
    """Estimated cosine distance of full query vectors to 1-bit codes.

    The code direction of a vector u is sign(u) / sqrt(d), and ``align`` its product
    with u: dividing the query's product with the code direction by ``align`` takes
    out what the code loses.
    """

    def base(self, payload):
        parts = payload.combine_chunks() if isinstance(payload, pa.ChunkedArray) else payload
        return tuple([matrix(parts.field("code")).astype("<i8"), parts.field("align").to_numpy(zero_copy_only=False)])

    def asked(self, rows, cell):
        return rows

    def products(self, queries, words, align):
        """Estimated cosines."""
        signs = np.unpackbits(np.ascontiguousarray(words).view(np.uint8), axis=1, bitorder="little")[:, :queries.shape[1]] * 2.0 - 1.0
        out = queries @ signs.T
        out /= (np.sqrt(queries.shape[1]) * np.where(align == 0, 1, align))[None, :]
        return out

    def scores(self, queries, words, align):
        return 1.0 - self.products(queries, words, align)

    def near(self, queries, base, limit, k):
        return within_cosine(self.products(queries, *base), limit)


class OffsetCodes(Codes):
    """Estimated squared Euclidean distance of queries to the coded offsets of a cell:
    |q|^2 + |v|^2 - 2 q.v, the last term from the code. Both are seen from the same centroid, ``turn`` is the index's rotation."""

    def __init__(self, centroids: np.ndarray | None = None, turn: np.ndarray | None = None):
        self.centroids, self.turn = centroids, turn

    def base(self, payload):
        parts = payload.combine_chunks() if isinstance(payload, pa.ChunkedArray) else payload
        return (*super().base(parts), parts.field("norm").to_numpy(zero_copy_only=False))

    def asked(self, rows, cell):
        rows = rows - self.centroids[cell]
        return rows if self.turn is None else rows @ self.turn.T

    def scores(self, queries, words, align, length):
        along = (1.0 - super().scores(queries, words, align)) * length[None, :]
        return (queries * queries).sum(axis=1)[:, None] + (length * length)[None, :] - 2 * along

    def near(self, queries, base, limit, k):
        return within(self.scores(queries, *base), limit)


def estimates(queries: pa.ChunkedArray, base: pa.ChunkedArray) -> np.ndarray:
    """Estimated cosine distances of full query vectors to codes (code, align)."""
    return Codes().scores(matrix(queries), *Codes().base(base))


def squared_estimates(queries: pa.ChunkedArray, base: pa.ChunkedArray) -> np.ndarray:
    """Estimated squared Euclidean distances of query offsets to codes (code, align, norm) of the same cell."""
    return OffsetCodes().scores(matrix(queries), *OffsetCodes().base(base))


def search(queries: DataFrame, index: DataFrame, centroids: np.ndarray, k: int, *,
           query_id: str, base_id: str, dimension: int, probes: int = 8, refine: int = 4,
           vector: str = "embedding", seed: int | None = 42, exclude_self: bool = False,
           block_rows: int = 2048, codes: DataFrame | None = None, metric: str = "cosine") -> DataFrame:
    """query_id, neighbour_id, distance, rn: approximate k nearest by cosine or Euclidean distance, stored.

    ``metric`` is that of the index and its centroids. Codes are compared in the probed cells by their estimated distance, equal ones by
    id; per query the k * refine best are re-ranked on full vectors. ``codes`` is the
    stored ``code_table`` of the index. The cells that any query probes are at most as
    many as centroids; where they are not all, every scan of a table written by cell
    reads theirs only.
    """
    want = k + 1 if exclude_self else k
    short = want * refine
    if codes is not None and short > STORED_IDS:
        raise ValueError(f"a stored code table serves shortlists of {STORED_IDS}, not {short}")
    probe = nearest_cells_udf(centroids, probes, metric)
    q_all = prepared(queries, query_id, vector, metric)
    q_map = q_all.select("id", F.col("digest").alias("query_key"))
    q_rows = q_all.groupBy(F.col("digest").alias("query_key")).agg(F.any_value("payload").alias("unit"))
    q_rows = settled(q_rows, "unit").withColumn("cells", probe("unit"))
    turned = F.col("unit") if seed is None or metric == "euclidean" else rotated_udf(rotation(dimension, seed))("unit")
    q_rows = materialise(q_rows.withColumn("turned", turned), "probes")
    probed = [r[0] for r in q_rows.select(F.explode("cells")).distinct().collect()]  # at most one per centroid
    codes = code_table(index, base_id, short, metric) if codes is None else codes
    if len(probed) < len(centroids):
        codes, index = codes.where(F.col("cell").isin(probed)), index.where(F.col("cell").isin(probed))
    codes = materialise(codes.select("cell", "ids", "payload"), "codes")
    asked = q_rows.select("query_key", F.col("turned").alias("payload"), "cells", F.lit(None).cast("double").alias("limit"))
    score = Codes() if metric == "cosine" else OffsetCodes(centroids, None if seed is None else rotation(dimension, seed))
    scored = blocked_topk(asked, codes, short, score, dimension, block_rows, base_numbers=CODE_NUMBERS + dimension // 64)
    kept = nearest_found(scored, short).select("query_key", F.col("near.cell").alias("cells"), F.col("near.neighbour").alias("neighbours"))
    best = rerank(materialise(kept, "shortlist"), q_rows.select("query_key", "unit"), index, want,
                  base_id, vector, block_rows, dimension, metric)
    return materialise(unfold(q_map, best, k, exclude_self), "neighbours")


#: Numbers that a row of a code table is as long as, beside its code: id, cell, marks.
CODE_NUMBERS = 6
#: Pairs of a query and a neighbour, and numbers in their vectors, that one group re-ranks.
RERANK_PAIRS, RERANK_NUMBERS = 1 << 18, 1 << 23


def rerank_grid(shortlist: DataFrame, block_rows: int, dimension: int | None) -> DataFrame:
    """cell, nb, nq: blocks of neighbours and parts of queries of each cell; one row per cell."""
    side = block_rows if dimension is None else max(RERANK_NUMBERS // dimension // 2, 1)
    sizes = shortlist.groupBy("cell").agg(F.count("*").alias("pairs"), F.approx_count_distinct("neighbour").alias("nb"),
                                          F.approx_count_distinct("query_key").alias("nq"))
    return sizes.select("cell", F.ceil(F.col("nb") / side).cast("int").alias("nb"), F.greatest(
        F.ceil(F.col("nq") / side), F.ceil(F.col("pairs") / RERANK_PAIRS / F.ceil(F.col("nb") / side))).cast("int").alias("nq"))


def rerank_blocks(shortlist: DataFrame, block_rows: int, dimension: int | None, grid: DataFrame | None = None) -> DataFrame:
    """``shortlist`` with block (of neighbours) and part (of queries) within its cell."""
    grid = rerank_grid(shortlist, block_rows, dimension) if grid is None else grid
    return shortlist.join(F.broadcast(grid), "cell").select(
        "cell", F.pmod(F.xxhash64("neighbour"), "nb").cast("int").alias("block"),
        F.pmod(F.xxhash64("query_key"), "nq").cast("int").alias("part"), "query_key", "neighbour")


def rerank(shortlist: DataFrame, queries: DataFrame, base: DataFrame, k: int, base_id: str,
           vector: str, block_rows: int = 2048, dimension: int | None = None, metric: str = "cosine") -> DataFrame:
    """query_key, near: the k nearest of a stored shortlist (query_key, cells, neighbours) by exact distance.

    A cell's pairs are cut into a grid of blocks of neighbours by parts of queries, so many that a group
    holds few enough pairs, and few enough vectors of either side, to fit ``RERANK_NUMBERS``. A query travels
    once to each block that has some of its neighbours, a neighbour's vector once to each part.
    """
    one = shortlist.select("query_key", F.explode(F.arrays_zip("cells", "neighbours")).alias("s")).select(
        F.col("s.cells").alias("cell"), "query_key", F.col("s.neighbours").alias("neighbour"))
    grid = materialise(rerank_grid(one, block_rows, dimension), "grid")
    asked = rerank_blocks(one, block_rows, dimension, grid).groupBy("cell", "block", "part", "query_key").agg(
        F.collect_list("neighbour").alias("sought")).join(queries.select("query_key", "unit"), "query_key")
    vectors = base.select("cell", F.col(base_id).alias("neighbour"), F.col(vector).alias("payload")).join(F.broadcast(grid), "cell").select(
        "cell", F.pmod(F.xxhash64("neighbour"), "nb").cast("int").alias("block"),
        F.explode(F.sequence(F.lit(0), F.col("nq") - 1)).alias("part"), "neighbour", "payload")
    text, number = shortlist.schema["query_key"].dataType, one.schema["neighbour"].dataType
    on = ["cell", "block", "part"]
    found = asked.groupBy(*on).cogroup(vectors.groupBy(*on)).applyInArrow(
        _measurer(metric, k), f"query_key {text.simpleString()}, found array<struct<score:double,neighbour:{number.simpleString()}>>")
    return nearest_found(found, k)


def _measurer(metric: str, k: int):
    def measured(asked: pa.Table, base: pa.Table) -> pa.Table:
        lists = asked["sought"].combine_chunks()
        sought, known = lists.flatten(), base["neighbour"].combine_chunks()
        kind = pa.struct([("score", pa.float64()), ("neighbour", known.type)])
        i, j = pc.list_parent_indices(lists).to_numpy(), pc.index_in(sought, known)
        there = pc.is_valid(j).to_numpy(zero_copy_only=False)
        i, j = i[there], j.drop_null().to_numpy()
        if not len(i):
            return pa.table({"query_key": asked["query_key"].slice(0, 0), "found": pa.array([], pa.list_(kind))})
        q, b = matrix(asked["unit"]), matrix(base["payload"]).astype(np.float64)
        b = unit(b) if metric == "cosine" else b
        score = np.empty(len(i))
        step = max(1, (DISTANCES // 4) // max(q.shape[1], 1))
        for at in range(0, len(i), step):
            x, y = q[i[at:at + step]], b[j[at:at + step]]
            score[at:at + step] = 1.0 - np.einsum("ij,ij->i", x, y) if metric == "cosine" else np.sqrt(((x - y) ** 2).sum(axis=1))
        order = np.lexsort((score, i))
        i, j, score = i[order], j[order], score[order]
        begins = np.flatnonzero(np.concatenate([[True], i[1:] != i[:-1]]))
        sizes = np.diff(np.append(begins, len(i)))
        last = np.repeat(score[begins + np.minimum(sizes, k) - 1], sizes)
        stay = score <= last  # the k nearest and those as near as the last of them
        i, j, score = i[stay], j[stay], score[stay]
        rows = i[np.flatnonzero(np.concatenate([[True], i[1:] != i[:-1]]))]
        ends = np.append(np.searchsorted(i, rows), len(i)).astype(np.int32)
        both = pa.StructArray.from_arrays([pa.array(score), known.take(pa.array(j))], fields=list(kind))
        return pa.table({"query_key": asked["query_key"].take(pa.array(rows)), "found": pa.ListArray.from_arrays(pa.array(ends), both)})
    return measured


def recall(found: DataFrame, exact: DataFrame) -> DataFrame:
    """Share of exact neighbours that the index found, per k of the exact result."""
    hits = exact.join(found.select("query_id", "neighbour_id").withColumn("hit", F.lit(1)),
                      ["query_id", "neighbour_id"], "left")
    per_query = hits.groupBy("query_id").agg(F.count("hit").alias("hits"), F.count("*").alias("k"))
    return per_query.agg(F.count("*").alias("queries"), F.avg(F.col("hits") / F.col("k")).alias("recall"),
                         F.min(F.col("hits") / F.col("k")).alias("worst"))


def sampled(rows: DataFrame, key: str, one_in: int) -> DataFrame:
    """About one row in ``one_in``, chosen by the key alone."""
    return rows.where(F.conv(F.substring(F.md5(F.col(key).cast("string")), 1, 8), 16, 10).cast("long") % one_in == 0)


def recall_bound(found: DataFrame, exact: DataFrame, z: float = 1.96) -> DataFrame:
    """queries, neighbours, recall, lower: the share found of the ``exact`` neighbours of some queries, and the
    lower end of its Wilson interval.

    With a sample of the queries the cost is that of the exact search for these, not for all.
    """
    hits = exact.select("query_id", "neighbour_id").join(
        found.select("query_id", "neighbour_id").withColumn("hit", F.lit(1)), ["query_id", "neighbour_id"], "left")
    n, p = F.col("neighbours"), F.col("recall")
    centre, spread = p + z * z / 2 / n, z * F.sqrt(p * (1 - p) / n + z * z / 4 / n / n)
    return hits.agg(F.countDistinct("query_id").alias("queries"), F.count("*").alias("neighbours"), (F.count("hit") / F.count("*")).alias("recall")) \
        .withColumn("lower", (centre - spread) / (1 + z * z / n))


def lookup(query: DataFrame, index: DataFrame, centroids: np.ndarray, k: int, **options) -> DataFrame:
    """Neighbours of a few given vectors with all stored columns and ``_distance``.

    With an index table partitioned by cell, every scan of it reads the probed cells only.
    """
    options.setdefault("probes", 8)
    cells = settled(query.where(searchable(options.get("vector", "embedding"))).select(
        normalise(options.get("vector", "embedding")).alias("unit")), "unit").select(
        F.explode(nearest_cells_udf(centroids, options["probes"])("unit"))).distinct()
    index = index.where(F.col("cell").isin([r[0] for r in cells.collect()]))  # at most one per centroid
    hits = search(query, index, centroids, k, **options)
    base_id = options["base_id"]
    stored = index.drop("cell", "code", "norm", "align", options.get("vector", "embedding"))
    return hits.select(F.col("neighbour_id").alias(base_id), "query_id", "rn",
                       F.col("distance").alias("_distance")).join(stored, base_id)


def lookup_vector(query: np.ndarray, index: DataFrame, centroids: np.ndarray, k: int, *, base_id: str, dimension: int,
                  probes: int = 8, refine: int = 4, vector: str = "embedding", seed: int | None = 42) -> DataFrame:
    """The neighbours of one vector with all stored columns, ``_distance`` and ``rn``: one job over the probed cells.

    Every task keeps the k * refine best rows of its part by their codes and measures these
    exactly; the best k * refine of all tasks by code, and of them the k nearest, are the result of ``search``
    for that vector. Nothing is stored or shuffled but those few rows. A zero or broken vector has no neighbours.
    """
    asked = np.asarray(query, np.float64)[None, :]
    usable = np.isfinite(asked).all() and np.linalg.norm(asked) > 0
    one = unit(asked)[0] if usable else np.zeros(dimension)
    cells = nearest_few(pairwise(one[None, :], centroids), probes)[0].tolist() if usable else []
    turned = one if seed is None else rotation(dimension, seed) @ one
    short = k * refine
    part = index.where(F.col("cell").isin(cells))
    stored = [c for c in index.columns if c not in ("cell", "code", "norm", "align", vector)]
    kinds = ", ".join(f"`{c}` {index.schema[c].dataType.simpleString()}" for c in stored)

    def best(batches):
        kept = None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            codes = pa.StructArray.from_arrays([table["code"].combine_chunks(), table["align"].combine_chunks()], ["code", "align"])
            estimate = estimates(pa.array([turned.tolist()]), codes)[0]
            table = table.drop_columns(["code", "align"]).append_column("_estimate", pa.array(estimate))
            kept = table if kept is None else pa.concat_tables([kept, table])
            kept = kept.take(pc.sort_indices(kept, [("_estimate", "ascending"), (base_id, "ascending")])[:short])
        if kept is not None:
            distance = 1.0 - unit(matrix(kept[vector])) @ one
            yield from kept.drop_columns([vector]).append_column("_distance", pa.array(distance)).to_batches()

    near = part.select(*stored, "code", "align", vector).mapInArrow(best, kinds + ", _estimate double, _distance double")
    nearest = near.orderBy("_estimate", base_id).limit(short).orderBy("_distance", base_id).limit(k)
    # k rows
    return nearest.drop("_estimate").withColumn("rn", F.row_number().over(Window.orderBy("_distance", base_id)))
