"""Top-k inside cells, as bounded block pairs.

Queries and base vectors meet on their cell. Base rows are put together, cell by cell, in blocks of bounded size; a
cell too large for one is cut. A query travels once to each block that holds a cell it seeks, whatever the number of
cells, and comes back with its k best of that block: what moves is rows times blocks of the other side, and the blocks are
as large as a task may hold. So no task sees a whole hot cell, and pairs are never written out.
"""

from __future__ import annotations

import math
from typing import Protocol

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqtide.functions.vectors import matrix

#: Numbers of the vectors of one side of a block pair, and rows of a side however short its vectors are.
SIDE_NUMBERS, SIDE_ROWS = 1 << 22, 1 << 20
#: Scores that a task holds at a time.
TILE = 1 << 20
#: Pairs whose vectors lie side by side at a time, to be measured one by one.
PAIRS = 1 << 14
#: Pairs that wait to be put among the best, as a share of these: a merge costs as much as the best are many.
WAITING = 0.5
#: Rows of a side below which more block pairs would not keep more cores busy.
LEAST_ROWS = 2048
NONE = np.iinfo(np.int64).max

Near = tuple[np.ndarray, np.ndarray, np.ndarray]


class Scorer(Protocol):
    """How queries and base rows are compared; the smaller the score, the nearer."""

    def base(self, payload: pa.ChunkedArray) -> tuple[np.ndarray, ...]:
        """What is compared of each base row, as arrays of one entry a row."""

    def asked(self, rows: np.ndarray, cell: int) -> np.ndarray:
        """The query vectors as they are compared in ``cell``."""

    def near(self, queries: np.ndarray, base: tuple[np.ndarray, ...], limit: np.ndarray, k: int) -> Near:
        """Query number (ascending), base number and score of every pair that scores ``limit`` of its query or less; where
        that is infinite, of the k best at least."""


def within(scores: np.ndarray, limit: np.ndarray) -> Near:
    at = np.flatnonzero(~(scores > limit[:, None]))
    rows, columns = np.divmod(at, scores.shape[1])
    return rows, columns, scores.ravel()[at]


def within_cosine(products: np.ndarray, limit: np.ndarray) -> Near:
    """As ``within`` for scores of one less the product, which are made of the few products that may be great enough."""
    least = 1.0 - limit
    at = np.flatnonzero(~(products < (least - 1e-15 * (1 + np.abs(limit)))[:, None])) if np.isfinite(limit).all() else np.arange(products.size)
    rows, columns = np.divmod(at, products.shape[1])
    scores = 1.0 - products.ravel()[at]
    near = ~(scores > limit[rows])
    return rows[near], columns[near], scores[near]


class Cosine:
    """Cosine distance of unit vectors.

    Once every query has a limit, products of half the width tell which pairs may be near enough; these are measured.
    """

    def base(self, payload):
        rows = matrix(payload)
        return rows, rows.astype(np.float32), np.sqrt((rows * rows).sum(axis=1))

    def asked(self, rows, cell):
        return rows

    def near(self, queries, base, limit, k):
        if not np.isfinite(limit).all():
            return within_cosine(queries @ base[0].T, limit)
        slip = _slip(queries.shape[1], np.float32) * (1 + np.sqrt((queries * queries).sum(axis=1)) * base[2].max(initial=0))
        found = _at_least(queries.astype(np.float32) @ base[1].T, 1.0 - limit - slip)
        return _measured(lambda x, y: 1.0 - np.einsum("ij,ij->i", x, y), queries, base[0], found, limit)


class Euclidean:
    """Distance by differences: no cancellation near zero.

    Products only tell which pairs may be near enough; their rounding is allowed for. Vectors are taken from the middle of
    the base rows, so that the rounding goes by how far they lie apart, and products of half the width are enough.
    """

    def base(self, payload):
        return (matrix(payload),)

    def asked(self, rows, cell):
        return rows

    def near(self, queries, base, limit, k):
        with np.errstate(over="ignore", invalid="ignore"):  # numbers too great for products leave every pair to be measured
            middle = base[0].mean(axis=0)
            q, b = queries - middle, base[0] - middle
            own, half = (q * q).sum(axis=1), (b * b).sum(axis=1) / 2
            reach = own + 2 * half.max(initial=0)
            kind = np.float32 if reach.max(initial=0) < 1e30 else np.float64
            # a product of small numbers may be lost altogether
            slip = _slip(q.shape[1], kind) * reach + 4 * (q.shape[1] + 8) * np.finfo(kind).tiny
            products = q.astype(kind) @ b.astype(kind).T
            products -= half.astype(kind)
            # |q - b|^2 <= limit^2 where q b - |b|^2 / 2 >= (|q|^2 - limit^2) / 2
            least = (own - limit * limit * (1 + 1e-12)) / 2 - slip
            open_ = np.flatnonzero(np.isinf(limit))
            if len(open_) and products.shape[1] > k:
                least[open_] = np.partition(products[open_], -k, axis=1)[:, -k] - 2 * slip[open_]
            least[~np.isfinite(least)] = -np.inf
            return _measured(_distance, queries, base[0], _at_least(products, least), limit)


def _distance(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    apart = x - y
    return np.sqrt(np.einsum("ij,ij->i", apart, apart))


def _slip(dimension: int, kind: type) -> float:
    """By how much a product of two vectors of length one, and what is added to it, may be wrong in numbers of this kind."""
    return 2 * (dimension + 8) * float(np.finfo(kind).eps)


def _at_least(products: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of the products that are not less than ``least`` of their row."""
    least = np.nextafter(least.astype(products.dtype), products.dtype.type(-np.inf))
    return np.divmod(_set(~(products < least[:, None]).ravel()), products.shape[1])


def _set(flags: np.ndarray) -> np.ndarray:
    """Places of the flags that are set, of which there are few: eight are looked at together."""
    whole = len(flags) // 8 * 8
    some = np.flatnonzero(flags[:whole].view(np.uint64))
    row, column = np.nonzero(flags[:whole].reshape(-1, 8)[some])
    return np.concatenate([some[row] * 8 + column, whole + np.flatnonzero(flags[whole:])])


def _measured(score, queries: np.ndarray, base: np.ndarray, found: tuple[np.ndarray, np.ndarray], limit: np.ndarray) -> Near:
    """Those of the found pairs that score ``limit`` of their row or less, ``PAIRS`` of them at a time."""
    rows, columns = found
    scores = np.empty(len(rows))
    for a in range(0, len(rows), PAIRS):
        scores[a:a + PAIRS] = score(queries[rows[a:a + PAIRS]], base[columns[a:a + PAIRS]])
    near = ~(scores > limit[rows])
    return rows[near], columns[near], scores[near]


def merge(best: np.ndarray, place: np.ndarray, found: Near, k: int) -> np.ndarray:
    """Puts ``found`` (row ascending, place, score) among the k ``best`` scores of each row and their places.

    Equal scores go by place. Returns the rows that had something found.
    """
    rows, columns, scores = found
    begins = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1]])) if len(rows) else np.zeros(0, np.int64)
    changed, counts = rows[begins], np.diff(np.append(begins, len(rows)))
    if not len(changed):
        return changed
    s = np.full((len(changed), k + int(counts.max())), np.inf)
    p = np.full(s.shape, NONE)
    s[:, :k], p[:, :k] = best[changed], place[changed]
    at = np.repeat(np.arange(len(changed)), counts)
    then = k + np.arange(len(rows)) - np.repeat(begins, counts)
    s[at, then], p[at, then] = scores, columns
    few = np.argpartition(s, k - 1, axis=1)[:, :k]
    limit = np.take_along_axis(s, few, 1).max(axis=1)
    # rows of fewer than k are filled up with infinite scores, which have no place
    tied = np.flatnonzero(((s <= limit[:, None]) & (p < NONE)).sum(axis=1) > (np.take_along_axis(p, few, 1) < NONE).sum(axis=1))
    if len(tied):
        few[tied] = np.lexsort((p[tied], s[tied]), axis=1)[:, :k]
    best[changed], place[changed] = np.take_along_axis(s, few, 1), np.take_along_axis(p, few, 1)
    return changed


def _by_row(found: list[Near]) -> Near:
    rows, columns, scores = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.argsort(rows, kind="stable")
    return rows[order], columns[order], scores[order]


def side_rows(rows: int, numbers: int, blocks: float) -> int:
    """Rows of a block of one side, a row being so many numbers: no more than fit, and no fewer than make it worth a task
    where ``blocks`` of them would do."""
    most = max(1, min(SIDE_ROWS, SIDE_NUMBERS // max(numbers, 1)))
    return min(most, max(LEAST_ROWS, math.ceil(rows / max(blocks, 1))))


def _blocks_of(counts: list[tuple[int, int]], rows: int) -> list[tuple[int, int, int]]:
    """cell, first block, number of blocks: whole cells side by side, larger ones on their own."""
    out, block, filled = [], 0, 0
    for cell, n in counts:
        pieces = -(-n // rows)
        if filled and (pieces > 1 or filled + n > rows):
            block, filled = block + 1, 0
        out.append((cell, block, pieces))
        block, filled = (block + pieces, 0) if pieces > 1 else (block, filled + n)
    return out


def sought_udf(placed: list[tuple[int, int, int]]):
    """cells -> the blocks that hold them, each with those of the cells that it holds."""
    cell, first, pieces = (np.array(c, np.int64) for c in zip(*placed, strict=True))
    kind = pa.struct([("block", pa.int32()), ("cells", pa.list_(pa.int32()))])

    @F.arrow_udf("array<struct<block:int,cells:array<int>>>")
    def sought(lists: pa.Array) -> pa.Array:
        if len(lists) == 0:
            return pa.array([], pa.list_(kind))
        row = pc.list_parent_indices(lists).to_numpy()
        value = lists.flatten().to_numpy().astype(np.int64)
        at = np.searchsorted(cell, value)
        at[at == len(cell)] = 0
        known = cell[at] == value
        row, value, at = row[known], value[known], at[known]
        n = pieces[at]
        block = np.repeat(first[at], n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        row, value = np.repeat(row, n), np.repeat(value, n)
        order = np.lexsort((block, row))
        row, block, value = row[order], block[order], value[order]
        new = np.ones(len(row), bool)
        new[1:] = (row[1:] != row[:-1]) | (block[1:] != block[:-1])
        begins = np.flatnonzero(new)
        inner = pa.ListArray.from_arrays(pa.array(np.append(begins, len(row)).astype(np.int32)), pa.array(value.astype(np.int32)))
        both = pa.StructArray.from_arrays([pa.array(block[begins].astype(np.int32)), inner], fields=list(kind))
        ends = np.concatenate([[0], np.cumsum(np.bincount(row[begins], minlength=len(lists)))])
        return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), both)
    return sought


def blocked_topk(queries: DataFrame, base: DataFrame, k: int, score: Scorer, dimension: int,
                 block_rows: int = 2048, base_numbers: int | None = None) -> DataFrame:
    """``queries`` (query_key, payload, cells, limit), ``base`` (cell, ids, payload), both stored or cheap to read twice ->
    query_key, found: array of (score, neighbour, cell), one row per query and block that has something.

    ``ids`` is the sorted list of ids that share one base payload; ties follow its first id. ``found`` holds the k nearest ids
    of the block and those as near as the last of them. Nothing that scores more than ``limit`` (null: none) counts. A base
    row is as long as ``base_numbers`` (by default ``dimension``) numbers. Base rows are compared ``block_rows`` at a time.
    """
    spark = base.sparkSession
    pairs, numbers = 4 * spark.sparkContext.defaultParallelism, base_numbers or dimension
    base = base.where(F.size("ids") > 0)
    # one row per cell
    counts = sorted((r["cell"], r["n"]) for r in base.groupBy("cell").agg(F.sum(F.size("ids")).alias("n")).collect())
    spread = _schema(queries, base)
    if not counts:
        return spark.createDataFrame([], spread)
    # a query costs its vector and what it brings back per base block, a base row its numbers per block of queries
    placed = _blocks_of(counts, side_rows(sum(n for _, n in counts), numbers, math.sqrt(pairs * numbers / (dimension + 3 * k))))
    asked = queries.withColumn("sought", sought_udf(placed)("cells"))
    # one row per block
    wanted = asked.select(F.explode("sought.block").alias("block")).groupBy("block").agg(F.count("*").alias("n")).collect()
    if not wanted:
        return spark.createDataFrame([], spread)
    rows = side_rows(max(r["n"] for r in wanted), dimension, pairs / len(wanted))
    parts = F.broadcast(spark.createDataFrame([(r["block"], -(-r["n"] // rows)) for r in wanted], "block int, parts int"))
    cells = F.broadcast(spark.createDataFrame(placed, "cell int, first int, pieces int"))
    b = (base.withColumn("cell", F.col("cell").cast("int")).join(cells, "cell")
         .withColumn("block", (F.col("first") + F.pmod(F.xxhash64("ids"), F.col("pieces"))).cast("int")).join(parts, "block")
         .select("block", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "cell", "ids", "payload"))
    q = (asked.select("query_key", "payload", "limit", F.explode("sought").alias("s"))
         .select("query_key", "payload", "limit", F.col("s.block").alias("block"), F.col("s.cells").alias("cells")).join(parts, "block")
         .select("block", F.pmod(F.xxhash64("query_key"), F.col("parts")).cast("int").alias("part"), "query_key", "payload", "limit", "cells"))
    return q.groupBy("block", "part").cogroup(b.groupBy("block", "part")).applyInArrow(_searcher(score, k, block_rows), spread)


def _schema(queries: DataFrame, base: DataFrame) -> str:
    key, one = queries.schema["query_key"].dataType.simpleString(), base.schema["ids"].dataType.elementType.simpleString()
    return f"query_key {key}, found array<struct<score:double,neighbour:{one},cell:int>>"


def _searcher(score: Scorer, k: int, block_rows: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        ids = right["ids"].combine_chunks()
        kind = pa.struct([("score", pa.float64()), ("neighbour", ids.type.value_type), ("cell", pa.int32())])
        if not left.num_rows or not right.num_rows:
            return pa.table({"query_key": left["query_key"].slice(0, 0), "found": pa.array([], pa.list_(kind))})
        by_id = pc.sort_indices(pc.list_element(ids, 0)).to_numpy()
        cell = right["cell"].to_numpy()[by_id]
        place = np.argsort(cell, kind="stable")  # by cell, then by id; its values are places by id
        cell = cell[place]
        taken = pa.array(by_id)
        base = score.base(right["payload"].take(pa.array(by_id[place])))
        asked, limit = matrix(left["payload"]), left["limit"].fill_null(np.inf).to_numpy()
        lists = left["cells"].combine_chunks()
        row, want = pc.list_parent_indices(lists).to_numpy(), lists.flatten().to_numpy()
        order = np.argsort(want, kind="stable")
        row, want = row[order], want[order]
        best, at = np.full((len(asked), k), np.inf), np.full((len(asked), k), NONE)
        limit = limit.copy()
        begins = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]]))
        for a, z in zip(begins, np.append(begins[1:], len(cell)), strict=True):
            seekers = row[np.searchsorted(want, cell[a]):np.searchsorted(want, cell[a], "right")]
            width = min(block_rows, z - a)
            step = max(1, TILE // int(width))
            for i in range(0, len(seekers), step):
                some = seekers[i:i + step]
                rows = score.asked(asked[some], int(cell[a]))
                own, own_at, own_limit, waiting = best[some], at[some], limit[some], []
                for j in range(a, z, width):
                    r, c, s = score.near(rows, tuple(x[j:min(j + width, z)] for x in base), own_limit, k)
                    waiting.append((r, place[j + c], s))
                    if j + width < z and sum(len(w[0]) for w in waiting) < WAITING * k * len(some):
                        continue
                    found = waiting[0] if len(waiting) == 1 else _by_row(waiting)
                    changed = merge(own, own_at, found, k)
                    own_limit[changed] = np.minimum(own_limit[changed], own[changed].max(axis=1))
                    waiting = []
                best[some], at[some], limit[some] = own, own_at, own_limit
        cell_at = np.empty(len(place), cell.dtype)
        cell_at[place] = cell
        return _packed(left["query_key"], best, at, ids.take(taken), cell_at, k, kind)
    return run


def _packed(keys: pa.ChunkedArray, best: np.ndarray, at: np.ndarray, ids: pa.ListArray, cell: np.ndarray, k: int, kind: pa.DataType) -> pa.Table:
    """One row per query that found something, its ids counted up to the k-th and those as near."""
    order = np.lexsort((at, best), axis=1)
    best, at = np.take_along_axis(best, order, 1), np.take_along_axis(at, order, 1)
    sizes = np.append(pc.list_value_length(ids).to_numpy(), 0)
    n = sizes[np.minimum(at, len(ids))]
    before = np.cumsum(n, axis=1) - n
    last = np.where(before < k, best, -np.inf).max(axis=1)
    row, column = np.nonzero((n > 0) & ((before < k) | (best <= last[:, None])))
    place, n = at[row, column], n[row, column]
    flat = ids.take(pa.array(place)).flatten()
    found = pa.StructArray.from_arrays([pa.array(np.repeat(best[row, column], n)), flat, pa.array(np.repeat(cell[place], n).astype(np.int32))],
                                       fields=list(kind))
    per_query = np.bincount(np.repeat(row, n), minlength=len(best))
    some = np.flatnonzero(per_query)
    ends = np.concatenate([[0], np.cumsum(per_query[some])]).astype(np.int32)
    return pa.table({"query_key": keys.take(pa.array(some)), "found": pa.ListArray.from_arrays(pa.array(ends), found)})


def nearest_found(found: DataFrame, k: int) -> DataFrame:
    """query_key, near: the k nearest (score, neighbour, cell) of all its rows, ties by neighbour."""
    whole = found.groupBy("query_key").agg(F.flatten(F.collect_list("found")).alias("near"))
    return whole.select("query_key", F.slice(F.sort_array("near"), 1, k).alias("near"))
