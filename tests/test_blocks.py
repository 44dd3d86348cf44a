"""Block pairs of the searches: what moves, ties, limits."""

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from seqtide.operators import blocks
from seqtide.operators.blocks import Cosine, Euclidean, blocked_topk, merge, nearest_found


def test_a_query_moves_once_per_block_and_not_once_per_cell(spark):
    """Forty cells, all of them sought by every query: they lie in one block, so a query is one row that comes back."""
    rng = np.random.default_rng(2)
    x = rng.normal(size=(200, 8))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    x[100:140] = x[:40]  # equal distances in different cells
    base = spark.createDataFrame([(i % 40, [i], x[i].tolist()) for i in range(200)], "cell int, ids array<long>, payload array<double>")
    asked = spark.createDataFrame([(str(i), x[i].tolist(), list(range(40)), None) for i in range(50)],
                                  "query_key string, payload array<double>, cells array<int>, limit double")
    found = blocked_topk(asked, base, 6, Cosine(), 8, block_rows=3).cache()
    assert found.count() == 50
    d = np.round(1 - x[:50] @ x.T, 12)
    for r in nearest_found(found.withColumn("found", F.transform("found", lambda s: F.struct(
            F.round(s["score"], 12).alias("score"), s["neighbour"].alias("neighbour"), s["cell"].alias("cell")))), 6).collect():
        i = int(r.query_key)
        assert [s.neighbour for s in r.near] == sorted(range(200), key=lambda j: (d[i, j], j))[:6]
        assert all(s.cell == s.neighbour % 40 for s in r.near)
    near = blocked_topk(asked.withColumn("limit", F.lit(0.0) + 1e-9), base, 6, Cosine(), 8).select("query_key", F.explode("found.neighbour").alias("n"))
    assert {(int(q), n) for q, n in near.collect()} == {(i, j) for i in range(50) for j in range(200) if d[i, j] <= 1e-9}


def test_large_cells_are_cut_and_small_ones_put_together():
    assert blocks._blocks_of([(0, 30), (1, 250), (2, 60), (5, 30), (7, 20)], 100) == [(0, 0, 1), (1, 1, 3), (2, 4, 1), (5, 4, 1), (7, 5, 1)]
    # blocks grow with the rows until they hold what a task may hold, so they do not multiply before
    assert blocks.side_rows(10_000, 64, 5) == blocks.LEAST_ROWS and blocks.side_rows(10 ** 9, 64, 5) == blocks.SIDE_NUMBERS // 64


def test_euclidean_pairs_are_measured_by_differences():
    rng = np.random.default_rng(3)
    q, b = rng.normal(size=(30, 5)) + 1e4, rng.normal(size=(40, 5)) + 1e4
    b[:10] = q[:10] + 1e-7
    true = np.sqrt(((q[:, None] - b[None]) ** 2).sum(-1))
    rows, columns, scores = Euclidean().near(q, (b,), np.full(30, np.inf), 4)
    assert np.allclose(scores, true[rows, columns], rtol=1e-12, atol=0)
    kept, place = np.full((30, 4), np.inf), np.full((30, 4), blocks.NONE)
    merge(kept, place, (rows, columns, scores), 4)
    assert all(set(place[i]) == set(np.argsort(true[i])[:4]) for i in range(30))
    limit = np.sort(true, axis=1)[:, 2]
    rows, columns, _ = Euclidean().near(q, (b,), limit, 4)
    assert {(i, j) for i in range(30) for j in np.flatnonzero(true[i] <= limit[i])} <= set(zip(rows.tolist(), columns.tolist()))


def test_few_found_pairs_wait_for_more_before_they_are_merged(monkeypatch):
    """A cell of many tiles, most of which bring next to nothing: merges follow what is found, not the tiles."""
    rng = np.random.default_rng(4)
    x = rng.normal(size=(3000, 6))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    calls = []
    monkeypatch.setattr(blocks, "merge", lambda *a, f=merge: calls.append(1) or f(*a))
    base = pa.table({"ids": pa.array([[i] for i in range(3000)]), "cell": pa.array(np.zeros(3000), pa.int32()), "payload": pa.array(list(x))})
    asked = pa.table({"query_key": pa.array(np.arange(20)), "payload": pa.array(list(x[:20])), "limit": pa.array([None] * 20, pa.float64()),
                      "cells": pa.array([[0]] * 20, pa.list_(pa.int32()))})
    found = blocks._searcher(Cosine(), 40, 50)(asked, base)["found"].to_pylist()
    d = 1 - x[:20] @ x.T
    assert [[s["neighbour"] for s in f] for f in found] == np.argsort(d, axis=1)[:, :40].tolist()
    assert len(calls) < 30  # of 60 tiles


def test_pairs_that_are_measured_do_not_grow_with_the_distance_from_zero():
    """Vectors close together and far from zero: only pairs within the limit come back, and all of those."""
    rng = np.random.default_rng(5)
    q, b = rng.normal(size=(50, 7)) + 1e6, rng.normal(size=(300, 7)) + 1e6
    true = np.sqrt(((q[:, None] - b[None]) ** 2).sum(-1))
    limit = np.sort(true, axis=1)[:, 3] * (1 + 1e-9)
    rows, columns, scores = Euclidean().near(q, (b,), limit, 4)
    assert list(zip(rows.tolist(), columns.tolist())) == [(i, j) for i in range(50) for j in np.flatnonzero(true[i] <= limit[i])]
    assert np.allclose(scores, true[rows, columns], rtol=1e-12, atol=0)


def test_a_tile_is_compared_in_half_the_width():
    """What a task holds per pair: a product of four bytes and its mark."""
    rng = np.random.default_rng(6)
    x = rng.normal(size=(1024, 16))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    for score, limit in ((Cosine(), 0.05), (Euclidean(), 0.3)):
        base = score.base(pa.chunked_array([pa.array(list(x))]))
        tracemalloc.start()
        rows, columns, _ = score.near(x, base, np.full(1024, limit), 5)
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < 10 * 1024 * 1024, (score, peak)
        d = 1 - x @ x.T if isinstance(score, Cosine) else np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
        assert set(zip(rows.tolist(), columns.tolist())) >= set(zip(*(a.tolist() for a in np.nonzero(d <= limit - 1e-12))))


@pytest.mark.parametrize("scale", [1e-160, 1e-25, 1.0, 1e12, 1e20, 1e150])
def test_no_near_pair_is_lost_to_rounding(scale):
    """Clusters a millionth wide, copies and a far point, at any scale, with limits and without."""
    rng = np.random.default_rng(7)
    x = rng.normal(size=(20, 9)).repeat(12, axis=0)
    x += 1e-6 * rng.normal(size=x.shape)
    x[5], x[-1] = x[4], 1e3
    x *= scale
    true = np.sqrt((((x[:, None] - x[None]) / scale) ** 2).sum(-1)) * scale
    kth = np.sort(true, axis=1)[:, 4]
    for limit in (kth * (1 + 1e-9), np.where(np.arange(240) % 2, kth * (1 + 1e-9), np.inf)):
        rows, columns, _ = Euclidean().near(x, (x,), limit, 5)
        assert set(zip(rows.tolist(), columns.tolist())) >= {(i, j) for i in range(240) for j in np.flatnonzero(true[i] <= kth[i])}
    unit = x / scale
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    d = 1 - np.einsum("id,jd->ij", unit, unit)
    near = np.sort(d, axis=1)[:, 4] + 1e-15
    score = Cosine()
    rows, columns, _ = score.near(unit, score.base(pa.chunked_array([pa.array(list(unit))])), near, 5)
    assert set(zip(rows.tolist(), columns.tolist())) >= {(i, j) for i in range(240) for j in np.flatnonzero(d[i] <= near[i] - 2e-15)}


def test_set_flags_are_found_in_order():
    for n in (0, 5, 8, 29, 64):
        for share in (0.0, 0.2, 1.0):
            flags = np.random.default_rng(n).random(n) < share
            assert blocks._set(flags).tolist() == np.flatnonzero(flags).tolist()
