import numpy as np
import pytest
from pyspark.sql import functions as F

from seqtide.operators import ivf, manifold
from seqtide.operators.knn import exact_knn


def frame(spark, x):
    return spark.createDataFrame([(i, [float(a) for a in row]) for i, row in enumerate(x)], "id long, embedding array<double>")


def brute(q, b, k, metric, skip_self):
    if metric == "cosine":
        q, b = (m / np.linalg.norm(m, axis=1, keepdims=True) for m in (q, b))
        d = 1 - q @ b.T
    else:
        d = np.sqrt(((q[:, None] - b[None]) ** 2).sum(-1))
    out = {}
    for i, row in enumerate(d):
        order = sorted((j for j in range(len(b)) if not (skip_self and i == j)), key=lambda j: (round(row[j], 10), j))
        out[i] = order[:k]
    return out


@pytest.mark.parametrize("metric,pivots,block,skip", [
    ("cosine", None, 2048, False), ("cosine", 12, 32, True), ("euclidean", 12, 16, False), ("euclidean", 1, 50, True),
    ("cosine", 300, 2048, False)])
def test_exact_knn(spark, metric, pivots, block, skip):
    """Small blocks and many pivots take the way large tables take; a third are copies."""
    rng = np.random.default_rng(5)
    x = np.concatenate([rng.normal(size=(120, 6)), rng.normal(size=(80, 6)) * .1 + 3, np.tile(rng.normal(size=6), (100, 1))])
    df = frame(spark, x)
    got = exact_knn(df, df, 7, query_id="id", base_id="id", metric=metric, pivots=pivots, block_rows=block, exclude_self=skip)
    found = {}
    for r in got.orderBy("query_id", "rn").collect():
        found.setdefault(r["query_id"], []).append(r["neighbour_id"])
    assert found == brute(x, x, 7, metric, skip)


def test_few_base_rows(spark):
    x = np.eye(3)
    got = exact_knn(frame(spark, x), frame(spark, x), 10, query_id="id", base_id="id").groupBy("query_id").count().collect()
    assert all(r["count"] == 3 for r in got)


def test_zero_and_broken_vectors_are_left_out(spark):
    df = spark.createDataFrame([(0, [0.0, 0.0]), (1, [1.0, 0.0]), (2, [float("nan"), 1.0]), (3, [1.0, 1.0])], "id long, embedding array<double>")
    got = exact_knn(df, df, 5, query_id="id", base_id="id").select("query_id").distinct().collect()
    assert sorted(r[0] for r in got) == [1, 3]


def test_index_recall_and_full_probe(spark):
    rng = np.random.default_rng(1)
    x = np.repeat(rng.normal(size=(10, 32)) * 2, 40, axis=0) + rng.normal(size=(400, 32))
    df = frame(spark, x)
    cent = ivf.train_cells(df, 8, seed=1)
    index = ivf.build_index(df, cent, 32, seed=1).cache()
    exact = exact_knn(df, df, 10, query_id="id", base_id="id")
    some = ivf.search(df, index, cent, 10, query_id="id", base_id="id", dimension=32, probes=3, refine=6, seed=1)
    assert ivf.recall(some, exact).first()["recall"] > 0.8
    # all cells and a shortlist as long as the table leave nothing out
    every = ivf.search(df, index, cent, 10, query_id="id", base_id="id", dimension=32, probes=8, refine=40, seed=1, block_rows=64)
    assert ivf.recall(every, exact).first()["worst"] == 1.0


def test_rotation_is_orthogonal_and_seeded():
    a, b = ivf.rotation(24, 3), ivf.rotation(24, 3)
    assert np.allclose(a @ a.T, np.eye(24)) and (a == b).all()


def test_curve():
    a, b = manifold.curve(0.0)
    assert abs(a - 1.93) < 0.02 and abs(b - 0.79) < 0.01


def test_layout_keeps_neighbourhoods(spark):
    rng = np.random.default_rng(2)
    x = np.repeat(np.eye(6) * 4, 30, axis=0)[:, :6] + rng.normal(size=(180, 6)) * .3
    df = frame(spark, x)
    near = exact_knn(df, df, 10, query_id="id", base_id="id", exclude_self=True)
    graph = manifold.fuzzy_graph(near, 10)
    rows = manifold.layout(df, graph, dims=3, epochs=6).orderBy("id").collect()
    again = manifold.layout(df.repartition(3), graph.repartition(5), dims=3, epochs=6).orderBy("id").collect()
    y = np.array([r["coords"] for r in rows])
    assert np.allclose(y, np.array([r["coords"] for r in again]), atol=1e-6)
    d = ((y[:, None] - y[None]) ** 2).sum(-1) + np.eye(180) * 1e9
    assert np.mean(np.argsort(d, 1)[:, :5] // 30 == np.arange(180)[:, None] // 30) > 0.95


def test_memberships_sum_to_log2k(spark):
    rng = np.random.default_rng(4)
    df = frame(spark, rng.normal(size=(80, 5)))
    near = exact_knn(df, df, 8, query_id="id", base_id="id", exclude_self=True)
    sums = manifold.memberships(near, 8).groupBy("query_id").agg(F.sum("weight").alias("w")).collect()
    assert all(abs(r["w"] - 3) < 1e-4 for r in sums)


def test_index_of_derived_vectors(spark):
    """Vectors that are themselves lambda expressions, and only the cell is asked for."""
    df = frame(spark, np.random.default_rng(3).normal(size=(50, 8))).select(
        "id", F.transform("embedding", lambda x: x * 2).alias("embedding"))
    cent = ivf.train_cells(df, 4, seed=1)
    assert ivf.assign_cells(df, cent).groupBy("cell").count().agg(F.sum("count")).first()[0] == 50
    assert ivf.quantise(df, 8, seed=1).select("code").distinct().count() > 10


def test_estimate_is_better_than_the_sign_distance():
    import pyarrow as pa
    rng = np.random.default_rng(6)
    x = ivf.unit(rng.normal(size=(300, 100)))
    q = ivf.unit(rng.normal(size=(20, 100)))
    bits = (x > 0).astype(np.uint8)
    words = np.packbits(np.pad(bits, ((0, 0), (0, 28))), axis=1, bitorder="little").view("<i8")
    align = np.abs(x).sum(axis=1) / 10
    base = pa.StructArray.from_arrays([pa.array(words.tolist(), pa.list_(pa.int64())), pa.array(align)], ["code", "align"])
    got = ivf.estimates(pa.array(q.tolist()), base)
    exact, plain = 1 - q @ x.T, 1 - q @ (np.where(x > 0, 1, -1) / 10).T
    assert np.abs(got - exact).mean() < 0.1 and np.corrcoef(got.ravel(), exact.ravel())[0, 1] > 0.7
    assert np.allclose(got, 1 - (1 - plain) / align[None, :])


def test_nearest_few_equals_a_full_sort():
    rng = np.random.default_rng(0)
    for top in (1000, 3):
        d = rng.integers(0, top, (50, 30)).astype(float)
        for few in (1, 4, 29, 30, 40):
            assert (ivf.nearest_few(d, few) == np.argsort(d, axis=1, kind="stable")[:, :few]).all()


def test_one_lookup_reads_only_probed_cells(spark, tmp_path):
    """Files of other cells may even be gone."""
    import shutil
    rng = np.random.default_rng(1)
    x = np.repeat(rng.normal(size=(6, 16)) * 3, 30, axis=0) + rng.normal(size=(180, 16))
    df, path = frame(spark, x), str(tmp_path / "index")
    cent = ivf.train_cells(df, 6, seed=1)
    ivf.build_index(df, cent, 16, seed=1).write.partitionBy("cell").parquet(path)
    index, one = spark.read.parquet(path), df.where("id = 7")
    options = dict(query_id="id", base_id="id", dimension=16, probes=1, seed=1)
    want = ivf.lookup(one, index, cent, 5, **options).orderBy("rn").collect()
    home = ivf.assign_cells(one, cent).first()["cell"]
    for cell in range(6):
        if cell != home:
            for file in (tmp_path / "index" / f"cell={cell}").glob("*.parquet"):
                file.unlink()
    assert ivf.lookup(one, index, cent, 5, **options).orderBy("rn").collect() == want and len(want) == 5
    shutil.rmtree(path)


def clustered(spark, n=240, d=16, seed=1):
    rng = np.random.default_rng(seed)
    return frame(spark, np.repeat(rng.normal(size=(6, d)) * 3, n // 6, axis=0) + rng.normal(size=(n, d)))


def test_one_vector_in_one_job_equals_the_search(spark, tmp_path):
    df = clustered(spark)
    cent = ivf.train_cells(df, 6, seed=1)
    ivf.build_index(df.withColumn("name", F.concat(F.lit("v"), "id")), cent, 16, seed=1).write.partitionBy("cell").parquet(str(tmp_path / "i"))
    index = spark.read.parquet(str(tmp_path / "i"))
    options = dict(base_id="id", dimension=16, probes=3, refine=2, seed=1)
    for one in df.where("id in (7, 100)").collect():
        found = ivf.lookup_vector(np.array(one["embedding"]), index, cent, 5, **options).collect()
        want = ivf.search(df.where(F.col("id") == one["id"]), index, cent, 5, query_id="id", **options).orderBy("rn").collect()
        assert [(r.id, r.rn) for r in found] == [(r.neighbour_id, r.rn) for r in want] and found[0].name == f"v{found[0].id}"
        assert np.allclose([r._distance for r in found], [r.distance for r in want])
    assert ivf.lookup_vector(np.zeros(16), index, cent, 5, **options).count() == 0
    assert ivf.lookup_vector(np.full(16, np.nan), index, cent, 5, **options).count() == 0


def test_appended_index_equals_one_build(spark, tmp_path):
    from seqtide.operators.index_table import IndexTable
    df = clustered(spark)
    cent = ivf.train_cells(df, 6, seed=1)
    table = IndexTable(spark, str(tmp_path / "t"), cent, 16, key="id", seed=1)
    table.append(df.where("id < 90"))
    broken = spark.createDataFrame([(900, [0.0] * 16), (901, [float("nan")] * 16), (None, [1.0] * 16)], "id long, embedding array<double>")
    table.append(df.where("id % 2 = 0 or id >= 80").unionByName(df.where("id > 200")).unionByName(broken))
    table.append(df)  # nothing new
    assert sorted(r.id for r in table.vectors.select("id").collect()) == list(range(240))
    assert sorted(r.id for r in table.codes.select(F.explode("ids").alias("id")).collect()) == list(range(240))
    want = ivf.search(df, ivf.build_index(df, cent, 16, seed=1), cent, 7, query_id="id", base_id="id", dimension=16, probes=3, seed=1)
    got = table.search(df, 7, probes=3)
    assert sorted(map(tuple, got.select("query_id", "neighbour_id", "rn").collect())) == sorted(
        map(tuple, want.select("query_id", "neighbour_id", "rn").collect()))
    with pytest.raises(ValueError):
        table.search(df, ivf.STORED_IDS, refine=4)


def test_rerank_groups_are_bounded_by_pairs(spark):
    """1024 dimensions, 30 neighbours and the query itself, refine 4: one cell, and a hub all queries share."""
    pairs = spark.range(6000).select(F.lit(0).alias("cell"), F.col("id").alias("query_key"), F.explode(F.sequence(F.lit(0), F.lit(123))).alias("j")).select(
        "cell", "query_key", F.when(F.col("j") == 0, 0).otherwise(F.pmod(F.xxhash64("query_key", "j"), F.lit(40_000))).alias("neighbour"))
    placed = ivf.rerank_blocks(pairs, 2048, 1024)
    worst = placed.groupBy("cell", "block", "part").agg(F.count("*").alias("n"), F.countDistinct("query_key").alias("q"),
                                                        F.countDistinct("neighbour").alias("b")).agg(F.max("n"), F.max(F.col("q") + F.col("b"))).first()
    assert worst[0] <= 1.5 * ivf.RERANK_PAIRS and worst[1] * 1024 <= 1.5 * ivf.RERANK_NUMBERS


def test_recall_bound(spark):
    exact = spark.createDataFrame([(q, n) for q in range(20) for n in range(10)], "query_id long, neighbour_id long")
    row = ivf.recall_bound(exact.where("query_id > 0 or neighbour_id > 3"), exact).first()
    assert (row.queries, row.neighbours, row.recall) == (20, 200, 0.98) and 0.94 < row.lower < 0.96


def test_trustworthiness(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(90, 5))
    y = rng.normal(size=(90, 2)) + x[:, :2]
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    truth = np.argsort(np.argsort(1 - u @ u.T + np.diag(np.full(90, -9.0)), axis=1), axis=1)  # 0: itself
    d = ((y[:, None] - y[None]) ** 2).sum(-1) + np.eye(90) * 1e9
    lost = sum(max(truth[i, j] - 6, 0) for i in range(90) for j in np.argsort(d[i])[:6])
    laid = spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(y)], "id long, coords array<double>")
    near = exact_knn(laid, laid, 6, query_id="id", base_id="id", vector="coords", metric="euclidean", exclude_self=True)
    got = manifold.trustworthiness(frame(spark, x), laid, near, 6).first()
    assert got.judged == 90 and abs(got.trustworthiness - (1 - 2 * lost / (90 * 6 * (180 - 18 - 1)))) < 1e-9
    assert manifold.trustworthiness(frame(spark, x), laid, near, 6, judged=20).first().judged == 20


def test_euclidean_index(spark):
    """Offsets from the cell: vectors of very different length, far from the origin, some of them on a centroid."""
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(6, 24)) * 5 + 100
    x = np.repeat(centres, 40, axis=0) + rng.normal(size=(240, 24)) * np.repeat([.1, .3, 1, 1, 2, 4], 40)[:, None]
    x[0], x[5] = 0, x[4]
    df = frame(spark, x)
    cent = ivf.train_cells(df, 6, seed=1, metric="euclidean")
    index = ivf.build_index(df, cent, 24, seed=1, metric="euclidean").cache()
    exact = exact_knn(df, df, 10, query_id="id", base_id="id", metric="euclidean")
    options = dict(query_id="id", base_id="id", dimension=24, seed=1, metric="euclidean")
    assert ivf.recall(ivf.search(df, index, cent, 10, probes=3, refine=3, **options), exact).first()["recall"] > 0.9
    every = ivf.search(df, index, cent, 10, probes=6, refine=24, **options)
    assert ivf.recall(every, exact).first()["worst"] == 1.0
    got = {(r.query_id, r.neighbour_id): r.distance for r in every.collect()}
    assert all(abs(d - np.linalg.norm(x[a] - x[b])) < 1e-9 for (a, b), d in got.items())


def test_squared_estimates(spark):
    import pyarrow as pa
    rng = np.random.default_rng(4)
    v, q = rng.normal(size=(200, 128)), rng.normal(size=(9, 128))
    words = np.packbits((v > 0).astype(np.uint8), axis=1, bitorder="little").view("<i8")
    length = np.linalg.norm(v, axis=1)
    base = pa.StructArray.from_arrays([pa.array(words.tolist(), pa.list_(pa.int64())), pa.array(np.abs(v).sum(1) / np.sqrt(128) / length),
                                       pa.array(length)], ["code", "align", "norm"])
    got = ivf.squared_estimates(pa.array(q.tolist()), base)
    exact = ((q[:, None] - v[None]) ** 2).sum(-1)
    assert np.corrcoef(got.ravel(), exact.ravel())[0, 1] > 0.8 and abs((got - exact).mean()) < 4
