"""Forest, hierarchy and labels against a sequential re-statement in numpy."""

import numpy as np
import pytest

from seqtide.operators import density
from seqtide.operators.graph import components, spanning_forest


def kruskal(edges):
    parent = {}

    def find(v):
        while parent.setdefault(v, v) != v:
            v = parent[v]
        return v
    out = []
    for w, a, b in sorted((w, a, b) for a, b, w in edges):
        x, y = find(a), find(b)
        if x != y:
            parent[x] = y
            out.append((a, b, w))
    return sorted(out)


def test_forest_and_components(spark):
    rng = np.random.default_rng(0)
    edges = {(int(min(a, b)), int(max(a, b))): float(rng.integers(1, 9)) for a, b in rng.integers(0, 70, (90, 2)) if a != b}
    rows = [(a, b, w) for (a, b), w in edges.items()]
    df = spark.createDataFrame(rows, "a long, b long, w double")
    assert sorted((r["a"], r["b"], r["w"]) for r in spanning_forest(df).collect()) == kruskal(rows)
    comp = {r["v"]: r["component"] for r in components(spark.range(70).withColumnRenamed("id", "v"), df).collect()}
    assert len(comp) == 70 and all(comp[a] == comp[b] for a, b, _ in rows)
    assert len(set(comp.values())) == 70 - len(kruskal(rows)) and all(comp[c] == c for c in comp.values())


def test_long_path_is_one_component(spark):
    path = spark.range(300).selectExpr("(id * 37) % 301 as a", "((id + 1) * 37) % 301 as b")
    comp = components(spark.range(301).withColumnRenamed("id", "v"), path)
    assert comp.select("component").distinct().count() == 1


def condensed_labels(n, forest, mcs):
    """Top-down: cut the tallest edges first; small splits are points leaving the cluster."""
    members, tree, label = {}, {}, {}
    counter = [0]

    def parts(nodes, edges):
        adj = {v: [] for v in nodes}
        for a, b, _ in edges:
            adj[a].append(b)
            adj[b].append(a)
        seen, out = set(), []
        for v in nodes:
            if v not in seen:
                todo, comp = [v], set()
                while todo:
                    u = todo.pop()
                    if u not in comp:
                        comp.add(u)
                        todo += adj[u]
                seen |= comp
                out.append(comp)
        return [(c, [e for e in edges if e[0] in c]) for c in out]

    def grow(nodes, edges, birth, parent):
        me = counter[0]
        counter[0] += 1
        tree[me] = dict(parent=parent, birth=birth, stability=0.0, deepest=0.0)
        while True:
            top = max(w for *_, w in edges)
            lam = 1 / top
            split = parts(nodes, [e for e in edges if e[2] < top])
            big = [p for p in split if len(p[0]) >= mcs]
            for c, _ in split:
                if len(c) < mcs:
                    for v in c:
                        members[v] = (me, lam)
                        tree[me]["stability"] += lam - birth
                        tree[me]["deepest"] = max(tree[me]["deepest"], lam)
            if len(big) == 1:
                nodes, edges = big[0]
                continue
            for c, e in big:
                tree[me]["stability"] += (lam - birth) * len(c)
                tree[me]["deepest"] = max(tree[me]["deepest"], lam)
                grow(c, e, lam, me)
            return
    roots = [p for p in parts(range(n), forest) if len(p[0]) >= mcs]
    for nodes, edges in roots:
        grow(nodes, edges, 0.0, None)
    alone = len(roots) == 1
    kids = {c: [k for k in tree if tree[k]["parent"] == c] for c in tree}
    value, wins = {}, {}
    for c in sorted(tree, reverse=True):
        below = sum(value[k] for k in kids[c])
        wins[c] = tree[c]["stability"] >= below and not (alone and tree[c]["parent"] is None)
        value[c] = tree[c]["stability"] if wins[c] else below
    for v in range(n):
        label[v] = (None, 0.0)
        if v in members:
            c, lam = members[v]
            owner = None
            while c is not None:
                owner = c if wins[c] else owner
                c = tree[c]["parent"]
            if owner is not None:
                label[v] = (owner, min(lam, tree[owner]["deepest"]) / tree[owner]["deepest"])
    return label


def blobs(seed, bridge):
    rng = np.random.default_rng(seed)
    parts = [rng.normal(size=(40, 2)) * .3, rng.normal(size=(30, 2)) * .25 + [4, 0], rng.normal(size=(35, 2)) * .5 + [2, 5],
             rng.uniform(-6, 9, size=(15, 2))]
    if bridge:
        parts.append(np.stack([np.linspace(0, 4, 12), np.zeros(12)], axis=1))
    return np.concatenate(parts)


@pytest.mark.parametrize("seed,bridge,k", [(0, False, 12), (1, True, 12), (2, True, 5)])
def test_labels_match_the_sequential_rule(spark, seed, bridge, k):
    x = blobs(seed, bridge)
    n = len(x)
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    order = np.argsort(d + np.eye(n) * 1e9, axis=1)[:, :k]
    core = np.sort(d + np.eye(n) * 1e9, axis=1)[:, 3]
    edges = {(min(i, j), max(i, j)): max(core[i], core[j], d[i, j]) for i in range(n) for j in order[i]}
    forest = kruskal([(int(a), int(b), float(w)) for (a, b), w in edges.items()])
    points = spark.createDataFrame([(i, [float(a) for a in p]) for i, p in enumerate(x)], "id long, coords array<double>")
    want = condensed_labels(n, forest, 10)
    tree = density.hierarchy(points, spark.createDataFrame(forest, "a long, b long, w double"), 10, levels=None)
    got = {r["id"]: (r["cluster_id"], r["cluster_probability"]) for r in density.labels(points, tree).collect()}
    pairs = {(want[i][0], got[i][0]) for i in range(n)}
    assert len({a for a, _ in pairs}) == len(pairs) == len({b for _, b in pairs})  # same partition
    assert all((want[i][0] is None) == (got[i][0] == -1) for i in range(n))
    assert all(abs(want[i][1] - got[i][1]) < 1e-5 for i in range(n))
    assert len({v for v, _ in want.values() if v is not None}) >= 2


@pytest.mark.parametrize("lot", [1 << 18, 40])
def test_hierarchy_sees_every_weight(spark, monkeypatch, lot):
    """By default no cluster between two quantiles is lost; lots and equal weights change nothing."""
    monkeypatch.setattr(density, "MERGES", lot)
    rng = np.random.default_rng(5)
    n = 150
    forest = kruskal([(int(min(v, u)), int(max(v, u)), float(rng.integers(1, 4000)) / 16 if v % 5 else 3.0)
                      for v in range(1, n) for u in [int(rng.integers(max(v - 6, 0), v))]])
    want = condensed_labels(n, forest, 3)
    tree = density.hierarchy(spark.range(n), spark.createDataFrame(forest, "a long, b long, w double"), 3)
    got = {r["id"]: (r["cluster_id"], r["cluster_probability"]) for r in density.labels(spark.range(n), tree).collect()}
    pairs = {(want[i][0], got[i][0]) for i in range(n)}
    assert len({a for a, _ in pairs}) == len(pairs) == len({b for _, b in pairs}) > 2
    assert all(abs(want[i][1] - got[i][1]) < 1e-5 for i in range(n))


def test_too_few_points_are_noise(spark):
    points = spark.createDataFrame([(i, [float(i), 0.0]) for i in range(8)], "id long, coords array<double>")
    got = density.density_clusters(points, min_samples=2, min_cluster_size=20).collect()
    assert len(got) == 8 and all(r["cluster_id"] == -1 and r["cluster_probability"] == 0 for r in got)


def test_grid_levels_find_the_blobs(spark):
    rng = np.random.default_rng(9)
    x = np.concatenate([rng.normal(size=(60, 3)) * .2 + c for c in ([0, 0, 0], [5, 0, 0], [0, 5, 0])])
    points = spark.createDataFrame([(i, [float(a) for a in p]) for i, p in enumerate(x)], "id long, coords array<double>")
    got = {r["id"]: r["cluster_id"] for r in density.density_clusters(points, min_samples=3, min_cluster_size=15, levels=32).collect()}
    assert all(len({got[i] for i in range(s, s + 60)} - {-1}) == 1 for s in (0, 60, 120))
    assert len(set(got.values()) - {-1}) == 3
