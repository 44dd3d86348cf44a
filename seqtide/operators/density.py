"""Density clusters: core distance, mutual reachability, hierarchy, labels, probabilities."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqtide.operators.graph import components, roots, spanning_forest
from seqtide.operators.knn import exact_knn
from seqtide.operators.skew import dense_index, salted_join
from seqtide.session import Rounds, materialise


def core_distances(neighbours: DataFrame, min_samples: int) -> DataFrame:
    """query_id, core: distance to the ``min_samples``-th neighbour other than itself.

    Points with fewer neighbours have none and are left out.
    """
    return neighbours.where(F.col("rn") == min_samples).select(
        F.col("query_id").alias("id"), F.col("distance").alias("core"))


def mutual_reachability(neighbours: DataFrame, cores: DataFrame) -> DataFrame:
    """Undirected edges a < b with w = max(core a, core b, distance)."""
    edges = (neighbours.where(F.col("query_id") != F.col("neighbour_id"))
             .groupBy(F.least("query_id", "neighbour_id").alias("a"),
                      F.greatest("query_id", "neighbour_id").alias("b"))
             .agg(F.min("distance").alias("distance")))
    edges = materialise(edges, "pairs")
    weights = edges.groupBy("b").agg(F.count("*").alias("n"))
    with_a = salted_join(edges, cores.select(F.col("id").alias("a"), F.col("core").alias("core_a")), "a",
                         stored=True)
    with_b = salted_join(with_a, cores.select(F.col("id").alias("b"), F.col("core").alias("core_b")), "b",
                         weights=weights)
    return with_b.select("a", "b", F.greatest("core_a", "core_b", "distance").alias("w"))


def radius_clusters(points: DataFrame, cores: DataFrame, edges: DataFrame, radius: float) -> DataFrame:
    """id, cluster (smallest core id, -1 for noise): the flat clusters at one radius."""
    core = cores.where(F.col("core") <= radius).select(F.col("id").alias("v"))
    found = components(core, edges.where(F.col("w") <= radius).select("a", "b"))
    return points.select("id").join(found.withColumnRenamed("v", "id"), "id", "left").select(
        "id", F.coalesce("component", F.lit(-1)).alias("cluster"))


def levels_of(forest: DataFrame, levels: int) -> DataFrame:
    """g, dist: quantiles of the weights, ascending, at most ``levels`` + 1."""
    cuts = [i / levels for i in range(levels + 1)]
    picked = forest.agg(F.array_distinct(F.array_sort(F.expr(
        f"percentile_approx(w, array({', '.join(map(str, cuts))}), 10000)"))).alias("d"))
    return picked.select(F.posexplode("d").alias("g", "dist"))


#: Edges that one group merges one after another.
MERGES = 1 << 18

_MERGED = "g long, component long, up_g long, up_component long, w double, size long"


def _merge(edges: pa.Table) -> pa.Table:
    """Merges of the edges by rank: both parts of each, named as given or by the merge they come from."""
    parent: dict[int, int] = {}
    state: dict[int, tuple[int, int]] = {}

    def find(c: int) -> int:
        while parent[c] != c:
            parent[c] = parent[parent[c]]
            c = parent[c]
        return c
    out: list[tuple] = []
    columns = [edges.sort_by("rank").column(c).to_pylist() for c in ("rank", "w", "a", "a_g", "a_n", "b", "b_g", "b_n")]
    for rank, w, a, a_g, a_n, b, b_g, b_n in zip(*columns, strict=True):
        for c, g, n in ((a, a_g, a_n), (b, b_g, b_n)):
            if c not in parent:
                parent[c], state[c] = c, (g, n)
        x, y = sorted((find(a), find(b)))
        size = state[x][1] + state[y][1]
        out += [(state[c][0], c, rank, x, w, size) for c in (x, y)]
        parent[y], state[x] = x, (rank, size)
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.int64())
    return pa.table([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)],
                    names=[c.split()[0] for c in _MERGED.split(", ")])


def _contract(edges: DataFrame, bit: int) -> DataFrame:
    """Ends of the heavier half of each range of lots become the components of its lighter half.

    A range is the lots that share all bits above ``bit``; the bit itself tells the halves.
    """
    heavy = (F.shiftright("lot", bit) % 2) == 1
    spans = edges.withColumn("span", F.shiftright("lot", bit + 1))
    light = materialise(spans.where(~heavy), "light")
    ends = [light.select("span", F.col(e).alias("v"), F.col(f"{e}_n").alias("n")) for e in "ab"]
    vertices = materialise(ends[0].unionByName(ends[1]).distinct(), "ends")
    found = materialise(components(vertices.select("span", "v"), light.select("span", "a", "b"), ["span"]), "light-components")
    # the light edges are a forest: what a component holds follows from its vertices and the last of its edges
    sizes = found.join(vertices, ["span", "v"]).groupBy("span", "component").agg(F.sum("n").alias("size"))
    last = salted_join(light.select("span", F.col("a").alias("v"), "rank"), found, ["span", "v"]).groupBy("span", "component").agg(
        F.max("rank").alias("g"))
    known = materialise(sizes.join(last, ["span", "component"]), "contracted")
    to = materialise(salted_join(found, known, ["span", "component"], stored=True), "relabelled")
    moved = spans.where(heavy)
    for end in "ab":
        name = to.select("span", F.col("v").alias(end), "component", "g", "size")
        others = [c for c in moved.columns if c not in (end, f"{end}_g", f"{end}_n")]
        moved = salted_join(moved, name, ["span", end], "left").select(
            *others, F.coalesce("component", end).alias(end), F.coalesce("g", f"{end}_g").alias(f"{end}_g"),
            F.coalesce("size", f"{end}_n").alias(f"{end}_n"))
    return light.drop("span").unionByName(moved.drop("span"))


def dendrogram(forest: DataFrame, lot: int | None = None) -> DataFrame:
    """g, component, up_g, up_component, w, size: every part of every merge, what it becomes, and the weight and size of that.

    A part is named by the rank of its last edge (-1 for a point) and its smallest point. The edges
    are ranked by (w, a, b) and cut into lots of ``lot`` (by default ``MERGES``). Halving the range of lots again and
    again, the ends of the heavier half are replaced by the components of the lighter half, in all
    ranges at once: after log2(lots) steps no lot depends on another, and all are merged side by side.
    """
    spark, rounds, lot = forest.sparkSession, Rounds(forest.sparkSession, "lots"), lot or MERGES
    ranked = dense_index(forest.select("w", "a", "b"), ["w", "a", "b"], "rank")
    one, point = F.lit(1).cast("long"), F.lit(-1).cast("long")
    edges = rounds.keep(ranked.select(
        F.floor(F.col("rank") / lot).cast("long").alias("lot"), F.col("rank").cast("long").alias("rank"), F.col("w").cast("double").alias("w"),
        "a", point.alias("a_g"), one.alias("a_n"), "b", point.alias("b_g"), one.alias("b_n")))
    last = edges.agg(F.max("lot")).first()[0]
    if last is None:
        return spark.createDataFrame([], _MERGED)
    for bit in reversed(range(int(last).bit_length())):
        edges = rounds.keep(_contract(edges, bit))
    return edges.groupBy("lot").applyInArrow(_merge, _MERGED)


def _exact_nodes(forest: DataFrame, min_cluster_size: int, lot: int | None = None) -> tuple[DataFrame, DataFrame]:
    """``nodes`` (node, up, size, dist): large components at the weights where they change;
    ``entry`` (id, node, dist): the first large component of each point."""
    merges = materialise(dendrogram(forest, lot), "dendrogram")
    up = F.struct(F.col("up_g").alias("g"), F.col("up_component").alias("component"))
    parts = materialise(merges.select(F.struct("g", "component").alias("node"), up.alias("up"), "w", "size"), "parts")
    whole = parts.groupBy(F.col("up").alias("node")).agg(F.first("w").alias("dist"), F.first("size").alias("size"))
    chained = materialise(whole.join(parts.select("node", "up", F.col("w").alias("up_dist")), "node", "left"), "whole")
    # merges of one weight are one; below the size a component leads to the first large one
    onward = F.col("up").isNotNull() & ((F.col("up_dist") == F.col("dist")) | (F.col("size") < min_cluster_size))
    stands = materialise(roots(chained.select(F.col("node").alias("v"), F.when(onward, F.col("up")).otherwise(F.col("node")).alias("p"))), "stands")
    large = chained.where((F.col("size") >= min_cluster_size) & ~onward)
    above = stands.select(F.col("v").alias("up"), F.col("root").alias("above"))
    nodes = materialise(large.join(above, "up", "left").select("node", F.col("above").alias("up"), "size", "dist"), "nodes")
    points = parts.where(F.col("node.g") == -1).select(F.col("node.component").alias("id"), F.col("up").alias("v"))
    entry = points.join(stands, "v").select("id", F.col("root").alias("node")).join(nodes.select("node", "dist"), "node")
    return nodes, materialise(entry, "entry")


def _grid_nodes(forest: DataFrame, min_cluster_size: int, levels: int) -> tuple[DataFrame, DataFrame]:
    """As ``_exact_nodes``, but only at quantiles of the weights, as one component job keyed by (cut, vertex)."""
    cut = materialise(levels_of(forest, levels), "cuts")
    last = cut.count() - 1
    dist = F.array(*[F.lit(r["dist"]) for r in cut.orderBy("g").collect()])  # <= levels + 1
    first = forest.select("a", "b", F.size(F.filter(dist, lambda d: d < F.col("w"))).alias("g"))
    # an edge is part of every cut from its own weight up
    edges = materialise(first.select("a", "b", F.explode(F.sequence("g", F.lit(last))).alias("g")), "cutedges")
    # vertices without an edge are alone at that cut, so never in a large component
    vertices = (edges.select("g", F.col("a").alias("v"))
                .unionByName(edges.select("g", F.col("b").alias("v"))).distinct())
    comp = materialise(components(vertices, edges, ["g"]), "levels")
    big = materialise(comp.groupBy("g", "component").agg(F.count("*").alias("size"))
                      .where(F.col("size") >= min_cluster_size), "big")
    # a node is a large component at a cut; its parent is the component one cut up
    up = comp.select((F.col("g") - 1).alias("g"), F.col("v").alias("component"),
                     F.col("component").alias("up"))
    nodes = big.join(up, ["g", "component"], "left").join(F.broadcast(cut), "g").select(
        F.struct("g", "component").alias("node"), F.when(F.col("up").isNotNull(), F.struct(
            (F.col("g") + 1).alias("g"), F.col("up").alias("component"))).alias("up"), "size", "dist")
    # first cut at which a point is inside a large component
    inside = comp.join(big.select("g", "component"), ["g", "component"], "left_semi")
    entry = inside.groupBy(F.col("v").alias("id")).agg(
        F.min_by(F.struct("g", "component"), "g").alias("node"))
    return materialise(nodes, "nodes"), entry.withColumn("g", F.col("node.g")).join(F.broadcast(cut), "g").drop("g")


def hierarchy(points: DataFrame, forest: DataFrame, min_cluster_size: int,
              levels: int | None = None, lot: int | None = None) -> dict[str, DataFrame]:
    """The condensed tree of a spanning forest.

    It is exact, from every merge of the forest; with ``levels`` it only sees a grid of that many
    quantiles of the weights. ``lot`` edges are merged in one group. Returns
    ``clusters`` (cluster, parent, birth, root, size, stability, deepest) and ``members``
    (id, cluster, lam): the cluster each point leaves and the density lam = 1 / distance at which it
    leaves. Points that never join a large component are absent from ``members``.
    Separate trees of the forest count as joined at infinite distance.
    """
    if min_cluster_size < 2:
        raise ValueError("min_cluster_size must be at least 2")
    nodes, entry = _exact_nodes(forest, min_cluster_size, lot) if levels is None else _grid_nodes(forest, min_cluster_size, levels)
    children = nodes.where(F.col("up").isNotNull()).groupBy(F.col("up").alias("node")).agg(F.count("*").alias("kids"))
    nodes = materialise(nodes.join(children, "node", "left").withColumn("kids", F.coalesce("kids", F.lit(0))), "chained")
    # a node with exactly one large child continues that child's cluster
    head = nodes.select(F.col("node").alias("up"), F.col("kids").alias("up_kids"), F.col("dist").alias("up_dist"))
    linked = nodes.join(head, "up", "left").withColumn("continues", F.col("up_kids") == 1)
    pointers = linked.select(F.col("node").alias("v"), F.when(
        F.col("continues"), F.col("up")).otherwise(F.col("node")).alias("p"))
    chain = materialise(roots(pointers), "chains").select(
        F.col("v").alias("node"), F.col("root").alias("cluster"))

    def density(dist: str) -> Column:
        return F.when(F.col(dist) > 0, 1 / F.col(dist)).when(F.col(dist) <= 0, F.lit(float("1e300")))
    # top nodes split off the virtual root at density zero
    tops = materialise(linked.where(~F.coalesce("continues", F.lit(False))).select(
        F.col("node").alias("cluster"), "size", "up", density("up_dist").alias("lam")), "tops")
    parents = chain.select(F.col("node").alias("up"), F.col("cluster").alias("parent"))
    born = (tops.join(parents, "up", "left")
            .select("cluster", "size", "parent", F.coalesce("lam", F.lit(0.0)).alias("birth")))
    born = materialise(born, "born")
    n_roots = born.where(F.col("parent").isNull()).count()
    born = born.withColumn("root", F.col("parent").isNull() & F.lit(n_roots == 1))

    entered = salted_join(entry, chain, "node")
    members = materialise(entered.select("id", "cluster", density("dist").alias("lam")), "members")

    direct = members.groupBy("cluster").agg(F.count("*").alias("n"), F.sum("lam").alias("total"),
                                            F.max("lam").alias("deepest"))
    split = born.where(F.col("parent").isNotNull()).groupBy(F.col("parent").alias("cluster")).agg(
        F.sum("size").alias("split_n"), F.sum(F.col("size") * F.col("birth")).alias("split_total"),
        F.max("birth").alias("split_at"))
    zero = F.lit(0.0)
    clusters = born.join(direct, "cluster", "left").join(split, "cluster", "left").select(
        "cluster", "parent", "birth", "root", "size",
        (F.coalesce("total", zero) - F.coalesce("n", F.lit(0)) * F.col("birth")
         + F.coalesce("split_total", zero) - F.coalesce("split_n", F.lit(0)) * F.col("birth"))
        .alias("stability"),
        F.greatest("deepest", "split_at").alias("deepest"))
    return {"clusters": materialise(clusters, "clusters"), "members": members}


def excess_of_mass(clusters: DataFrame) -> DataFrame:
    """cluster -> owner: the selected cluster it belongs to, null if none; the selection
    is the set of clusters with the greatest total stability.

    Bottom-up, one round per tier of the cluster tree: a cluster wins when its own
    stability is at least that of what was selected below it. A single root never wins.
    """
    rounds = Rounds(clusters.sparkSession, "mass")
    tree = clusters.select("cluster", "parent", "root", "stability")
    kids = tree.where(F.col("parent").isNotNull()).groupBy(F.col("parent").alias("cluster")) \
        .agg(F.count("*").alias("kids"))
    state = rounds.keep(tree.join(kids, "cluster", "left").select(
        "cluster", "parent", "root", "stability", F.coalesce("kids", F.lit(0)).alias("kids"),
        F.lit(None).cast("double").alias("value"), F.lit(None).cast("boolean").alias("wins"),
        F.lit(True).alias("open")), "open")
    while rounds.flagged:
        below = state.where(F.col("parent").isNotNull() & F.col("value").isNotNull()).groupBy(
            F.col("parent").alias("cluster")).agg(F.count("*").alias("ready"),
                                                  F.sum("value").alias("below"))
        joined = state.join(below, "cluster", "left")
        open_ = F.col("value").isNull() & (F.coalesce("ready", F.lit(0)) == F.col("kids"))
        lower = F.coalesce("below", F.lit(0.0))
        wins = ~F.col("root") & (F.col("stability") >= lower)
        state = rounds.keep(joined.select(
            "cluster", "parent", "root", "stability", "kids",
            F.when(open_, F.when(wins, F.col("stability")).otherwise(lower))
            .otherwise(F.col("value")).alias("value"),
            F.when(open_, wins).otherwise(F.col("wins")).alias("wins"),
            (F.col("value").isNull() & ~open_).alias("open")), "open")
    # a winner below another winner is part of it: top-down, the highest winner stands
    return owners(state)


def owners(state: DataFrame) -> DataFrame:
    """cluster -> owner: the highest winning cluster on its way up, itself included."""
    rounds = Rounds(state.sparkSession, "owner")
    walk = state.select("cluster", F.col("parent").alias("up"),
                        F.when(F.col("wins"), F.col("cluster")).alias("owner"))
    while True:
        step = walk.select(F.col("cluster").alias("up"), F.col("up").alias("next_up"),
                           F.col("owner").alias("higher"))
        moved = salted_join(walk, step, "up", "left").select(
            "cluster", F.col("next_up").alias("up"), F.coalesce("higher", "owner").alias("owner"))
        walk = rounds.keep(moved.withColumn("open", F.col("up").isNotNull()), "open").drop("open")
        if not rounds.flagged:
            break
    return walk.select("cluster", "owner")


def labels(points: DataFrame, tree: dict[str, DataFrame], probability: str = "attribute") -> DataFrame:
    """id, cluster_id (-1 = noise), cluster_probability.

    ``attribute``: lam / deepest lam of the cluster. ``birth``: both counted from the
    density at which the cluster was born.
    """
    owner = excess_of_mass(tree["clusters"])
    chosen = (owner.where(F.col("owner").isNotNull()).select("owner").distinct())
    number = dense_index(chosen, ["owner"], "cluster_id")
    info = tree["clusters"].select(F.col("cluster").alias("owner"), "birth", "deepest")
    by_cluster = owner.join(number, "owner").join(info, "owner").select(
        "cluster", "cluster_id", "birth", "deepest")
    placed = salted_join(tree["members"], by_cluster, "cluster", stored=True)
    lam = F.least("lam", "deepest")
    if probability == "birth":
        span = F.col("deepest") - F.col("birth")
        p = F.when(span > 0, (lam - F.col("birth")) / span).otherwise(1.0)
    else:
        p = lam / F.col("deepest")
    found = placed.select("id", F.col("cluster_id").cast("int").alias("cluster_id"),
                          p.cast("float").alias("cluster_probability"))
    return points.select("id").join(found, "id", "left").select(
        "id", F.coalesce("cluster_id", F.lit(-1)).alias("cluster_id"),
        F.coalesce("cluster_probability", F.lit(0.0)).cast("float").alias("cluster_probability"))


def density_clusters(points: DataFrame, *, min_samples: int, min_cluster_size: int,
                     vector: str = "coords", levels: int | None = None, neighbours: int | None = None,
                     metric: str = "euclidean", probability: str = "attribute",
                     near: DataFrame | None = None) -> DataFrame:
    """Cluster label and membership probability for every point (id, vector).

    ``near`` (query_id, neighbour_id, distance, rn) are neighbours found before, through an
    index for instance; without it they are searched exactly, which suits few dimensions.
    """
    if near is None:
        near = exact_knn(points, points, neighbours or max(2 * min_samples, 15), query_id="id", base_id="id",
                         vector=vector, metric=metric, exclude_self=True)
    cores = materialise(core_distances(near, min_samples), "cores")
    forest = materialise(spanning_forest(mutual_reachability(near, cores)), "forest")
    return labels(points, hierarchy(points, forest, min_cluster_size, levels), probability)


def cluster_summary(assigned: DataFrame) -> DataFrame:
    """cluster_id, size; noise is the row with -1."""
    return assigned.groupBy("cluster_id").agg(F.count("*").alias("size"))


def cluster_counts(assigned: DataFrame) -> DataFrame:
    """Clusters without noise, and noise rows."""
    return assigned.agg(
        F.countDistinct(F.when(F.col("cluster_id") != -1, F.col("cluster_id"))).alias("clusters"),
        F.count_if(F.col("cluster_id") == -1).alias("noise"))
