"""Density clusters on the planted vectors."""

from __future__ import annotations

from pyspark.sql import functions as F

from seqtide.catalog.neighbours import knn_sql
from seqtide.catalog.registry import query
from seqtide.config import DEMO, FULL
from seqtide.operators import density, ivf, vote
from seqtide.operators.graph import spanning_forest
from seqtide.operators.knn import exact_knn
from seqtide.plans import views
from seqtide.plans.views import duck
from seqtide.session import materialise

K, SAMPLES, RADIUS = 15, FULL.min_samples, 0.6

NEAR = f"near as ({knn_sql('planted', K, True, distance='list_distance')})"
CORE = NEAR + f",\ncore as (select query_id as id, distance as core from near where rn = {SAMPLES})"
MUTUAL = CORE + """,
pair as (select least(query_id, neighbour_id) as a, greatest(query_id, neighbour_id) as b, min(distance) as d
         from near group by 1, 2),
mutual as (select a, b, greatest(ca.core, cb.core, d) as w
           from pair join core ca on ca.id = a join core cb on cb.id = b)"""
FLAT = MUTUAL + f""",
dense as (select id from core where core <= {RADIUS}),
link as (select a, b from mutual where w <= {RADIUS} union select b, a from mutual where w <= {RADIUS}),
reach as (select id as v, id as r from dense union select link.b, reach.r from reach join link on link.a = reach.v),
comp as (select v, min(r) as cluster from reach group by v),
flat as (select vec_id as id, coalesce(cluster, -1) as cluster from planted left join comp on v = vec_id)"""


def _points(spark, sf):
    return views.planted(spark, sf).select(F.col("vec_id").alias("id"), "embedding")


def _graph(spark, sf):
    points = _points(spark, sf)
    near = exact_knn(points, points, K, query_id="id", base_id="id", metric="euclidean", exclude_self=True)
    cores = materialise(density.core_distances(near, SAMPLES), "cores")
    return points, near, cores


@query("core_distance", duck(f"with {CORE} select id, round(core, 6) as core from core", "planted"))
def core_distance(spark, sf):
    _, _, cores = _graph(spark, sf)
    return cores.select("id", F.round("core", 6).alias("core"))


@query("mutual_reach", duck(f"with {MUTUAL} select a, b, round(w, 6) as w from mutual", "planted"))
def mutual_reach(spark, sf):
    _, near, cores = _graph(spark, sf)
    return density.mutual_reachability(near, cores).select("a", "b", F.round("w", 6).alias("w"))


# edges in order; an edge joins the forest when its ends still have different labels
FOREST = MUTUAL + """,
num as (select vec_id, row_number() over (order by vec_id) as i from planted),
ed as (select x.i as a, y.i as b, w, row_number() over (order by w, a, b) as n
       from mutual join num x on x.vec_id = a join num y on y.vec_id = b),
grow as (select 0::bigint as n, (select list(i order by i) from num) as lab, false as used, 0::double as w
         union all
         select e.n, case when g.lab[e.a] <> g.lab[e.b]
                          then list_transform(g.lab, lambda x: case when x = g.lab[e.b] then g.lab[e.a] else x end)
                          else g.lab end, g.lab[e.a] <> g.lab[e.b], e.w
         from grow g join ed e on e.n = g.n + 1)"""


@query("spanning_forest", duck(f"""with recursive {FOREST}
select x.vec_id as a, y.vec_id as b, round(grow.w, 6) as w
from grow join ed using (n) join num x on x.i = ed.a join num y on y.i = ed.b where used""", "planted"))
def forest(spark, sf):
    _, near, cores = _graph(spark, sf)
    return spanning_forest(density.mutual_reachability(near, cores)).select("a", "b", F.round("w", 6).alias("w"))


def _flat(spark, sf):
    points, near, cores = _graph(spark, sf)
    edges = materialise(density.mutual_reachability(near, cores), "mutual")
    return density.radius_clusters(points, cores, edges, RADIUS)


@query("density_clusters", duck(f"with recursive {FLAT} select id, cluster from flat", "planted"))
def density_clusters(spark, sf):
    """Flat clusters at one radius."""
    return _flat(spark, sf)


@query("density_indexed", """
select count(*) as points, true as recall_above_095, true as same_partition_095 from embeddings""")
def density_indexed(spark, sf):
    """The flat clusters from neighbours that a Euclidean index finds: recall against exact neighbours, and agreement
    of the clusters (adjusted Rand) with those of exact ones."""
    points = _points(spark, sf)
    dimension = 64
    cent = ivf.train_cells(points, 16, seed=FULL.seed, metric="euclidean")
    index = materialise(ivf.build_index(points, cent, dimension, seed=FULL.seed, metric="euclidean"), "index")
    near = ivf.search(points, index, cent, K, query_id="id", base_id="id", dimension=dimension, probes=8, refine=8, seed=FULL.seed,
                      exclude_self=True, metric="euclidean")
    cores = materialise(density.core_distances(near, SAMPLES), "cores")
    found = density.radius_clusters(points, cores, materialise(density.mutual_reachability(near, cores), "mutual"), RADIUS)
    exact = exact_knn(points, points, K, query_id="id", base_id="id", metric="euclidean", exclude_self=True)
    both = found.withColumnRenamed("cluster", "a").join(_flat(spark, sf).withColumnRenamed("cluster", "b"), "id")
    agreement = vote.adjusted_rand(materialise(both, "both"), "a", "b")
    # three tables of one row
    one = F.lit(1).alias("one")
    total = points.agg(F.count("*").alias("points")).select("points", one)
    recall = ivf.recall_bound(near, exact).select((F.col("lower") >= 0.95).alias("recall_above_095"), one)
    same = agreement.select((F.col("adjusted_rand") >= 0.95).alias("same_partition_095"), one)
    return total.join(recall, "one").join(same, "one").drop("one")


@query("cluster_summary", duck(f"""with recursive {FLAT}
select cluster as cluster_id, count(*) as size from flat group by 1""", "planted"))
def cluster_summary(spark, sf):
    return density.cluster_summary(_flat(spark, sf).withColumnRenamed("cluster", "cluster_id"))


@query("cluster_counts", duck(f"""with recursive {FLAT}
select count(distinct case when cluster <> -1 then cluster end) as clusters, count_if(cluster = -1)::bigint as noise from flat""", "planted"))
def cluster_counts(spark, sf):
    return density.cluster_counts(_flat(spark, sf).withColumnRenamed("cluster", "cluster_id"))


@query("noise_points", duck(f"with recursive {FLAT} select id from flat where cluster = -1", "planted"))
def noise_points(spark, sf):
    return _flat(spark, sf).where(F.col("cluster") == -1).select("id")


# the hierarchy from the states of the forest: one per distinct weight, a node where a large component changed
MCS, LOT = DEMO.min_cluster_size, 128
TREE = FOREST + f""",
used as (select n, ed.w, lab[ed.a] as c, row_number() over (order by n) - 1 as rank, lab from grow join ed using (n) where used),
lev as (select row_number() over (order by w) as l, w, last(lab order by n) as lab from used group by w),
pt as (select l, i, lab[i] as name from lev, range(1, (select count(*) from num) + 1) r(i)),
named as (select x.vec_id as id, l, min(x.vec_id) over (partition by l, name) as c, count(*) over (partition by l, name) as size
          from pt join num x using (i)),
whole as (select distinct l, c, size from named),
node as (select t.l, t.c, t.size, lev.w from whole t join lev using (l) left join whole b on b.l = t.l - 1 and b.c = t.c
         where t.size >= {MCS} and t.size > coalesce(b.size, 1)),
-- the large component at a node's place one weight below leads to the node; the latest change is its node
below as (select distinct n.l, n.c, k.c as kid
          from node n join named m on m.l = n.l and m.c = n.c join named k on k.l = n.l - 1 and k.id = m.id where k.size >= {MCS}),
link as (select b.l as up_l, b.c as up_c, b.kid as c, max(n.l) as l from below b join node n on n.c = b.kid and n.l < b.l group by all),
kids as (select up_l as l, up_c as c, count(*) as kids from link group by all),
top as (select n.l, n.c, n.size, up_l, up_c, u.w as up_w
        from node n left join link using (l, c) left join kids k on k.l = up_l and k.c = up_c left join node u on u.l = up_l and u.c = up_c
        where coalesce(kids, 0) <> 1),
chain as (select l, c, l as t_l, c as t_c from top
          union all
          select link.l, link.c, t_l, t_c from chain h join kids k on k.l = h.l and k.c = h.c join link on up_l = h.l and up_c = h.c where kids = 1),
born as (select t.l as t_l, t.c as t_c, size, h.t_l as p_l, h.t_c as p_c, coalesce(1 / up_w, 0) as birth
         from top t left join chain h on h.l = up_l and h.c = up_c),
entry as (select m.id, min(m.l) as l, min_by(m.c, m.l) as c from named m where m.size >= {MCS} group by m.id),
member as (select id, t_l, t_c, 1 / w as lam from entry join chain using (l, c) join lev using (l)),
direct as (select t_l, t_c, count(*) as n, sum(lam) as total, max(lam) as deepest from member group by all),
splits as (select p_l as t_l, p_c as t_c, sum(size) as n, sum(size * birth) as total, max(birth) as split_at from born where p_l is not null group by all),
cut as (select l as t_l, named.c as t_c, max(rank) as cut
        from lev join used using (w) join num on num.i = used.c join named using (l) where named.id = num.vec_id group by all),
clus as (select b.*, cut.cut, coalesce(d.total, 0) - coalesce(d.n, 0) * birth + coalesce(s.total, 0) - coalesce(s.n, 0) * birth as stability,
                greatest(d.deepest, s.split_at) as deepest, p_l is null and (select count(*) from born where p_l is null) = 1 as alone
         from born b left join direct d using (t_l, t_c) left join splits s using (t_l, t_c) left join cut using (t_l, t_c))"""
# clusters from the densest birth down: the kids of one come before it
LABELS = TREE + """,
ord as (select *, row_number() over (order by birth desc, t_l, t_c) as i from clus),
fam as (select o.*, p.i as up, (select list(k.i) from ord k where k.p_l = o.t_l and k.p_c = o.t_c) as young
        from ord o left join ord p on p.t_l = o.p_l and p.t_c = o.p_c),
mass as (select 0::bigint as i, []::double[] as vals, []::boolean[] as wins
         union all
         select i, list_append(vals, case when stability >= low and not alone then stability else low end),
                list_append(wins, stability >= low and not alone)
         from (select f.i, m.vals, m.wins, f.stability, f.alone,
                      coalesce(list_sum(list_transform(f.young, lambda k: m.vals[k])), 0) as low
               from mass m join fam f on f.i = m.i + 1) x),
done as (select wins from mass order by i desc limit 1),
own as (select i, case when (select wins from done)[i] then i end as owner from fam where up is null
        union all
        select f.i, coalesce(o.owner, case when (select wins from done)[f.i] then f.i end) from own o join fam f on f.up = o.i),
num_of as (select owner, row_number() over (order by cut, t_c) - 1 as cluster_id from (select distinct owner from own where owner is not null) x join fam on fam.i = owner),
placed as (select m.id, n.cluster_id, least(m.lam, o.deepest) / o.deepest as p
           from member m join fam f using (t_l, t_c) join own on own.i = f.i join num_of n on n.owner = own.owner join fam o on o.i = own.owner)"""


def _tree(spark, sf):
    points, near, cores = _graph(spark, sf)
    found = materialise(spanning_forest(density.mutual_reachability(near, cores)), "forest")
    return points, density.hierarchy(points, found, MCS, lot=LOT)


@query("condensed_tree", duck(f"""with recursive {TREE}
select t_c as cluster, cut, round(birth, 6) as birth, size, round(stability, 6) as stability from clus""", "planted"))
def condensed_tree(spark, sf):
    """Clusters of the hierarchy with birth density and stability, merged in several lots."""
    _, tree = _tree(spark, sf)
    return tree["clusters"].select(F.col("cluster.component").alias("cluster"), F.col("cluster.g").alias("cut"),
                                   F.round("birth", 6).alias("birth"), "size", F.round("stability", 6).alias("stability"))


@query("cluster_membership", duck(f"""with recursive {LABELS}
select vec_id as id, coalesce(cluster_id, -1)::int as cluster_id, round(coalesce(p, 0), 5) as cluster_probability
from planted left join placed on id = vec_id""", "planted"))
def cluster_membership(spark, sf):
    """Selected cluster and membership probability of every point."""
    points, tree = _tree(spark, sf)
    return density.labels(points, tree).select("id", "cluster_id", F.round(F.col("cluster_probability").cast("double"), 5).alias("cluster_probability"))
