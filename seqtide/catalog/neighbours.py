"""Vector search: exact, indexed, and the graph and layouts built on it."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seqtide.catalog.registry import query
from seqtide.config import FULL
from seqtide.functions.text import sequence_id
from seqtide.functions.vectors import hamming, norm, normalise, sign_code
from seqtide.operators import ivf, manifold
from seqtide.operators.index_table import IndexTable
from seqtide.operators.knn import exact_knn
from seqtide.plans import views
from seqtide.plans.views import duck, table
from seqtide.session import materialise, scratch_path

# The vectors have no cluster structure and the cells (one per label) no training: nine of ten cells and 16 candidates
# per neighbour are what a recall of nine tenths takes here; ``ivf_search_recall`` measures it.
TRUSTED = 0.9
DIM, KNN, PROBES, REFINE = 64, FULL.vote_neighbours, 9, 16


def knn_sql(source: str, k: int, other: bool = False, key: str = "vec_id", distance: str = "list_cosine_distance") -> str:
    """Select of query_id, neighbour_id, distance, rn over a table with key and embedding."""
    skip = f"where a.{key} <> b.{key}" if other else ""
    return f"""select *, row_number() over (partition by query_id order by distance, neighbour_id) as rn
from (select a.{key} as query_id, b.{key} as neighbour_id,
             {distance}(a.embedding::double[], b.embedding::double[]) as distance
      from {source} a cross join {source} b {skip}) p
qualify rn <= {k}"""


def rounded(near: DataFrame) -> DataFrame:
    return near.select("query_id", "neighbour_id", F.abs(F.round("distance", 6)).alias("distance"),
                       F.col("rn").cast("long").alias("rn"))


ROUNDED = "select query_id, neighbour_id, abs(round(distance, 6)) as distance, rn from near"


@query("knn_exact", f"with near as ({knn_sql('embeddings', KNN)}) {ROUNDED}")
def knn_exact(spark, sf):
    v = table(spark, sf, "embeddings")
    return rounded(exact_knn(v, v, KNN, query_id="vec_id", base_id="vec_id"))


@query("knn_cells", f"with near as ({knn_sql('embeddings', KNN)}) {ROUNDED}")
def knn_cells(spark, sf):
    """The same in many small cells and blocks, as a large table has them."""
    v = table(spark, sf, "embeddings")
    return rounded(exact_knn(v, v, KNN, query_id="vec_id", base_id="vec_id", pivots=40, block_rows=64))


@query("knn_euclidean", duck(f"with near as ({knn_sql('planted', KNN, True, distance='list_distance')}) {ROUNDED}", "planted"))
def knn_euclidean(spark, sf):
    v = views.planted(spark, sf)
    return rounded(exact_knn(v, v, KNN, query_id="vec_id", base_id="vec_id", metric="euclidean", exclude_self=True))


@query("knn_graph", f"with near as ({knn_sql('embeddings', FULL.layout_neighbours, True)}) {ROUNDED}")
def knn_graph(spark, sf):
    """Each vector with its 30 nearest others."""
    v = table(spark, sf, "embeddings")
    return rounded(exact_knn(v, v, FULL.layout_neighbours, query_id="vec_id", base_id="vec_id", exclude_self=True))


@query("knn_across", """
with p as (select d.vec_id as query_id, b.vec_id as neighbour_id,
                  list_cosine_distance(d.embedding::double[], b.embedding::double[]) as distance
           from embeddings d join embeddings b on d.label < 5 and b.label >= 5),
near as (select *, row_number() over (partition by query_id order by distance, neighbour_id) as rn from p qualify rn <= 15)
""" + ROUNDED)
def knn_across(spark, sf):
    """Queries and base are different tables."""
    v = table(spark, sf, "embeddings")
    return rounded(exact_knn(v.where("label < 5"), v.where("label >= 5"), KNN, query_id="vec_id", base_id="vec_id"))


def fixed_centroids(spark: SparkSession, sf: str) -> np.ndarray:
    """The first vector of each label as centroid, in label order: one row per label."""
    rows = (table(spark, sf, "embeddings").groupBy("label")
            .agg(F.min_by(normalise("embedding"), "vec_id").alias("c")).orderBy("label").collect())
    return np.array([r["c"] for r in rows])


CELLS = """cent as (select label as cell, first(embedding order by vec_id)::double[] as c from embeddings group by label),
near_cells as (select vec_id, cell, row_number() over (partition by vec_id order by
                 list_cosine_distance(embedding::double[], c), cell) as n from embeddings cross join cent),
bits as (select vec_id, list_aggregate(list_transform(embedding, lambda x: case when x > 0 then '1' else '0' end), 'string_agg', '') as bits
         from embeddings)"""
IVF = f"""{CELLS},
signed as (select vec_id, embedding::double[] as e, list_transform(embedding, lambda x: case when x > 0 then 1 else -1 end)::double[] as s
           from embeddings),
shortlist as (
  select q.vec_id as query_id, b.vec_id as neighbour_id
  from near_cells q join near_cells b on q.cell = b.cell and q.n <= {PROBES} and b.n = 1
  join signed qb on qb.vec_id = q.vec_id join signed bb on bb.vec_id = b.vec_id
  qualify row_number() over (partition by q.vec_id order by
    1 - list_dot_product(qb.e, bb.s) / sqrt(list_dot_product(qb.e, qb.e))
        / (list_dot_product(bb.e, bb.s) / sqrt(list_dot_product(bb.e, bb.e))), b.vec_id) <= {KNN * REFINE}),
scored as (select query_id, neighbour_id, list_cosine_distance(a.embedding::double[], b.embedding::double[]) as distance
           from shortlist join embeddings a on a.vec_id = query_id join embeddings b on b.vec_id = neighbour_id),
near as (select *, row_number() over (partition by query_id order by distance, neighbour_id) as rn from scored qualify rn <= {KNN})"""


@query("ivf_assign", f"with {CELLS} select vec_id, cell from near_cells where n = 1")
def ivf_assign(spark, sf):
    return ivf.assign_cells(table(spark, sf, "embeddings"), fixed_centroids(spark, sf)).select("vec_id", "cell")


@query("sign_code", f"""with {CELLS}
select vec_id, length(replace(bits, '0', '')) as ones, 1 as words, reverse(bits) as word from bits""")
def sign_codes(spark, sf):
    v = ivf.quantise(table(spark, sf, "embeddings"), DIM)
    word = F.col("code")[0]
    return v.select("vec_id", F.bit_count(word).alias("ones"), F.size("code").alias("words"), F.lpad(F.bin(word), 64, "0").alias("word"))


@query("code_alignment", """
select vec_id, round(list_sum(list_transform(embedding, lambda x: abs(x::double))) / len / 8, 6) as align, round(len, 5) as norm
from (select vec_id, embedding, sqrt(list_sum(list_transform(embedding, lambda y: y::double * y::double))) as len from embeddings) t""")
def code_alignment(spark, sf):
    v = ivf.quantise(table(spark, sf, "embeddings"), DIM)
    return v.select("vec_id", F.round("align", 6).alias("align"), F.round("norm", 5).alias("norm"))


@query("centroid_hamming", f"""with {CELLS},
cb as (select cell, list_aggregate(list_transform(c, lambda x: case when x > 0 then '1' else '0' end), 'string_agg', '') as cbits from cent)
select vec_id, cell, hamming(bits, cbits) as hamming from bits cross join cb""")
def centroid_hamming(spark, sf):
    """Differing bits of each vector's code and that of every centroid (one per label)."""
    v = table(spark, sf, "embeddings").select("vec_id", sign_code(normalise("embedding"), DIM).alias("code"))
    cents = [sign_code(F.array(*[F.lit(float(x)) for x in c]), DIM) for c in fixed_centroids(spark, sf)]
    return v.select("vec_id", F.posexplode(F.array(*[hamming("code", c) for c in cents])).alias("cell", "hamming"))


def _index(spark, sf):
    v = table(spark, sf, "embeddings")
    return v, fixed_centroids(spark, sf)


@query("ivf_search", f"with {IVF} {ROUNDED}")
def ivf_search(spark, sf):
    v, cent = _index(spark, sf)
    index = materialise(ivf.build_index(v, cent, DIM, seed=None), "index")
    return rounded(ivf.search(v, index, cent, KNN, query_id="vec_id", base_id="vec_id", dimension=DIM,
                              probes=PROBES, refine=REFINE, seed=None))


@query("vector_lookup", duck(f"""with {IVF}
select query_id, r.accession, r.taxid, r.superkingdom, r.phylum, r."class", r."order", r.family, r.genus, r.species,
       abs(round(distance, 6)) as _distance
from near join ranks r on r.vec_id = neighbour_id""", "ranks"))
def vector_lookup(spark, sf):
    """Search result with the stored lineage columns, from an index table written by cell."""
    v, cent = _index(spark, sf)
    path = scratch_path(spark, "index")
    stored = v.join(views.ranks(spark, sf), "vec_id")
    ivf.build_index(stored, cent, DIM, seed=None).write.partitionBy("cell").parquet(path)
    index = spark.read.parquet(path)
    hits = ivf.lookup(v, index, cent, KNN, query_id="vec_id", base_id="vec_id", dimension=DIM,
                      probes=PROBES, refine=REFINE, seed=None)
    return hits.select("query_id", "accession", "taxid", "superkingdom", "phylum", "class", "order", "family",
                       "genus", "species", F.abs(F.round("_distance", 6)).alias("_distance"))


@query("ivf_search_recall", f"""with {IVF},
near_exact as ({knn_sql('embeddings', KNN)}),
asked as (select query_id, neighbour_id from near_exact where ('0x' || substr(md5(query_id::varchar), 1, 8))::bigint % 4 = 0),
met as (select count(distinct a.query_id) as queries, count(*) as n, count(f.query_id) / count(*) as p
        from asked a left join near f using (query_id, neighbour_id))
select queries, n as neighbours, round(p, 6) as recall,
       round((p + 1.96 * 1.96 / 2 / n - 1.96 * sqrt(p * (1 - p) / n + 1.96 * 1.96 / 4 / n / n)) / (1 + 1.96 * 1.96 / n), 6) as lower,
       true as above_09 from met""")
def ivf_search_recall(spark, sf):
    """Recall of the index that the search and classification queries use, on a quarter of its queries."""
    v, cent = _index(spark, sf)
    index = materialise(ivf.build_index(v, cent, DIM, seed=None), "index")
    some = ivf.sampled(v, "vec_id", 4)
    found = ivf.search(some, index, cent, KNN, query_id="vec_id", base_id="vec_id", dimension=DIM, probes=PROBES, refine=REFINE, seed=None)
    exact = exact_knn(some, v, KNN, query_id="vec_id", base_id="vec_id")
    return ivf.recall_bound(found, exact).select("queries", "neighbours", F.round("recall", 6).alias("recall"), F.round("lower", 6).alias("lower"),
                                                 (F.col("lower") >= 0.9).alias("above_09"))


@query("index_append", f"with {IVF} {ROUNDED}")
def index_append(spark, sf):
    """An index that was appended to twice, the second time with rows it knew, finds what one build finds."""
    v, cent = _index(spark, sf)
    index = IndexTable(spark, scratch_path(spark, "index"), cent, DIM, key="vec_id", seed=None)
    index.append(v.where("vec_id % 3 > 0"))
    index.append(v.where("vec_id % 2 = 0 or vec_id % 3 = 0"))
    return rounded(index.search(v, KNN, probes=PROBES, refine=REFINE))


@query("vector_lookup_one", duck(f"""with {IVF}
select query_id, neighbour_id as vec_id, abs(round(distance, 6)) as _distance, rn from near
where query_id = (select max(vec_id) from embeddings)"""))
def vector_lookup_one(spark, sf):
    """One vector sought in a stored index: one job, only the probed cells are read."""
    v, cent = _index(spark, sf)
    index = IndexTable(spark, scratch_path(spark, "index"), cent, DIM, key="vec_id", seed=None)
    index.append(v)
    return lookup_last(v, index)


def lookup_last(v: DataFrame, index: IndexTable) -> DataFrame:
    """The neighbours of the vector with the greatest id."""
    one = v.orderBy(F.desc("vec_id")).first()
    hits = index.lookup(np.array(one["embedding"]), KNN, probes=PROBES, refine=REFINE)
    return hits.select(F.lit(one["vec_id"]).alias("query_id"), "vec_id", F.abs(F.round("_distance", 6)).alias("_distance"),
                       F.col("rn").cast("long").alias("rn"))


@query("ivf_train", """
select (select count(*) from embeddings) as vectors, true as all_cells_used, label, true as in_one_cell
from (select distinct label from embeddings where label < 9) l""")
def ivf_train(spark, sf):
    """Trained cells: every vector is in one, none is empty, and each planted cluster
    lies (to nine tenths) in cells that hold little else."""
    v = views.planted(spark, sf)
    cent = ivf.train_cells(v, 16, seed=FULL.seed)
    cells = ivf.assign_cells(v, cent).groupBy("cell", "label").agg(F.count("*").alias("n"))
    cells = materialise(cells, "cells")
    total = cells.agg(F.sum("n").alias("vectors"), (F.countDistinct("cell") == len(cent)).alias("all_cells_used"))
    main = cells.where("label < 9").groupBy("cell").agg(F.sum("n").alias("of"), F.max("n").alias("most"), F.max_by("label", "n").alias("label"))
    sizes = cells.where("label < 9").groupBy("label").agg(F.sum("n").alias("size"))
    pure = main.groupBy("label").agg(F.sum("most").alias("own")).join(sizes, "label")
    return pure.crossJoin(F.broadcast(total)).select(
        "vectors", "all_cells_used", "label", (F.col("own") >= 0.9 * F.col("size")).alias("in_one_cell"))


@query("ivf_recall", "select count(*) as queries, true as recall_above_09 from embeddings")
def ivf_recall(spark, sf):
    """Recall of the trained, rotated index against exact search: at least nine tenths."""
    v = views.planted(spark, sf)
    cent = ivf.train_cells(v, 16, seed=FULL.seed)
    index = materialise(ivf.build_index(v, cent, DIM, seed=FULL.seed), "index")
    found = ivf.search(v, index, cent, KNN, query_id="vec_id", base_id="vec_id", dimension=DIM,
                       probes=PROBES, refine=REFINE, seed=FULL.seed)
    exact = exact_knn(v, v, KNN, query_id="vec_id", base_id="vec_id")
    return ivf.recall(found, exact).select("queries", (F.col("recall") >= 0.9).alias("recall_above_09"))


def fuzzy_sql(near: str, k: int) -> str:
    """CTEs from a table of neighbours: bisection for sigma, then memberships."""
    return f"""
nl as (select query_id, list(distance order by distance) as ds from {near} group by query_id),
nr as (select query_id, ds, list_min(list_filter(ds, lambda d: d > 0)) as rho from nl),
bis as (select query_id, ds, rho, 0::double as lo, 'inf'::double as hi, 1::double as sigma, 0 as it from nr
        union all
        select query_id, ds, rho, case when up then lo else sigma end, case when up then sigma else hi end,
               case when up then (lo + sigma) / 2 when isinf(hi) then sigma * 2 else (sigma + hi) / 2 end, it + 1
        from (select *, list_sum(list_transform(ds, lambda d: exp(-greatest(d - rho, 0) / sigma))) > log2({k}) as up from bis) b
        where it < 64),
mem as (select n.query_id, n.neighbour_id, n.rn, rho, exp(-greatest(distance - rho, 0) / sigma) as weight
        from {near} n join bis on bis.query_id = n.query_id and it = 64)"""


def _near30(spark, sf):
    v = table(spark, sf, "embeddings")
    return exact_knn(v, v, FULL.layout_neighbours, query_id="vec_id", base_id="vec_id", exclude_self=True)


@query("fuzzy_graph", f"""with recursive near as ({knn_sql('embeddings', 30, True)}), {fuzzy_sql('near', 30)}
select least(query_id, neighbour_id) as a, greatest(query_id, neighbour_id) as b,
       round(case when count(*) = 2 then max(weight) + min(weight) - max(weight) * min(weight) else max(weight) end, 5) as weight
from mem group by 1, 2""")
def fuzzy_graph(spark, sf):
    return manifold.fuzzy_graph(_near30(spark, sf), 30).select("a", "b", F.round("weight", 5).alias("weight"))


@query("membership_strength", f"""with recursive near as ({knn_sql('embeddings', 30, True)}), {fuzzy_sql('near', 30)}
select query_id, neighbour_id, round(rho, 6) as rho, round(weight, 5) as weight from mem""")
def membership_strength(spark, sf):
    return manifold.memberships(_near30(spark, sf), 30).select(
        "query_id", "neighbour_id", F.round("rho", 6).alias("rho"), F.round("weight", 5).alias("weight"))


@query("manifold_layout", """
select label, count(*) as points, 10 as dims, true as finite, true as apart from embeddings where label < 9 group by label""")
def manifold_layout(spark, sf):
    """Ten-dimensional layout of the planted clusters: whole, finite, and each cluster nearer
    to its own centre than its centre is to any other."""
    points = views.planted(spark, sf).select(F.col("vec_id").alias("id"), "embedding")
    near = exact_knn(points, points, FULL.layout_neighbours, query_id="id", base_id="id", exclude_self=True)
    graph = materialise(manifold.fuzzy_graph(near, FULL.layout_neighbours), "fuzzy")
    laid = manifold.layout(points, graph, FULL.layout_dims, epochs=6, min_dist=FULL.layout_min_dist, seed=FULL.seed)
    labels = views.planted(spark, sf).where("label < 9").select(F.col("vec_id").alias("id"), "label")
    return _separation(materialise(laid.join(labels, "id"), "laid"))


@query("layout_trustworthiness", """
select least(count(*), 200) as judged, true as trusted from embeddings where label < 9""")
def layout_trustworthiness(spark, sf):
    """Neighbours in the layout of the planted clusters are neighbours among the vectors too."""
    v = views.planted(spark, sf).where("label < 9")
    points = v.select(F.col("vec_id").alias("id"), "embedding")
    near = exact_knn(points, points, FULL.layout_neighbours, query_id="id", base_id="id", exclude_self=True)
    graph = materialise(manifold.fuzzy_graph(near, FULL.layout_neighbours), "fuzzy")
    laid = materialise(manifold.layout(points, graph, FULL.layout_dims, epochs=6, min_dist=FULL.layout_min_dist, seed=FULL.seed), "laid")
    drawn = exact_knn(laid, laid, 10, query_id="id", base_id="id", vector="coords", metric="euclidean", exclude_self=True)
    found = manifold.trustworthiness(points, laid, drawn, 10, judged=200)
    return found.select("judged", (F.col("trustworthiness") >= TRUSTED).alias("trusted"))


def _separation(laid: DataFrame) -> DataFrame:
    """Per label: points, dimensions, all finite, and mean distance to the own centre below
    half the way to the nearest other centre. There is one centre per label."""
    dims = laid.select("label", F.posexplode("coords").alias("dim", "x"))
    centre = dims.groupBy("label", "dim").agg(F.avg("x").alias("c"))
    centre = centre.groupBy("label").agg(F.transform(F.array_sort(F.collect_list(F.struct("dim", "c"))), lambda s: s["c"]).alias("c"))

    def far(a, b):
        return F.sqrt(F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x))
    other = centre.select(F.col("label").alias("to"), F.col("c").alias("d"))
    gap = centre.join(other, F.col("label") != F.col("to")).groupBy("label").agg(F.min(far(F.col("c"), F.col("d"))).alias("gap"))
    spread = laid.join(F.broadcast(centre), "label").groupBy("label").agg(
        F.count("*").alias("points"), F.max(F.size("coords")).alias("dims"), F.avg(far(F.col("coords").cast("array<double>"), F.col("c"))).alias("spread"),
        F.bool_and(~F.exists("coords", lambda x: F.isnan(x) | (F.abs(x) == float("inf")))).alias("finite"))
    return spread.join(gap, "label").select("label", "points", "dims", "finite", (F.col("spread") < F.col("gap") / 2).alias("apart"))


@query("manifold_project", duck(f"""with recursive near as (select *, row_number() over (partition by query_id order by distance, neighbour_id) as rn from (
  select a.vec_id as query_id, b.vec_id as neighbour_id, list_cosine_distance(a.embedding, b.embedding) as distance
  from planted a join planted b on a.label = 9 and b.label <> 9) p qualify rn <= 15),
{fuzzy_sql('near', 15)},
parts as (select query_id, weight, unnest(embedding) as x, generate_subscripts(embedding, 1) - 1 as dim
          from mem join planted p on p.vec_id = neighbour_id)
select query_id as id, dim, round(sum(weight * x) / sum(weight), 5) + 0.0 as x from parts group by 1, 2""", "planted"))
def manifold_project(spark, sf):
    """The noise points drawn into the space of the clustered ones."""
    v = views.planted(spark, sf)
    fitted = v.where("label <> 9")
    near = exact_knn(v.where("label = 9"), fitted, 15, query_id="vec_id", base_id="vec_id")
    placed = manifold.project(near, fitted.select(F.col("vec_id").alias("id"), F.col("embedding").alias("coords")), 15)
    return placed.select("id", F.posexplode("coords").alias("dim", "x")).select(
        "id", "dim", (F.round("x", 5) + 0.0).alias("x"))
