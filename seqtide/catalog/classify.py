"""Votes, rules and assignment records."""

from __future__ import annotations

from pyspark.sql import functions as F

from seqtide import sinks
from seqtide.catalog.neighbours import fixed_centroids, IVF, knn_sql, PROBES, REFINE
from seqtide.catalog.registry import query
from seqtide.config import FULL, RANKS
from seqtide.operators import ivf, vote
from seqtide.operators.knn import exact_knn
from seqtide.operators.lineage import attach_lineage
from seqtide.plans import views
from seqtide.plans.classify import classify_exact, from_neighbours
from seqtide.plans.views import duck, table
from seqtide.session import materialise, scratch_path

K = FULL.vote_neighbours


def vote_sql(near: str, ranks: str = "ranks") -> str:
    """CTE voted(query_id, rank, name, confidence) from neighbours and their names."""
    names = ", ".join(f"('{r}', r.\"{r}\")" for r in RANKS)
    return f"""
votes as (select n.query_id, u.rank, u.name, n.rn from {near} n join {ranks} r on r.vec_id = n.neighbour_id
          cross join lateral (values {names}) u(rank, name)),
tally as (select query_id, rank, name, count(*) as c, min(rn) as seen from votes where name <> '' group by all),
best as (select query_id, rank, first(name order by c desc, seen) as name, round(max(c) / sum(c), 4) as confidence
         from tally group by all),
voted as (select q.query_id, k.rank, coalesce(b.name, 'Unknown') as name, coalesce(b.confidence, 0) as confidence
          from (select distinct query_id from {near}) q cross join (select unnest({list(RANKS)}) as rank) k
          left join best b on b.query_id = q.query_id and b.rank = k.rank)"""


FAMILY = """
fam as (select query_id, max(case when rank = 'family' then confidence end) >= 0.95
                     and max(case when rank = 'genus' then confidence end) < 0.5 as split from voted group by query_id),
ruled as (select query_id, rank, case when split and rank in ('genus', 'species') then 'Unknown' else name end as name,
                 case when split and rank = 'species' then 0 else confidence end as confidence
          from voted join fam using (query_id))"""
# fixture: the probability of a point follows its id
AMBIGUOUS = FAMILY + """,
cl as (select vec_id as query_id, label as cluster_id, (vec_id % 21) / 20.0 as probability from planted),
final as (select query_id, rank, case when probability < 0.85 and rank in ('genus', 'species')
                                      then 'Unknown (ambiguous clade)' else name end as name,
                 case when probability < 0.85 and rank in ('genus', 'species') then 0 else confidence end as confidence,
                 cluster_id, probability
          from ruled join cl using (query_id))"""
PLANTED_NEAR = f"near as ({knn_sql('planted', K)})"
FINAL = f"with {PLANTED_NEAR}, {vote_sql('near')}, {AMBIGUOUS}"
RECORD = """ select 'VEC' || lpad(cast(query_id as varchar), 6, '0') as accession, any_value(cluster_id) as cluster_id,
 round(any_value(probability)::double, 4) as cluster_probability, any_value(probability) < 0.85 as is_ambiguous_clade,
 15 as n_reference_neighbours, """ + ", ".join(
    f"max(case when rank = '{r}' then name end) as {r}_name, max(case when rank = '{r}' then confidence end)::double as {r}_confidence"
    for r in RANKS) + " from final group by query_id"


def _vectors(spark, sf):
    return views.planted(spark, sf).select(
        F.format_string("VEC%06d", "vec_id").alias("accession"), "vec_id", "label", "embedding")


def _clusters(v):
    return v.select(F.col("accession").alias("query_id"), F.col("label").alias("cluster_id"),
                    (F.col("vec_id") % 21 / 20.0).alias("cluster_probability"))


def _near(spark, sf):
    v = views.planted(spark, sf)
    return exact_knn(v, v, K, query_id="vec_id", base_id="vec_id")


def _voted(spark, sf):
    names = vote.resolved_lineages(views.ranks(spark, sf), None, "vec_id")
    return vote.vote(vote.neighbour_names(_near(spark, sf), names, "vec_id"))


def _by_rank(voted):
    rows = F.array(*[F.struct(F.lit(r).alias("rank"), F.col(r)["name"].alias("name"),
                              F.col(r)["confidence"].alias("confidence")) for r in RANKS])
    return voted.select("query_id", F.inline(rows))


def flat_records(records):
    return records.select("accession", "cluster_id", "cluster_probability", "is_ambiguous_clade", "n_reference_neighbours", *[
        c for r in RANKS for c in (F.col(f"taxonomy.`{r}`.name").alias(f"{r}_name"),
                                   F.col(f"taxonomy.`{r}`.confidence").alias(f"{r}_confidence"))])


@query("classify", duck(FINAL + RECORD, "planted", "ranks"))
def classify(spark, sf):
    """Flagship: nearest neighbours of every vector, vote, both rules, one record each."""
    v = _vectors(spark, sf)
    return flat_records(classify_exact(v, views.ranks(spark, sf), _clusters(v)))


EVERY = f"""
with usable as (select * from planted where vec_id % 50 > 1),
near as ({knn_sql('usable', K)}),
{vote_sql('near', '(select p.vec_id, r.* exclude (vec_id) from planted p left join (select * from ranks where vec_id % 7 <> 3) r using (vec_id))')},
every as (select p.vec_id as query_id, k.rank, coalesce(v.name, 'Unknown') as name, coalesce(v.confidence, 0) as confidence
          from planted p cross join (select unnest({list(RANKS)}) as rank) k
          left join voted v on v.query_id = p.vec_id and v.rank = k.rank), {{rules}}"""
COMPLETE = EVERY.replace("{rules}", AMBIGUOUS.replace("from voted", "from every")
                         .replace("label as cluster_id, (vec_id % 21) / 20.0 as probability",
                                  "case when vec_id % 11 = 5 then -1 else label end as cluster_id, "
                                  "case when vec_id % 11 = 5 then 0 else (vec_id % 21) / 20.0 end as probability"))


@query("classify_complete", duck(COMPLETE + RECORD.replace(
    " 15 as n_ref", " any_value(case when query_id % 50 > 1 then 15 else 0 end)::int as n_ref"), "planted", "ranks"))
def classify_complete(spark, sf):
    """One record for every vector: zero and NaN vectors, neighbours without a lineage and
    vectors without a cluster are all there."""
    v = _vectors(spark, sf).withColumn("embedding", F.when(F.col("vec_id") % 50 > 1, F.col("embedding")).otherwise(
        F.transform("embedding", lambda x: F.when(F.col("vec_id") % 50 == 0, F.lit(0.0)).otherwise(F.lit(float("nan"))))))
    ranks = views.ranks(spark, sf).where("vec_id % 7 <> 3")
    return flat_records(classify_exact(v, ranks, _clusters(v.where("vec_id % 11 <> 5"))))


@query("classify_embeddings", duck(
    FINAL.replace(knn_sql('planted', K), knn_sql('embeddings', K)) + RECORD, "planted", "ranks"))
def classify_embeddings(spark, sf):
    """The same on the unclustered vectors, where votes are split."""
    v = table(spark, sf, "embeddings").select(
        F.format_string("VEC%06d", "vec_id").alias("accession"), "vec_id", "label", "embedding")
    return flat_records(classify_exact(v, views.ranks(spark, sf), _clusters(v)))


LABELLED = FINAL.replace(knn_sql('planted', K), f"""select a.vec_id as query_id, b.vec_id as neighbour_id,
  row_number() over (partition by a.vec_id order by list_cosine_distance(a.embedding, b.embedding), b.vec_id) as rn
from planted a cross join planted b where b.label <> 4 and a.vec_id <> b.vec_id qualify rn <= {K}""")


@query("classify_labelled", duck(LABELLED + RECORD, "planted", "ranks"))
def classify_labelled(spark, sf):
    """Only vectors with a taxid vote (one label has none), and never for themselves."""
    v, ranks = _vectors(spark, sf), views.ranks(spark, sf)
    known = ranks.withColumn("taxid", F.when(F.col("taxid") == "5", "").otherwise(F.col("taxid")))
    return flat_records(classify_exact(v, known, _clusters(v), labelled_only=True, exclude_self=True))


@query("classify_indexed", duck(f"with {IVF}, {vote_sql('near')}, {AMBIGUOUS} {RECORD}", "planted", "ranks"))
def classify_indexed(spark, sf):
    """Vote among neighbours found through the 1-bit index."""
    v = table(spark, sf, "embeddings").select(
        F.format_string("VEC%06d", "vec_id").alias("accession"), "vec_id", "label", "embedding")
    cent = fixed_centroids(spark, sf)
    index = materialise(ivf.build_index(v, cent, 64, seed=None), "index")
    near = ivf.search(v, index, cent, K, query_id="accession", base_id="accession", dimension=64, probes=PROBES,
                      refine=REFINE, seed=None)
    names = vote.resolved_lineages(views.ranks(spark, sf), None)
    return flat_records(from_neighbours(near, names, _clusters(v)))


@query("vote", duck(f"with {PLANTED_NEAR}, {vote_sql('near')} select query_id, rank, name, confidence::double as confidence from voted", "planted", "ranks"))
def rank_vote(spark, sf):
    return _by_rank(_voted(spark, sf))


@query("neighbour_count", duck(f"""with {PLANTED_NEAR}
select query_id, count(*) as n_neighbours from near group by 1""", "planted"))
def neighbour_count(spark, sf):
    return _voted(spark, sf).select("query_id", "n_neighbours")


@query("family_rule", duck(f"with {PLANTED_NEAR}, {vote_sql('near')}, {FAMILY} select query_id, rank, name, confidence::double as confidence from ruled", "planted", "ranks"))
def family(spark, sf):
    return _by_rank(vote.family_rule(_voted(spark, sf)))


@query("ambiguous_rule", duck(FINAL + " select query_id, rank, name, confidence::double as confidence from final", "planted", "ranks"))
def ambiguous(spark, sf):
    prob = views.planted(spark, sf).select(F.col("vec_id").alias("query_id"), (F.col("vec_id") % 21 / 20.0).alias("cluster_probability"))
    return _by_rank(vote.ambiguous_rule(vote.family_rule(_voted(spark, sf)).join(prob, "query_id")))


@query("ambiguous_flag", """
select l_orderkey, l_linenumber, 1 - l_discount * 5 < 0.85 as is_ambiguous_clade from lineitem""")
def ambiguous_flag(spark, sf):
    """The flag alone, over a large table."""
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", (1 - F.col("l_discount") * 5).alias("p"))
    return rows.select("l_orderkey", "l_linenumber", (F.col("p") < FULL.ambiguous_below).alias("is_ambiguous_clade"))


@query("lineage_fallback", duck(f"""
select vec_id, {", ".join(f'''case when vec_id in (select doc_id from labels) then concat('L', "{r}") else "{r}" end as "{r}"''' for r in RANKS)}
from ranks""", "ranks"))
def lineage_fallback(spark, sf):
    """A lookup table that knows some vectors overrules their stored lineage as a whole row."""
    ranks = views.ranks(spark, sf)
    known = ranks.join(table(spark, sf, "labels").select(F.col("doc_id").alias("vec_id")), "vec_id", "left_semi")
    lookup = known.select("vec_id", *[F.concat(F.lit("L"), F.col(f"`{r}`")).alias(r) for r in RANKS])
    return vote.resolved_lineages(ranks, lookup, "vec_id")


@query("vector_annotate", duck("""
select vec_id, coalesce(r.taxid, '') as taxid, """ + ", ".join(f"coalesce(r.\"{r}\", '') as \"{r}\"" for r in RANKS) + """
from embeddings e left join (select * from ranks where family <> 'F3') r using (vec_id)""", "ranks"))
def vector_annotate(spark, sf):
    rows = table(spark, sf, "embeddings").select("vec_id")
    return attach_lineage(rows, views.ranks(spark, sf).where("family <> 'F3'"), "vec_id")


@query("assignment_json", duck(FINAL + f""",
rec as (select query_id, any_value(cluster_id) as cluster_id, round(any_value(probability)::double, 4) as p,
               any_value(probability) < 0.85 as weak, max(case when rank = 'family' then name end) as family,
               max(case when rank = 'species' then confidence end)::double as species_confidence from final group by query_id)
select 'VEC' || lpad(cast(query_id as varchar), 6, '0') as accession, cluster_id, p as cluster_probability,
       weak as is_ambiguous_clade, family, species_confidence from rec""", "planted", "ranks"))
def assignment_json(spark, sf):
    """Records written as JSON lines and read from the text again."""
    v = _vectors(spark, sf)
    path = scratch_path(spark, "assignments")
    sinks.write_assignments(classify_exact(v, views.ranks(spark, sf), _clusters(v)), path)
    schema = ("accession string, cluster_id int, cluster_probability double, is_ambiguous_clade boolean, "
              "taxonomy struct<family:struct<name:string>,species:struct<confidence:double>>")
    return spark.read.schema(schema).json(path).select(
        "accession", "cluster_id", "cluster_probability", "is_ambiguous_clade",
        F.col("taxonomy.family.name").alias("family"), F.col("taxonomy.species.confidence").alias("species_confidence"))


@query("rank_report", duck(FINAL + """
select rank, round(avg(confidence), 4) as mean_confidence, round(avg(case when name like 'Unknown%' then 1 else 0 end), 4) as share_unknown
from final group by rank""", "planted", "ranks"))
def rank_report(spark, sf):
    v = _vectors(spark, sf)
    report = vote.rank_report(classify_exact(v, views.ranks(spark, sf), _clusters(v)))
    return report.select("rank", F.round("mean_confidence", 4).alias("mean_confidence"), F.round("share_unknown", 4).alias("share_unknown"))


@query("adjusted_rand", """
with c as (select l_returnflag as a, l_linestatus as b, count(*)::double as n from lineitem group by all),
s as (select (select sum(n * (n - 1) / 2) from c) as pairs_both, (select sum(m * (m - 1) / 2) from (select sum(n) m from c group by a)) as ls,
      (select sum(m * (m - 1) / 2) from (select sum(n) m from c group by b)) as rs, (select sum(n) from c) as t)
select round((pairs_both - ls * rs / (t * (t - 1) / 2)) / ((ls + rs) / 2 - ls * rs / (t * (t - 1) / 2)), 6) as adjusted_rand from s""")
def adjusted_rand(spark, sf):
    return vote.adjusted_rand(table(spark, sf, "lineitem"), "l_returnflag", "l_linestatus").select(
        F.round("adjusted_rand", 6).alias("adjusted_rand"))
