"""Vectors: encoding, pooling, checks, and the tables and exports that hold them."""

from __future__ import annotations

from pyspark.sql import functions as F

from seqtide import sinks
from seqtide.catalog.registry import query
from seqtide.config import FULL
from seqtide.functions.kmers import FACTOR, PRIME, SHIFT
from seqtide.functions.text import sequence_id
from seqtide.functions.vectors import norm, normalise
from seqtide.operators import dedup, encode, quality
from seqtide.plans import views
from seqtide.plans.views import duck, table
from seqtide.session import scratch_path
from seqtide.sources import metadata, vectors

DIM, K = 64, 6


def kmers_sql(k: int) -> str:
    """CTEs d and km(accession, pos, h): hash of every window of k letters of ``seqs``."""
    code = " + ".join(f"lead(digit, {j}) over w * {4 ** (k - 1 - j)}::bigint" for j in range(k))
    return f"""
d as (select accession, unnest(string_split(translate(sequence, 'ACGT', '0123'), ''))::bigint as digit,
             generate_subscripts(string_split(sequence, ''), 1) - 1 as pos
      from seqs where length(sequence) > 0),
km as (select accession, pos, ((code::hugeint * {FACTOR} + {SHIFT}) % {PRIME})::bigint as h
       from (select accession, pos, {code} as code from d window w as (partition by accession order by pos)) c
       where code is not null)"""


VECTOR = duck(f"""with {kmers_sql(K)},
b as (select accession, cast(h % {DIM} as int) as dim, count(*) as n from km group by all),
s as (select accession, sqrt(sum(n * n)) as len from b group by all)
select accession, dim, round(cast(cast(n / len as float) as double), 5) as x from b join s using (accession)""", "seqs")


def _unfolded(df, key="accession"):
    return (df.select(key, F.posexplode("embedding").alias("dim", "x")).where(F.col("x") != 0)
            .select(key, "dim", F.round(F.col("x").cast("double"), 5).alias("x")))


@query("kmer_vector", VECTOR)
def kmer_vector(spark, sf):
    return _unfolded(encode.kmer_vectors(views.seqs(spark, sf), DIM, K))


@query("encode_batched", VECTOR)
def encode_batched(spark, sf):
    """The same vectors through the plug-in boundary, a batch of sequences at a time."""
    return _unfolded(encode.encode_sequences(views.seqs(spark, sf), encode.KmerEncoder(DIM, K), FULL.encode_batch))


@query("encode_pending", VECTOR.replace("from seqs where length", "from seqs where doc_id not in (select doc_id from labels) and length"))
def encode_pending(spark, sf):
    """Only sequences without a label are taken as not yet embedded."""
    seqs = views.seqs(spark, sf)
    done = seqs.join(table(spark, sf, "labels").select("doc_id"), "doc_id", "left_semi").select("accession")
    return _unfolded(encode.encode_pending(seqs, done, encode.KmerEncoder(DIM, K), FULL.encode_batch))


@query("token_window", duck(f"""
select accession, cast(ceil(length(sequence) / 6) as bigint) as tokens,
       cast(least(ceil(length(sequence) / 6), 512) as bigint) as kept,
       md5(substr(sequence, 1, 6 * 512)) as kept_md5 from seqs""", "seqs"))
def token_window(spark, sf):
    """How the context limit of a model cuts each sequence: tokens, tokens kept."""
    words = encode.tokens("sequence", 6)
    rows = views.seqs(spark, sf).select("accession", words.alias("words"))
    kept = encode.truncate_tokens("words", 512)
    return rows.select("accession", F.size("words").cast("long").alias("tokens"),
                       F.size(kept).cast("long").alias("kept"), F.md5(F.array_join(kept, "")).alias("kept_md5"))


@query("mean_pool", """
select label, dim, round(avg(x), 6) + 0.0 as x from (
  select label, unnest(embedding)::double as x, generate_subscripts(embedding, 1) - 1 as dim
  from embeddings where embedding[64] < 0.1) t group by label, dim""")
def mean_pool(spark, sf):
    """Vectors stand for tokens, labels for sequences; a high last component marks padding."""
    padded = F.col("embedding")[63].cast("double") >= 0.1
    tokens = table(spark, sf, "embeddings").withColumn("mask", (~padded).cast("int"))
    pooled = encode.mean_pool(tokens, "label", mask="mask")
    return pooled.select("label", F.posexplode("embedding").alias("dim", "x")).select(
        "label", "dim", (F.round("x", 6) + 0.0).alias("x"))


@query("l2_normalise", """
select vec_id, dim, round(x / case when len = 0 then 1 else len end, 6) + 0.0 as x from (
  select vec_id, unnest(embedding)::double as x, generate_subscripts(embedding, 1) - 1 as dim,
         sqrt(list_sum(list_transform(embedding, lambda y: y::double * y::double))) as len from embeddings) t""")
def l2_normalise(spark, sf):
    return (table(spark, sf, "embeddings").select("vec_id", F.posexplode(normalise("embedding")).alias("dim", "x"))
            .select("vec_id", "dim", (F.round("x", 6) + 0.0).alias("x")))


@query("embedding_quality", """
select count(*) as vectors, min(d) as min_dimension, max(d) as max_dimension, 0 as nan_values, 0 as inf_values,
       round(avg(len), 5) as norm_mean, round(stddev_pop(len), 5) as norm_std, round(min(len), 5) as norm_min,
       round(max(len), 5) as norm_max
from (select len(embedding) as d, sqrt(list_sum(list_transform(embedding, lambda y: y::double * y::double))) as len
      from embeddings) t""")
def embedding_quality(spark, sf):
    report = quality.embedding_report(table(spark, sf, "embeddings"))
    stats = ("norm_mean", "norm_std", "norm_min", "norm_max")
    return report.select("vectors", "min_dimension", "max_dimension", "nan_values", "inf_values",
                         *[F.round(c, 5).alias(c) for c in stats])


@query("unpaired_keys", """
select doc_id, l.doc_id is not null as has_vector, true as has_id
from documents d left join labels l using (doc_id) where l.doc_id is null""")
def unpaired_keys(spark, sf):
    return quality.unpaired_keys(table(spark, sf, "labels"), table(spark, sf, "documents"), "doc_id")


@query("id_list_import", """
select vec_id, 'VEC' || lpad(cast(vec_id as varchar), 6, '0') as accession,
       round(embedding[1]::double, 6) as first, label from embeddings""")
def id_list_import(spark, sf):
    """Keys from a padded id file, in no order of their text, put beside vectors by line."""
    path = scratch_path(spark, "ids")
    v = table(spark, sf, "embeddings").withColumn("place", F.md5(F.col("vec_id").cast("string")))
    lines = v.select("place", F.concat(F.lit("  "), sequence_id("vec_id", "VEC"), F.lit(" ")).alias("value")).union(
        v.where("vec_id % 10 = 0").select("place", F.lit("   ").alias("value")))
    lines.orderBy("place").select("value").write.text(path)
    ids = metadata.read_keys(spark, path, position=True)
    zipped = vectors.zip_by_position(ids, v, ["position"], ["place"])
    return zipped.select("vec_id", "accession", F.round(F.col("embedding")[0].cast("double"), 6).alias("first"), "label")


@query("usable_vectors", """
select vec_id, label, len(embedding) as dimension from embeddings where len(embedding) = 64""")
def usable_vectors(spark, sf):
    good, _ = vectors.split_usable(table(spark, sf, "embeddings"), 64)
    return good.select("vec_id", "label", F.size("embedding").alias("dimension"))


@query("vector_table_sink", """
select vec_id, label, round(sqrt(list_sum(list_transform(embedding, lambda y: y::double * y::double))), 5) as norm,
       case when vec_id % 2 = 0 then 'first' else 'second' end as part from embeddings""")
def vector_table_sink(spark, sf):
    """Written in two appends, then opened; a third write in ignore mode changes nothing."""
    path = scratch_path(spark, "vectors")
    v = table(spark, sf, "embeddings").withColumn("cell", F.col("label"))
    for odd, name in ((0, "first"), (1, "second")):
        sinks.write_vectors(v.where(F.col("vec_id") % 2 == odd).withColumn("part", F.lit(name)), path, "append", by_cell=True)
    sinks.write_vectors(v.withColumn("part", F.lit("third")), path, "ignore", by_cell=True)
    stored = spark.read.parquet(path)
    return stored.select("vec_id", "label", F.round(norm(F.col("embedding").cast("array<double>")), 5).alias("norm"), "part")


@query("viewer_wide", """
select """ + ", ".join(f"round(embedding[{i + 1}]::double, 6) as umap_{i}" for i in range(DIM)) + """,
  label as cluster_label, round(cast(cast((vec_id % 21) / 20.0 as float) as double), 5) as cluster_probability,
  'VEC' || lpad(cast(vec_id as varchar), 6, '0') as accession from embeddings""")
def viewer_wide(spark, sf):
    wide = sinks.viewer_table(_manifold(spark, sf), DIM)
    return wide.select(*[F.round(F.col(c).cast("double"), 6).alias(c) for c in wide.columns if c.startswith("umap_")],
                       "cluster_label", F.round(F.col("cluster_probability").cast("double"), 5).alias("cluster_probability"),
                       "accession")


def _manifold(spark, sf):
    return table(spark, sf, "embeddings").select(
        F.col("embedding").alias("coords"), F.col("label").alias("cluster_label"),
        (F.col("vec_id") % 21 / 20.0).alias("cluster_probability"), sequence_id("vec_id", "VEC").alias("accession"))


@query("wide_to_array", """
select 'VEC' || lpad(cast(vec_id as varchar), 6, '0') as accession, dim, x from (
  select vec_id, unnest(embedding) as v, generate_subscripts(embedding, 1) - 1 as dim,
         round(v::double, 6) + 0.0 as x from embeddings) t""")
def wide_to_array(spark, sf):
    """Viewer table in size-limited files, read back and stacked."""
    path = scratch_path(spark, "viewer")
    sinks.write_viewer_table(sinks.viewer_table(_manifold(spark, sf), DIM), path, DIM, limit_bytes=16 * 1024)
    back = sinks.from_viewer_table(spark.read.parquet(path))
    return back.select("accession", F.posexplode("coords").alias("dim", "x")).select(
        "accession", "dim", (F.round(F.col("x").cast("double"), 6) + 0.0).alias("x"))


@query("narrow_types", """
select l_orderkey, l_linenumber, cast(l_quantity as int) as quantity,
       round(cast(cast(l_discount as float) as double), 5) as discount from lineitem""")
def narrow_types(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_quantity").cast("int").alias("quantity"),
        F.round(F.col("l_discount").cast("float").cast("double"), 5).alias("discount"))


@query("exact_copies", duck("""
select md5(sequence) as sequence_md5, min(accession) as representative, count(*) as n from seqs
group by sequence""", "seqs"))
def exact_copies(spark, sf):
    seqs = views.seqs(spark, sf)
    groups = dedup.copy_groups(seqs)
    named = seqs.select(F.col("accession").alias("representative"), F.md5("sequence").alias("sequence_md5"))
    return groups.join(named, "representative").select("sequence_md5", "representative", "n")
