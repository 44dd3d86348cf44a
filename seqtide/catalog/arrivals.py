"""The incremental forms, run to the end of what has arrived."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from seqtide import sinks
from seqtide.catalog.classify import _clusters, flat_records, AMBIGUOUS, RECORD, vote_sql
from seqtide.catalog.curate import PART, written_fasta
from seqtide.catalog.encode import DIM, K, VECTOR, _unfolded
from seqtide.catalog.neighbours import IVF, PROBES, REFINE, fixed_centroids
from seqtide.catalog.registry import query
from seqtide.config import FULL
from seqtide.operators import encode
from seqtide.operators.index_table import IndexTable
from seqtide.plans import views
from seqtide.plans.views import duck, table
from seqtide.session import scratch_path
from seqtide.streaming import arrivals


@query("stream_ingest", duck("select accession, md5(sequence) as sequence_md5 from seqs", "seqs"))
def stream_ingest(spark, sf):
    """Three calls of the ingest job: half of the files, the other half, nothing new."""
    path, out, ckpt = (scratch_path(spark, n) for n in ("fasta", "out", "ckpt"))
    seqs = views.seqs(spark, sf)
    for half in (0, 1, None):
        if half is not None:
            sinks.write_fasta(seqs.where(F.col("doc_id") % 2 == half), f"{path}/{half}")
        arrivals.ingest(spark, path, out, ckpt, pattern=PART).awaitTermination()
    return spark.read.parquet(out).select("accession", F.md5("sequence").alias("sequence_md5"))


@query("stream_embed", VECTOR)
def stream_embed(spark, sf):
    path, out, ckpt = written_fasta(spark, views.seqs(spark, sf)), scratch_path(spark, "out"), scratch_path(spark, "ckpt")
    arrivals.embed(spark, path, encode.KmerEncoder(DIM, K), out, ckpt, pattern=PART).awaitTermination()
    return _unfolded(spark.read.parquet(out))


@query("stream_dedup", duck("select accession from seqs", "seqs"))
def stream_dedup(spark, sf):
    """Every sequence arrives twice, in different batches, and is kept once."""
    seqs = views.seqs(spark, sf).coalesce(2)
    path, out, ckpt = written_fasta(spark, seqs.union(seqs)), scratch_path(spark, "out"), scratch_path(spark, "ckpt")
    stream = arrivals.first_arrivals(arrivals.fasta_stream(spark, path, PART, files_per_batch=1))
    arrivals.append_to(stream.select("accession"), out, ckpt).awaitTermination()
    return spark.read.parquet(out)


@query("stream_new_only", duck("""
select accession, doc_id from seqs where doc_id not in (select doc_id from labels)""", "seqs"))
def stream_new_only(spark, sf):
    """Arrivals in several batches with repeats across them, without those that are stored already (the labelled ones)."""
    seqs = views.seqs(spark, sf).select("accession", "doc_id").coalesce(2)
    stored = seqs.join(table(spark, sf, "labels").select("doc_id"), "doc_id", "left_semi")
    source, out, ckpt = (scratch_path(spark, n) for n in ("in", "out", "ckpt"))
    seqs.union(seqs.where("doc_id % 2 = 0")).write.parquet(source)
    stream = spark.readStream.schema(seqs.schema).option("maxFilesPerTrigger", 1).parquet(source)
    arrivals.append_new(stream, stored, out, ckpt).awaitTermination()
    return arrivals.stored_batches(spark, out)


@query("stream_classify", duck(f"with {IVF}, {vote_sql('near')}, {AMBIGUOUS} {RECORD}", "planted", "ranks"))
def stream_classify(spark, sf):
    """Arriving vectors classified against a fixed index."""
    v = table(spark, sf, "embeddings").select(
        F.format_string("VEC%06d", "vec_id").alias("accession"), "vec_id", "label", "embedding")
    cent = fixed_centroids(spark, sf)
    index = IndexTable(spark, scratch_path(spark, "index"), cent, DIM, seed=None)
    index.append(v)
    source, out, ckpt = (scratch_path(spark, n) for n in ("in", "out", "ckpt"))
    v.write.parquet(source)
    stream = spark.readStream.schema(v.schema).parquet(source)
    arrivals.classify(stream, index.vectors, cent, views.ranks(spark, sf), _clusters, out, ckpt, dimension=DIM,
                      seed=None, profile=replace(FULL, probes=PROBES, refine=REFINE), codes=index.codes).awaitTermination()
    return flat_records(arrivals.stored_batches(spark, out))
