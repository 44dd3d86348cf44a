"""The whole run: files in, assignment records out.

Every stage is a table under ``out``; a stage whose table the ledger knows is read, not
built again.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seqtide import sinks
from seqtide.config import FULL, Profile
from seqtide.operators import dedup, density, encode, homology, ivf, lineage, manifold, quality
from seqtide.operators.ledger import Ledger
from seqtide.plans.classify import classify_indexed
from seqtide.sources import fasta, metadata


@dataclass(frozen=True)
class Inputs:
    """``fasta`` and ``metadata`` are paths; ``tree`` has tax_id, parent_id, rank, name."""

    fasta: str
    metadata: str
    tree: DataFrame
    pattern: str = "*.{fasta,fna}"
    merged: DataFrame | None = None


def run(spark: SparkSession, inputs: Inputs, out: str, encoder: encode.Encoder,
        profile: Profile = FULL, name: str = "default", homology_step: bool = True,
        epochs: int = 20, force: bool = False) -> DataFrame:
    book = Ledger(spark, f"{out}/ledger", name)
    mark = fingerprint(spark, inputs, encoder, profile, homology_step, epochs)

    def stage(label, build, metric="rows"):
        return book.stage(label, f"{out}/{label}", build, metric, force, mark)

    records = fasta.read_fasta(spark, inputs.fasta, inputs.pattern, position=True)
    meta = metadata.read_metadata(spark, inputs.metadata)

    keys = stage("representatives", lambda: dedup.representatives(
        meta.where(F.col("_corrupt_record").isNull() & F.col("accession").isNotNull())), "distinct_taxa")
    # of records that share an accession the first in the files stays
    kept = stage("kept", lambda: dedup.keep(records, keys.select(F.col("representative").alias("accession")))
                 .groupBy("accession").agg(F.min_by(F.struct("header", "sequence", "path"), "position").alias("r"))
                 .select("accession", "r.*"))
    if homology_step:
        clusters = stage("homology", lambda: homology.homology_clusters(
            kept, profile.kmer, profile.kmers_per_sequence, profile.min_identity, profile.min_coverage))
        kept = kept.join(clusters.where(F.col("accession") == F.col("representative")), "accession", "left_semi")

    taxids = lineage.merge_maps(lineage.header_map(records), metadata.taxid_map(meta))
    lineages = stage("lineages", lambda: lineage.tree_lineages(inputs.tree, merged=inputs.merged)
                     .withColumn("taxid", F.col("tax_id").cast("string")).drop("tax_id"), "n_taxids")
    annotated = stage("annotated", lambda: lineage.annotate(taxids, lineages), "n_annotated")

    window = encode.context_window(kept, encoder)
    vectors = stage("vectors", lambda: encode.encode_sequences(window, encoder, profile.encode_batch), "n_embedded")
    stage("quality", lambda: quality.embedding_report(vectors))
    usable = vectors.where(ivf.searchable("embedding"))
    book.record("vectors", n_unusable=vectors.count() - usable.count())
    cells = stage("centroids", lambda: trained_cells(usable, profile), "n_cells")
    centroids = np.array([r["centroid"] for r in cells.orderBy("cell").collect()])
    index = stage("index", lambda: ivf.build_index(usable, centroids, encoder.dimension, seed=profile.seed), "n_rows")

    def near(k: int) -> DataFrame:
        return ivf.search(usable, index, centroids, k, query_id="accession", base_id="accession",
                          dimension=encoder.dimension, probes=profile.probes, refine=profile.refine,
                          seed=profile.seed, exclude_self=True, block_rows=profile.block_rows)
    points = usable.select(F.col("accession").alias("id"), "embedding")
    coords = stage("manifold", lambda: manifold.layout(
        points, manifold.fuzzy_graph(near(profile.layout_neighbours), profile.layout_neighbours),
        profile.layout_dims, epochs, profile.layout_min_dist, profile.seed))
    assigned = stage("clusters", lambda: density.density_clusters(
        coords, min_samples=profile.min_samples, min_cluster_size=profile.min_cluster_size,
        levels=profile.levels), "n_points")

    stored = lineage.attach_lineage(vectors.select("accession"), annotated)
    results = stage("assignments", lambda: classify_indexed(
        vectors, index, centroids, stored, assigned.withColumnRenamed("id", "query_id"),
        dimension=encoder.dimension, seed=profile.seed, profile=profile), "n_assignments")
    sinks.write_assignments(results, f"{out}/assignments_json")
    viewer = coords.join(assigned, "id").select(
        F.col("id").alias("accession"), "coords", F.col("cluster_id").alias("cluster_label"), "cluster_probability")
    sinks.write_viewer_table(sinks.viewer_table(viewer, profile.layout_dims), f"{out}/viewer", profile.layout_dims,
                             profile.export_bytes)
    return results


def trained_cells(vectors: DataFrame, profile: Profile) -> DataFrame:
    """cell, centroid: ``profile.cells`` rows at most, fitted on all vectors."""
    centroids = ivf.train_cells(vectors, profile.cells, seed=profile.seed)
    return vectors.sparkSession.createDataFrame(
        [(i, [float(x) for x in c]) for i, c in enumerate(centroids)], "cell int, centroid array<double>")


def fingerprint(spark: SparkSession, inputs: Inputs, encoder: encode.Encoder, profile: Profile, *options) -> str:
    """Digest of the input files (path, size, time), the tables given and every parameter."""
    marks = []
    for path, pattern in ((inputs.fasta, inputs.pattern), (inputs.metadata, "*")):
        files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
                 .option("pathGlobFilter", pattern).load(path))
        marks.append(files.agg(F.count("*"), F.bit_xor(F.xxhash64("path", "length", "modificationTime"))).first())
    for table in (inputs.tree, inputs.merged):
        marks.append(None if table is None else table.agg(F.count("*"), F.bit_xor(F.xxhash64(*table.columns))).first())
    kind = (type(encoder).__module__, type(encoder).__qualname__, sorted(vars(encoder).items()))
    text = repr([[None if m is None else tuple(m) for m in marks], kind, profile, options])
    return hashlib.sha256(text.encode()).hexdigest()[:16]
