"""Classification of all sequences as one batch plan."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqtide.config import FULL, Profile
from seqtide.operators import ivf
from seqtide.operators.knn import exact_knn
from seqtide.operators.vote import (ambiguous_rule, assignment_records, family_rule,
                                    neighbour_names, resolved_lineages, vote, with_all)


def from_neighbours(neighbours: DataFrame, lineages: DataFrame, clusters: DataFrame,
                    profile: Profile = FULL, key: str = "accession",
                    queries: DataFrame | None = None) -> DataFrame:
    """Assignment records from neighbours (query_id, neighbour_id, rn).

    ``lineages`` has one row per ``key``; ``clusters`` has query_id, cluster_id and
    cluster_probability. With ``queries`` every ``key`` in it gets a record, whether it
    has neighbours or not. A query without a cluster row is noise: cluster -1 with
    probability 0.
    """
    voted = vote(neighbour_names(neighbours, lineages, key))
    if queries is not None:
        voted = with_all(voted, queries.select(F.col(key).alias("query_id")))
    placed = voted.join(clusters, "query_id", "left").withColumns({
        "cluster_id": F.coalesce("cluster_id", F.lit(-1)),
        "cluster_probability": F.coalesce("cluster_probability", F.lit(0.0))})
    ruled = family_rule(placed, profile.family_floor, profile.genus_floor)
    return assignment_records(ambiguous_rule(ruled, below=profile.ambiguous_below))


def classify_exact(vectors: DataFrame, lineages: DataFrame, clusters: DataFrame, *,
                   key: str = "accession", vector: str = "embedding", labelled_only: bool = False,
                   exclude_self: bool = False, lookup: DataFrame | None = None,
                   queries: DataFrame | None = None, profile: Profile = FULL) -> DataFrame:
    """Vote among exact neighbours. ``labelled_only`` leaves out base rows without a
    taxid; ``lookup`` overrides the stored lineage of the accessions it has."""
    base = labelled(vectors, lineages, key) if labelled_only else vectors
    queries = vectors if queries is None else queries
    near = exact_knn(queries, base, profile.vote_neighbours,
                     query_id=key, base_id=key, vector=vector, exclude_self=exclude_self,
                     block_rows=profile.block_rows)
    return from_neighbours(near, resolved_lineages(lineages, lookup, key), clusters, profile, key, queries)


def classify_indexed(queries: DataFrame, index: DataFrame, centroids: np.ndarray,
                     lineages: DataFrame, clusters: DataFrame, *, dimension: int,
                     key: str = "accession", vector: str = "embedding",
                     lookup: DataFrame | None = None, exclude_self: bool = False,
                     seed: int | None = 42, profile: Profile = FULL, codes: DataFrame | None = None) -> DataFrame:
    """The same vote among neighbours found through the index: the form for large tables.

    ``codes`` is the stored code table of the index, which else is made for this call. Vectors that cannot be searched (null, not finite, zero) get a record as well.
    """
    near = ivf.search(queries, index, centroids, profile.vote_neighbours, query_id=key, base_id=key,
                      dimension=dimension, probes=profile.probes, refine=profile.refine,
                      vector=vector, seed=seed, exclude_self=exclude_self,
                      block_rows=profile.block_rows, codes=codes)
    return from_neighbours(near, resolved_lineages(lineages, lookup, key), clusters, profile, key, queries)


def labelled(vectors: DataFrame, lineages: DataFrame, key: str) -> DataFrame:
    """Vectors whose lineage row carries a taxid."""
    return vectors.join(lineages.where("taxid is not null and taxid <> ''").select(key), key, "left_semi")
