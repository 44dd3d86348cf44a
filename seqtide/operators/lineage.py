"""Accession -> taxon -> seven-rank lineage."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqtide.config import RANKS
from seqtide.functions.text import blank, present, taxid_of
from seqtide.operators.skew import salted_join
from seqtide.session import Rounds
from seqtide.sources.metadata import last_wins

MAX_ROUNDS = 40


def merge_maps(header_map: DataFrame, metadata_map: DataFrame) -> DataFrame:
    """Union of two accession -> taxid maps; the metadata entry wins."""
    left = header_map.select("accession", F.col("taxid").alias("header_taxid"))
    right = metadata_map.select("accession", F.col("taxid").alias("metadata_taxid"))
    return left.join(right, "accession", "full").select(
        "accession", F.coalesce("metadata_taxid", "header_taxid").alias("taxid"))


def header_map(records: DataFrame, position: str = "position") -> DataFrame:
    """accession -> taxid for records that carry one in the header; the last one by
    ``position`` wins."""
    found = records.select("accession", taxid_of("header").alias("taxid"), F.col(position).alias("position"))
    return last_wins(found.where(present("accession") & present("taxid")), "accession", "position")


def tree_lineages(tree: DataFrame, fill: bool = True, merged: DataFrame | None = None) -> DataFrame:
    """tax_id and the names at the seven ranks, for every node of the tree.

    Path doubling: each node carries the rank names seen on its way up and a jump
    pointer; joining a node with the node it points to doubles the length of the
    way. A tree of depth D needs about log2(D) joins. Upper nodes are pointed to by
    a large share of all nodes, hence the salted join. ``merged`` (old_id, new_id)
    adds the retired ids.
    """
    names = [f"_{r}" for r in RANKS]
    state = tree.select(
        "tax_id", F.when(F.col("parent_id") != F.col("tax_id"), F.col("parent_id")).alias("up"),
        *[F.when(F.col("rank") == r, F.col("name")).alias(n) for r, n in zip(RANKS, names)])
    rounds = Rounds(tree.sparkSession, "lineage")
    for _ in range(MAX_ROUNDS):
        state = rounds.keep(state.withColumn("open", F.col("up").isNotNull()), "open").drop("open")
        if not rounds.flagged:
            break
        active = state.where(F.col("up").isNotNull())
        target = state.select(F.col("tax_id").alias("up"), F.col("up").alias("next_up"),
                              *[F.col(n).alias(f"p{n}") for n in names])
        moved = salted_join(active, target, "up", "left", stored=True).select(
            "tax_id", F.col("next_up").alias("up"),
            *[F.coalesce(n, f"p{n}").alias(n) for n in names])
        state = state.where(F.col("up").isNull()).unionByName(moved)
    else:
        raise ValueError("the tree holds a cycle")
    lineages = state.select("tax_id", *_filled(names, fill))
    if merged is not None:
        old = merged.join(lineages, F.col("new_id") == F.col("tax_id")).select(
            F.col("old_id").alias("tax_id"), *[f"`{r}`" for r in RANKS])
        lineages = lineages.unionByName(old)
    return lineages


def _filled(names: list[str], fill: bool):
    """Rank columns; a gap is named after the nearest higher rank that is known."""
    out, above = [], F.lit(None).cast("string")
    for rank, name in zip(RANKS, names):
        known = F.nullif(F.col(name), F.lit(""))
        gap = F.concat(F.lit("unclassified "), above, F.lit(f" {rank}"))
        out.append(blank(F.coalesce(known, gap) if fill else known).alias(rank))
        above = F.coalesce(known, above)
    return out


def annotate(taxid_map: DataFrame, lineages: DataFrame) -> DataFrame:
    """accession, taxid, ranks for taxa with a lineage (one lineage row per taxid)."""
    return salted_join(taxid_map.select("accession", "taxid"), lineages, "taxid") \
        .select("accession", "taxid", *[f"`{r}`" for r in RANKS])


def unmatched(taxid_map: DataFrame, lineages: DataFrame) -> DataFrame:
    """The complement of ``annotate``."""
    return taxid_map.join(lineages.select("taxid"), "taxid", "left_anti").select("accession", "taxid")


def coverage(taxid_map: DataFrame, lineages: DataFrame) -> DataFrame:
    """How many accessions have a lineage; counted per taxon first, so the join is slim."""
    per_taxon = taxid_map.groupBy("taxid").agg(F.count("*").alias("n"))
    known = lineages.select("taxid").distinct().withColumn("known", F.lit(True))
    joined = per_taxon.join(known, "taxid", "left")
    return joined.agg(
        F.coalesce(F.sum(F.when(F.col("known"), F.col("n"))), F.lit(0)).alias("annotated"),
        F.coalesce(F.sum(F.when(F.col("known").isNull(), F.col("n"))), F.lit(0))
        .alias("without_lineage"),
        F.count("taxid").alias("distinct_taxids"))


def attach_lineage(rows: DataFrame, lineages: DataFrame, key: str = "accession") -> DataFrame:
    """Left join on the key; whatever is missing becomes the empty string."""
    fields = ["taxid", *RANKS]
    joined = rows.join(lineages.select(key, *[f"`{f}`" for f in fields]), key, "left")
    return joined.select(*rows.columns, *[blank(F.col(f"`{f}`")).alias(f) for f in fields])
