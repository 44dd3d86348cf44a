"""Writers. Each is a plain Spark write, so commits are atomic per job."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqtide.config import RANKS
from seqtide.functions.text import blank


def write_keys(keys: DataFrame, path: str, column: str = "accession",
               order: str | None = None) -> None:
    """One key per line, optionally in the order of another column, nulls last."""
    if order:
        keys = keys.orderBy(F.col(order).asc_nulls_last())
    keys.select(column).write.mode("overwrite").text(path)


def fasta_text(records: DataFrame) -> DataFrame:
    return records.select(F.concat(F.lit(">"), "header", F.lit("\n"), "sequence").alias("value"))


def write_fasta(records: DataFrame, path: str, compression: str | None = None) -> None:
    """Header and sequence as FASTA part files named ``*.fasta``-compatible text."""
    writer = fasta_text(records).write.mode("overwrite")
    (writer.option("compression", compression) if compression else writer).text(path)


def write_lineage_tsv(lineages: DataFrame, path: str) -> None:
    columns = ["accession", "taxid", *RANKS]
    (lineages.select(*[blank(F.col(f"`{c}`").cast("string")).alias(c) for c in columns])
     .write.mode("overwrite").option("sep", "\t").option("header", "true")
     .option("emptyValue", "").csv(path))


def write_vectors(vectors: DataFrame, path: str, mode: str = "errorifexists",
                  by_cell: bool = False) -> None:
    """``mode``: errorifexists, append (resume), overwrite (force) or ignore (skip)."""
    writer = vectors.write.mode(mode)
    (writer.partitionBy("cell") if by_cell else writer).parquet(path)


def write_assignments(assignments: DataFrame, path: str) -> None:
    """Nested records, one JSON object per line."""
    assignments.write.mode("overwrite").json(path)


def viewer_table(manifold: DataFrame, dims: int, coords: str = "coords") -> DataFrame:
    """Coordinates as ``umap_i`` float columns, then label, probability, accession."""
    return manifold.select(
        *[F.col(coords)[i].cast("float").alias(f"umap_{i}") for i in range(dims)],
        F.col("cluster_label").cast("int").alias("cluster_label"),
        F.col("cluster_probability").cast("float").alias("cluster_probability"), "accession")


def from_viewer_table(wide: DataFrame, prefix: str = "umap_") -> DataFrame:
    """Back to one coordinate array, columns in numeric order."""
    dims = sorted((c for c in wide.columns if c.startswith(prefix)),
                  key=lambda c: int(c[len(prefix):]))
    return wide.select("accession", F.array(*dims).alias("coords"),
                       "cluster_label", "cluster_probability")


def row_bytes(dims: int, accession_bytes: int = 24) -> int:
    return 4 * dims + 8 + accession_bytes


def write_viewer_table(wide: DataFrame, path: str, dims: int, limit_bytes: int) -> None:
    """Export in files that stay below the transfer limit, whatever the row count."""
    rows = max(1, math.floor(limit_bytes / row_bytes(dims)))
    wide.write.mode("overwrite").option("maxRecordsPerFile", rows).parquet(path)


#: Files that one task writes where there is one for each key.
FILES_PER_TASK = 256


def write_file_per_key(rows: DataFrame, key: str, path: str) -> None:
    """The text ``value`` of each key as a file in a folder of its own.

    A file costs the same however little it holds, so keys are dealt out to as many tasks as their number asks for, and every
    task puts its files in place itself: neither one writer nor the driver goes through all of them.
    """
    tasks = max(rows.sparkSession.sparkContext.defaultParallelism, -(-rows.count() // FILES_PER_TASK))
    (rows.repartition(tasks, key).write.option("mapreduce.fileoutputcommitter.algorithm.version", "2")
     .partitionBy(key).text(path))
