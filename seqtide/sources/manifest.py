"""Audit of files on storage against a manifest of checksums."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def file_checksums(spark: SparkSession, paths: str | list[str], pattern: str = "*") -> DataFrame:
    """Path, length and MD5 of each file (binaryFile limits a file to 2 GB)."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
            .option("pathGlobFilter", pattern).load(paths)
            .select("path", "length", F.md5("content").alias("md5")))


def audit(manifest: DataFrame, found: DataFrame) -> DataFrame:
    """Status per manifest path: ``ok`` (skip), ``corrupt`` or ``missing`` (fetch again)."""
    joined = manifest.select("path", F.col("md5").alias("expected")).join(
        found.select("path", F.col("md5").alias("actual")), "path", "left")
    status = (F.when(F.col("actual").isNull(), "missing")
              .when(F.col("actual") == F.col("expected"), "ok").otherwise("corrupt"))
    return joined.select("path", status.alias("status"))
