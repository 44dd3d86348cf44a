"""Checks on vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqtide.functions.vectors import doubles, norm


def embedding_report(vectors: DataFrame, vector: str = "embedding") -> DataFrame:
    """Row count, dimensions, NaN / Inf counts and norm statistics over all rows."""
    v = doubles(vector)
    nans = F.size(F.filter(v, lambda x: F.isnan(x)))
    infs = F.size(F.filter(v, lambda x: F.abs(x) == float("inf")))
    rows = vectors.select(F.size(v).alias("d"), nans.alias("nans"), infs.alias("infs"),
                          norm(v).alias("norm"))
    clean = F.when((F.col("nans") == 0) & (F.col("infs") == 0), F.col("norm"))
    return rows.agg(
        F.count("*").alias("vectors"), F.min("d").alias("min_dimension"),
        F.max("d").alias("max_dimension"), F.sum("nans").alias("nan_values"),
        F.sum("infs").alias("inf_values"), F.avg(clean).alias("norm_mean"),
        F.stddev_pop(clean).alias("norm_std"), F.min(clean).alias("norm_min"),
        F.max(clean).alias("norm_max"))


def unpaired_keys(vectors: DataFrame, ids: DataFrame, key: str = "accession") -> DataFrame:
    """Keys that stand in only one of the two tables."""
    left = vectors.select(key).distinct().withColumn("has_vector", F.lit(True))
    right = ids.select(key).distinct().withColumn("has_id", F.lit(True))
    return left.join(right, key, "full").where(
        F.col("has_vector").isNull() | F.col("has_id").isNull()).select(
        key, F.coalesce("has_vector", F.lit(False)).alias("has_vector"),
        F.coalesce("has_id", F.lit(False)).alias("has_id"))
