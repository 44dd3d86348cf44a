"""Vector tables, and import of vectors kept apart from their keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seqtide.functions.vectors import usable
from seqtide.operators.skew import dense_index


def read_vectors(spark: SparkSession, paths: str | list[str], key: str = "accession",
                 vector: str = "embedding") -> DataFrame:
    """Key and vector travel in one row, so nothing has to be aligned."""
    return spark.read.parquet(*([paths] if isinstance(paths, str) else paths)).select(key, vector)


def zip_by_position(ids: DataFrame, vectors: DataFrame, ids_order: list[str],
                    vectors_order: list[str]) -> DataFrame:
    """Row i of ``ids`` with row i of ``vectors``; unequal counts are an error."""
    left = dense_index(ids, ids_order, "_position")
    right = dense_index(vectors, vectors_order, "_position")
    n, m = left.count(), right.count()
    if n != m:
        raise ValueError(f"{n} keys but {m} vectors")
    return left.join(right.drop(*[c for c in right.columns if c in left.columns and c != "_position"]),
                     "_position").drop("_position")


def split_usable(vectors: DataFrame, dimension: int, vector: str = "embedding"
                 ) -> tuple[DataFrame, DataFrame]:
    """(usable rows, rejected rows): wrong length, NaN, infinite or null."""
    ok = F.coalesce(usable(vector, dimension), F.lit(False))
    return vectors.where(ok), vectors.where(~ok)
