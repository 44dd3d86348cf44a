"""An inverted-file index as stored tables that grow by appending.

``vectors`` holds the indexed rows, ``codes`` their distinct codes with ids, both by cell. New vectors are
assigned to the cells that stand, quantised with the same rotation and written beside the old
rows; nothing that is stored is read again, but for the ids, by which rows that are known already are left out.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seqtide.operators import ivf


@dataclass(frozen=True)
class IndexTable:
    """The index under ``path`` with its fixed ``centroids`` (cells x dimension) and rotation ``seed``."""

    spark: SparkSession
    path: str
    centroids: np.ndarray
    dimension: int
    key: str = "accession"
    vector: str = "embedding"
    seed: int | None = 42

    def _read(self, name: str) -> DataFrame | None:
        try:
            return self.spark.read.parquet(f"{self.path}/{name}")
        except AnalysisException as e:
            if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            return None

    @property
    def vectors(self) -> DataFrame:
        found = self._read("vectors")
        if found is None:
            raise ValueError(f"no index at {self.path}")
        return found

    @property
    def codes(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/codes")

    def append(self, rows: DataFrame) -> None:
        """Index the rows whose key is not stored yet, one per key; vectors that cannot be searched are left out.

        Codes are made from the vectors as written, so both tables hold the same rows; what a
        broken append has left without codes is found by ``repair``.
        """
        fresh = rows.where(F.col(self.key).isNotNull()).dropDuplicates([self.key])
        stored = self._read("vectors")
        number = 0
        if stored is not None:
            fresh = fresh.join(stored.select(self.key), self.key, "left_anti")
            number = (stored.agg(F.max("part")).first()[0] or 0) + 1
        built = ivf.build_index(fresh, self.centroids, self.dimension, self.vector, self.seed).withColumn("part", F.lit(number))
        built.repartition("cell", F.pmod(F.xxhash64(self.key), F.lit(8))).write.mode("append").partitionBy("cell", "part").parquet(f"{self.path}/vectors")
        self.repair()

    def repair(self) -> None:
        """Write the codes of parts that have none."""
        known = self._read("codes")
        parts = self.vectors.select("part").distinct()  # one row per append
        if known is not None:
            parts = parts.join(known.select("part").distinct(), "part", "left_anti")
        for row in parts.orderBy("part").collect():
            codes = ivf.code_table(self.vectors.where(F.col("part") == row["part"]).drop("part"), self.key)
            codes.withColumn("part", F.lit(row["part"])).write.mode("append").partitionBy("cell", "part").parquet(f"{self.path}/codes")

    def search(self, queries: DataFrame, k: int, *, query_id: str | None = None, **options) -> DataFrame:
        """Neighbours (query_id, neighbour_id, distance, rn) through the stored codes."""
        return ivf.search(queries, self.vectors, self.centroids, k, query_id=query_id or self.key, base_id=self.key, dimension=self.dimension,
                          vector=self.vector, seed=self.seed, codes=self.codes, **options)

    def lookup(self, query: np.ndarray, k: int, **options) -> DataFrame:
        """Neighbours of one vector, in one job over the probed cells."""
        return ivf.lookup_vector(query, self.vectors.drop("part"), self.centroids, k, base_id=self.key, dimension=self.dimension,
                                 vector=self.vector, seed=self.seed, **options)
