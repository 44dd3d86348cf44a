"""Run ledger: what each stage did, as rows of a table."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seqtide.session import scratch

SCHEMA = "run string, stage string, metric string, value double"
ELAPSED = "elapsed_s"
# A metric of this name and a fingerprint says when a stage was built, and from what.
BUILT = "built:"


class Ledger:
    """Append-only table of (run, stage, metric, value) under ``path``."""

    def __init__(self, spark: SparkSession, path: str, run: str = "default"):
        self.spark, self.path, self.run = spark, path, run

    def rows(self) -> DataFrame:
        try:
            return self.spark.read.schema(SCHEMA).parquet(self.path)
        except AnalysisException:  # nothing written yet
            return self.spark.createDataFrame([], SCHEMA)

    def done(self, stage: str, output: str, fingerprint: str = "") -> bool:
        """True when the newest table of the stage was built from what ``fingerprint`` names and is there."""
        own = (F.col("run") == self.run) & (F.col("stage") == stage) & F.startswith("metric", F.lit(BUILT))
        newest = self.rows().where(own).agg(F.max_by("metric", "value")).first()[0]
        if newest != BUILT + fingerprint:
            return False
        try:
            self.spark.read.parquet(output)
        except AnalysisException:  # the table was removed
            return False
        return True

    def record(self, stage: str, **metrics: float) -> None:
        rows = [(self.run, stage, m, float(v)) for m, v in metrics.items()]
        self.spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(self.path)

    def stage(self, name: str, output: str, build: Callable[[], DataFrame], metric: str = "rows",
              force: bool = False, fingerprint: str = "") -> DataFrame:
        """Build and store a stage once; a later run with the same fingerprint reads what is stored."""
        if force or not self.done(name, output, fingerprint):
            began = time.monotonic()
            with scratch(self.spark):
                build().write.mode("overwrite").parquet(output)
            count = self.spark.read.parquet(output).count()
            self.record(name, **{metric: count, ELAPSED: time.monotonic() - began, BUILT + fingerprint: time.time()})
        return self.spark.read.parquet(output)


def run_summary(ledger: DataFrame, stages: list[str]) -> DataFrame:
    """One row per run: minutes per stage, null where the stage has not run."""
    spent = ledger.where(F.col("metric") == ELAPSED)
    return spent.groupBy("run").pivot("stage", stages).agg(F.round(F.sum("value") / 60, 4))


def stage_status(ledger: DataFrame, stages: list[str]) -> DataFrame:
    """run, stage, done, minutes for every stage of every run."""
    spent = (ledger.where(F.col("metric") == ELAPSED).groupBy("run", "stage")
             .agg(F.sum("value").alias("seconds")))
    every = ledger.select("run").distinct().select(
        "run", F.explode(F.array(*[F.lit(s) for s in stages])).alias("stage"))
    return every.join(spent, ["run", "stage"], "left").select(
        "run", "stage", F.col("seconds").isNotNull().alias("done"),
        F.round(F.coalesce("seconds", F.lit(0.0)) / 60, 4).alias("minutes"))
