"""Session defaults and the shared folder that holds intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

_LOCAL_DIRS: dict[str, str] = {}
_SCOPES: list[str] = []


def local_session(cpus: str = "*", partitions: int = 8, memory: str = "8g") -> SparkSession:
    """Single-JVM session for tests and the benchmark."""
    return (SparkSession.builder.master(f"local[{cpus}]").appName("seqtide")
            .config("spark.sql.shuffle.partitions", str(partitions))
            .config("spark.sql.adaptive.enabled", "true")
            .config("spark.sql.adaptive.skewJoin.enabled", "true")
            .config("spark.sql.execution.arrow.pyspark.enabled", "true")
            .config("spark.sql.session.timeZone", "UTC")
            .config("spark.driver.memory", memory)
            .config("spark.ui.enabled", "false")
            .config("spark.ui.showConsoleProgress", "false")
            .getOrCreate())


def shared_dir(spark: SparkSession) -> str:
    """Folder for intermediate tables, from ``spark.checkpoint.dir``.

    Only a local master may go without the setting: it then gets a temporary
    folder. A cluster without it is an error, because a folder on one machine
    would be lost with that machine.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    if sc.applicationId not in _LOCAL_DIRS:
        _LOCAL_DIRS[sc.applicationId] = tempfile.mkdtemp(prefix="seqtide-")
    return _LOCAL_DIRS[sc.applicationId]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path in this application's part of the shared folder."""
    folder = _SCOPES[-1] if _SCOPES else application_dir(spark)
    return f"{folder}/{label}-{uuid.uuid4().hex}"


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Intermediate tables written inside are removed at the end; store the result elsewhere before."""
    _SCOPES.append(f"{application_dir(spark)}/scope-{uuid.uuid4().hex}")
    try:
        yield
    finally:
        delete_path(spark, _SCOPES.pop())


def application_dir(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/{spark.sparkContext.applicationId}"


def drop_intermediates(spark: SparkSession) -> None:
    """Remove all intermediate tables of this application, once no result needs them."""
    delete_path(spark, application_dir(spark))


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove an intermediate table this library wrote."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def materialise(df: DataFrame, label: str, codec: str | None = None) -> DataFrame:
    """Write ``df`` as a parquet table and read it back.

    The result has no lineage, survives the loss of executors, and carries real
    size statistics, so the joins that follow are planned on facts.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    (df.write.option("compression", codec) if codec else df.write).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Rounds:
    """Tables of an iterative job: keeps the newest, drops the one before it."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.label, self._last, self.flagged = spark, label, None, 0

    def keep(self, df: DataFrame, flag: str | None = None) -> DataFrame:
        """Store ``df``. With ``flag``, the write itself counts the rows where that
        column is true, as ``self.flagged``: no extra job is needed to test for the end."""
        path = scratch_path(self.spark, self.label)
        if flag is None:
            df.write.parquet(path)
        else:
            seen = Observation()
            df.observe(seen, F.count_if(F.col(flag)).alias("flagged")).write.parquet(path)
            self.flagged = seen.get["flagged"]
        if self._last is not None:
            delete_path(self.spark, self._last)
        self._last = path
        return self.spark.read.schema(df.schema).parquet(path)

