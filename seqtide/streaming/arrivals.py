"""Incremental runs: each trigger takes the files that arrived and then stops.

Every function starts one query with ``trigger(availableNow=True)`` and a checkpoint
folder; calling it again continues where the last call ended. File sinks and
``foreachBatch`` with batch ids keep the result free of repeats after a failure.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from seqtide.config import FULL, Profile
from seqtide.functions.text import present
from seqtide.operators.encode import Encoder, encode_sequences
from seqtide.plans.classify import classify_indexed
from seqtide.session import scratch
from seqtide.sources.fasta import RECORD_SEPARATOR, parse_records


def fasta_stream(spark: SparkSession, path: str, pattern: str = "*.{fasta,fna}",
                 files_per_batch: int | None = None) -> DataFrame:
    """Records of FASTA files as they arrive under ``path``."""
    reader = (spark.readStream.option("lineSep", RECORD_SEPARATOR).option("pathGlobFilter", pattern)
              .option("recursiveFileLookup", "true"))
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return parse_records(reader.text(path)).where(present("accession"))


# State lies in RocksDB on the executors' disks, and a checkpoint writes what changed: keys may outgrow the heap.
STATE = {"spark.sql.streaming.stateStore.providerClass":
         "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
         "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true"}


@contextmanager
def state_on_disk(spark: SparkSession) -> Iterator[None]:
    """Queries that start inside keep their state on disk; a query that restarts keeps the store it began with."""
    before = {key: spark.conf.get(key, None) for key in STATE}
    for key, value in STATE.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def append_to(stream: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Append to a parquet table exactly once; any state is kept on disk."""
    with state_on_disk(stream.sparkSession):
        return (stream.writeStream.format("parquet").option("path", out)
                .option("checkpointLocation", checkpoint).outputMode("append")
                .trigger(availableNow=True).start())


def ingest(spark: SparkSession, path: str, out: str, checkpoint: str, **options) -> StreamingQuery:
    return append_to(fasta_stream(spark, path, **options), out, checkpoint)


def embed(spark: SparkSession, path: str, encoder: Encoder, out: str, checkpoint: str,
          batch: int = 32, **options) -> StreamingQuery:
    """Vectors of arriving sequences."""
    return append_to(encode_sequences(fasta_stream(spark, path, **options), encoder, batch), out, checkpoint)


def first_arrivals(stream: DataFrame, key: str = "accession") -> DataFrame:
    """One record per key. The state holds every key ever seen, partitioned by key."""
    return stream.dropDuplicates([key])


def batches(stream: DataFrame, out: str, checkpoint: str,
            work: Callable[[DataFrame], DataFrame]) -> StreamingQuery:
    """Apply ``work`` to each micro-batch; a repeated batch overwrites its own folder."""
    def run(batch: DataFrame, number: int) -> None:
        with scratch(batch.sparkSession):
            work(batch).write.mode("overwrite").parquet(f"{out}/batch={number}")
    return (stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def classify(stream: DataFrame, index: DataFrame, centroids: np.ndarray, lineages: DataFrame,
             clusters: Callable[[DataFrame], DataFrame], out: str, checkpoint: str, *,
             dimension: int, key: str = "accession", seed: int | None = 42,
             profile: Profile = FULL, codes: DataFrame | None = None) -> StreamingQuery:
    """Classify arriving vectors against a fixed index.

    ``codes`` is its stored code table; without it every micro-batch makes one. ``clusters`` gives query_id, cluster_id, cluster_probability for a batch.
    """
    return batches(stream, out, checkpoint, lambda b: classify_indexed(
        b, index, centroids, lineages, clusters(b), dimension=dimension, key=key, seed=seed, profile=profile, codes=codes))


def new_only(batch: DataFrame, table: DataFrame, key: str = "accession") -> DataFrame:
    """Rows of a batch whose key is not stored yet, one per key."""
    return batch.dropDuplicates([key]).join(table.select(key), key, "left_anti")


def append_new(stream: DataFrame, table: DataFrame, out: str, checkpoint: str, key: str = "accession") -> StreamingQuery:
    """Store what is neither in ``table`` nor in an earlier batch, one row per key."""
    def run(batch: DataFrame, number: int) -> None:
        fresh = new_only(batch, table, key)
        if number:
            earlier = earlier_batches(batch.sparkSession, out, number)
            if earlier is not None:
                fresh = fresh.join(earlier.select(key), key, "left_anti")
        fresh.write.mode("overwrite").parquet(f"{out}/batch={number}")
    return (stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def earlier_batches(spark: SparkSession, out: str, number: int) -> DataFrame | None:
    """What the batches before ``number`` have stored, None where none has."""
    try:
        return spark.read.parquet(out).where(F.col("batch") < number)
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def stored_batches(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.parquet(out).drop("batch")


__all__ = ["append_new", "append_to", "batches", "classify", "embed", "fasta_stream", "first_arrivals", "ingest",
           "new_only", "state_on_disk", "stored_batches"]
