"""Sequence -> vector."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import Protocol

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.resource import ResourceProfile
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqtide.functions.kmers import frequency_matrix, kmer_vector_udf
from seqtide.functions.vectors import doubles, lists
from seqtide.operators.dedup import pending


class Encoder(Protocol):
    """A model plug-in. It is shipped to each Python worker and prepared there once, however many tasks that runs.

    ``window`` is the number of letters it reads of a sequence, None for all.
    """

    dimension: int
    window: int | None

    def prepare(self) -> None: ...

    def encode(self, sequences: list[str]) -> np.ndarray: ...


class KmerEncoder:
    """Built-in baseline: hashed k-mer frequencies of unit length."""

    window = None

    def __init__(self, dimension: int = 64, k: int = 6):
        self.dimension, self.k = dimension, k

    def prepare(self) -> None:
        pass

    def encode(self, sequences: list[str]) -> np.ndarray:
        return frequency_matrix(pa.array(sequences, pa.string()), self.k, self.dimension)


#: Prepared encoders of this Python worker by digest; a worker keeps the last ones used.
_PREPARED: dict[str, Encoder] = {}
KEPT_ENCODERS = 2


def prepared_encoder(digest: str, encoder: Encoder) -> Encoder:
    """The encoder of that digest which this worker has prepared before, else ``encoder``, prepared now."""
    found = _PREPARED.pop(digest, None)
    if found is None:
        encoder.prepare()
        found = encoder
    _PREPARED[digest] = found
    while len(_PREPARED) > KEPT_ENCODERS:
        del _PREPARED[next(iter(_PREPARED))]
    return found


def encode_sequences(records: DataFrame, encoder: Encoder, batch: int = 32, key: str = "accession",
                     profile: ResourceProfile | None = None) -> DataFrame:
    """key and float vector per record, the encoder fed ``batch`` sequences of similar length at a time.

    ``profile`` places the tasks, on executors with an accelerator for instance.
    """
    digest = hashlib.sha256(cloudpickle.dumps(encoder)).hexdigest()

    def run(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = None
        for table in tables:
            if model is None:  # tasks without rows load nothing
                model = prepared_encoder(digest, encoder)
            # sequences of a batch are padded to the longest, so similar lengths go together
            order = pc.sort_indices(pc.fill_null(pc.utf8_length(table.column(1)), 0))
            table = table.take(order)
            for start in range(0, table.num_rows, batch):
                part = table.slice(start, batch)
                vectors = model.encode([s or "" for s in part.column(1).to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), lists(np.asarray(vectors, np.float32))],
                    names=[key, "embedding"])
    kind = records.schema[key].dataType.simpleString()
    return records.select(key, "sequence").mapInArrow(run, f"`{key}` {kind}, embedding array<float>", profile=profile)


def kmer_vectors(records: DataFrame, dimension: int = 64, k: int = 6) -> DataFrame:
    """The built-in encoder as a column expression."""
    return records.select("accession", kmer_vector_udf(k, dimension)("sequence").alias("embedding"))


def encode_pending(records: DataFrame, done: DataFrame, encoder: Encoder, batch: int = 32) -> DataFrame:
    """Vectors for the records that have none yet."""
    return encode_sequences(pending(records, done), encoder, batch)


def tokens(sequence: Column | str, k: int = 6) -> Column:
    """Consecutive, non-overlapping words of k letters."""
    return F.regexp_extract_all(sequence, F.lit(f"(.{{1,{k}}})"), F.lit(1))


def truncate_tokens(words: Column | str, max_tokens: int) -> Column:
    """The context window of a model: the first ``max_tokens`` tokens."""
    return F.slice(words, 1, max_tokens)


def context_window(records: DataFrame, encoder: Encoder) -> DataFrame:
    """Records whose sequences end with the last letter the encoder reads; whole ones if it reads all."""
    window = getattr(encoder, "window", None)
    return records if window is None else records.withColumn("sequence", F.substring("sequence", 1, window))


def mean_pool(token_vectors: DataFrame, key: str, vector: str = "embedding",
              mask: str | None = None) -> DataFrame:
    """Mean vector per key over its unmasked tokens.

    Sums are formed per task before the shuffle, so one key with most of the tokens
    costs no more than any other.
    """
    rows = token_vectors if mask is None else token_vectors.where(F.col(mask) == 1)
    per_dim = (rows.select(key, F.posexplode(doubles(vector)).alias("dim", "x"))
               .groupBy(key, "dim").agg(F.avg("x").alias("x")))
    packed = F.sort_array(F.collect_list(F.struct("dim", "x")))  # one entry per dimension
    return per_dim.groupBy(key).agg(F.transform(packed, lambda s: s["x"]).alias(vector))
