"""Packing by powers of two: no sequence crosses documents and none needs padding.

A document of n ids is cut into as many pieces of the full sequence length as it
holds and one piece for each binary digit of the rest. Pieces of equal length form
a bucket; each piece is a sequence of that length. A training run draws batches
from one bucket at a time.

The number of a sequence is built from its bucket, the task and the place in the
task, so neither a sort nor a count over all pieces is needed; the same input
files give the same numbers.

Null texts count as empty: the end id alone, one piece of length 1. Rows that
share a doc_id are packed each. No rows give no pieces. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from seqtide.llm.texts import CACHE_WORDS, slices, word_ids

PIECES = "doc_id long, start long, length long, ids binary, doc_tokens long, bucket int, sequence_id long, offset long"
_TYPES = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int32(), pa.int64(), pa.int64())
#: Bits of a sequence number for the place in the task and for the task.
PLACE_BITS, TASK_BITS = 32, 24


def lengths_of(n: int, largest: int) -> list[int]:
    """Piece lengths of n ids: full sequences, then the binary digits of the rest."""
    rest = n % largest
    return [largest] * (n // largest) + [1 << b for b in reversed(range(rest.bit_length())) if rest >> b & 1]


def _packer(vocabulary: str, end: int, largest: int, remembered: int):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, last = word_ids(vocabulary, remembered), np.array([end], "<u4").tobytes()
        task, places = TaskContext.get().partitionId(), {}
        for rows, texts in slices(batches):
            out: list[tuple] = []
            for doc, ids in zip(rows.column("doc_id").to_pylist(), encoder.encode(texts), strict=True):
                ids += last
                n, start = len(ids) // 4, 0
                for length in lengths_of(n, largest):
                    bucket = length.bit_length() - 1
                    place = places[bucket] = places.get(bucket, -1) + 1
                    number = (bucket << TASK_BITS | task) << PLACE_BITS | place
                    out.append((doc, start, length, ids[4 * start:4 * (start + length)], n, bucket, number, 0))
                    start += length
            yield pa.RecordBatch.from_arrays(
                [pa.array(column, kind) for column, kind in zip(zip(*out, strict=True), _TYPES, strict=True)],
                names=["doc_id", "start", "length", "ids", "doc_tokens", "bucket", "sequence_id", "offset"])
    return pack


def pack(docs: DataFrame, vocabulary: str, end: int = 1, largest: int = 2048, remembered: int = CACHE_WORDS) -> DataFrame:
    """Every piece of every document with its ids, bucket (log2 of the length) and sequence.

    A worker remembers the ids of ``remembered`` words, fewer where other stages need its memory too.
    """
    if largest & (largest - 1):
        raise ValueError("the sequence length must be a power of two")
    return docs.select("doc_id", "text").mapInArrow(_packer(vocabulary, end, largest, remembered), PIECES)


def write_buckets(pieces: DataFrame, path: str) -> None:
    """Store sequences in one folder per length."""
    pieces.write.partitionBy("bucket").parquet(path)
