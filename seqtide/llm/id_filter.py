"""A filter of fixed size over ids, that keeps most unwanted texts out of a shuffle.

One bit per id in an array of 2^27: with up to some ten million wanted ids nearly all
other rows are dropped where they are read; with far more the filter fills up and lets
rows through, which the join behind it drops. No wanted row is ever missed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bits of the filter whatever the number of ids: 16 MB.
FILTER_BITS = 27

_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def _places(ids: np.ndarray) -> np.ndarray:
    x = ids.view(np.uint64) * _M1
    x = (x ^ (x >> np.uint64(30))) * _M2
    return (x ^ (x >> np.uint64(27))) * _M1 >> np.uint64(64 - FILTER_BITS)


def _filter_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ids -> the 64-bit words of the filter that have bits set."""
    for batch in batches:
        at = np.unique(_places(batch.column("doc_id").to_numpy()))
        word, first = np.unique(at >> np.uint64(6), return_index=True)
        if len(at):
            bits = np.bitwise_or.reduceat(np.uint64(1) << (at & np.uint64(63)), first)
            yield pa.RecordBatch.from_arrays([pa.array(word.astype(np.int64)), pa.array(bits.view(np.int64))], names=["word", "bits"])


def passing(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """doc_id, text of the rows of ``docs`` whose doc_id may be in ``wanted``; rows without an id are dropped."""
    words = wanted.select("doc_id").mapInArrow(_filter_words, "word long, bits long").groupBy("word").agg(
        F.bit_or("bits").alias("bits")).toArrow()  # at most 2^21 rows
    filled = np.zeros(1 << (FILTER_BITS - 6), np.uint64)
    filled[words.column("word").to_numpy()] = words.column("bits").to_numpy().view(np.uint64)
    shared = docs.sparkSession.sparkContext.broadcast(filled)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pc.is_valid(batch.column("doc_id")))
            at = _places(batch.column("doc_id").to_numpy())
            bits = shared.value[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))
            yield batch.filter(pa.array((bits & np.uint64(1)) == 1))
    return docs.mapInArrow(run, "doc_id long, text string")
