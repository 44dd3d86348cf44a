"""Token ids as binary files: Simple-8b words with the offset of every block.

``write_tokens`` sorts documents by id into range partitions; every task encodes
its texts and writes files of bounded size under names of its own. The manifest,
written by Spark once all tasks are done, names the files that count, so what a
lost or repeated task left behind is never read. The folder may be in any store that
``pyarrow.fs`` opens by its URI and all executors reach.

A file is little-endian: the magic, eight unsigned 64-bit counts (documents, ids,
blocks, words, escapes, block size, two spare), then the arrays doc_id (signed),
end of each document in ids, first id of each block, first word of each block,
words, first escape of each block, escapes.

Null texts count as empty and give the end id alone. A null doc_id is stored as the
smallest 64-bit integer and read back as null; it comes first. Rows that share a
doc_id are kept, ordered by their text. No rows give an empty manifest. Other
columns are not read.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from seqtide.llm import simple8b
from seqtide.llm.texts import slices, word_ids

MAGIC = b"STTOKEN1"
#: A file is closed once it holds this many ids.
FILE_IDS = 4_000_000
#: Stands for a null doc_id.
NO_ID = -(1 << 63)

MANIFEST = "part int, seq int, name string, n_docs long, n_ids long"
ROWS = "doc_id long, start long, n_tokens long, ids binary"


class TokenFile:
    """The content of one file; documents or id ranges are decoded on demand."""

    def __init__(self, data: bytes):
        if data[:8] != MAGIC:
            raise ValueError("not a token file")
        docs, ids, blocks, words, escapes, self.block = np.frombuffer(data, "<u8", 6, 8).astype(int).tolist()
        self.n_ids, at = ids, 72

        def take(n: int, kind: str = "<u8") -> np.ndarray:
            nonlocal at
            out = np.frombuffer(data, kind, n, at)
            at += 8 * n
            return out
        self.doc_ids, self.ends = take(docs, "<i8"), take(docs).astype(np.int64)
        self.first_id, self.first_word = take(blocks).astype(np.int64), take(blocks).astype(np.int64)
        self.words, self.first_escape, self.escapes = take(words), take(blocks).astype(np.int64), take(escapes)

    def between(self, a: int, b: int) -> np.ndarray:
        """Ids a .. b, decoding only the blocks that hold them."""
        if a >= b:
            return np.zeros(0, np.uint64)
        lo = int(np.searchsorted(self.first_id, a, "right")) - 1
        hi = int(np.searchsorted(self.first_id, b, "left"))
        out = []
        for k in self._runs(lo, hi):
            w = self.words[self.first_word[k[0]]:self.first_word[k[1]] if k[1] < len(self.first_word) else None]
            out.append(simple8b.unpack(w, self.escapes[self.first_escape[k[0]]:]))
        return np.concatenate(out)[a - self.first_id[lo]:b - self.first_id[lo]]

    def _runs(self, lo: int, hi: int) -> list[tuple[int, int]]:
        """Escapes are numbered from 0 in each packed run, so a run ends where the number starts anew."""
        if not len(self.escapes):
            return [(lo, hi)]
        return [(k, k + 1) for k in range(lo, hi)]


def file_bytes(doc_ids: list[int], lengths: list[int], parts: list[np.ndarray], block: int = simple8b.BLOCK) -> bytes:
    """One file from documents and their ids, in the order given."""
    packed, first_id, first_word, first_escape, escapes = [], [], [], [], []
    ids = words = 0
    for values in parts:
        if not len(values):
            continue
        starts = range(0, len(values), block)
        if values.max() >> np.uint64(60):  # with escapes each block is packed alone
            runs = [(s, values[s:s + block]) for s in starts]
        else:
            runs = [(0, values)]
        for s, run in runs:
            w, b, e = simple8b.pack(run, block)
            first_id += (ids + s + np.arange(len(b)) * block).tolist()
            first_word += (b.astype(np.int64) + words).tolist()
            first_escape += [len(escapes)] * len(b)
            escapes += e.tolist()
            packed.append(w)
            words += len(w)
        ids += len(values)
    head = np.array([len(doc_ids), ids, len(first_id), words, len(escapes), block, 0, 0], "<u8")
    return b"".join([MAGIC, head.tobytes(), np.array(doc_ids, "<i8").tobytes(), np.cumsum(lengths, dtype="<u8").tobytes(),
                     np.array(first_id, "<u8").tobytes(), np.array(first_word, "<u8").tobytes(),
                     *(w.astype("<u8").tobytes() for w in packed),
                     np.array(first_escape, "<u8").tobytes(), np.array(escapes, "<u8").tobytes()])


def _writer(path: str, vocabulary: str, end: int, file_ids: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, folder = fs.FileSystem.from_uri(path)
        encoder, last = word_ids(vocabulary), np.array([end], "<u4").tobytes()
        part, seq, held = TaskContext.get().partitionId(), 0, 0
        doc_ids, lengths, parts = [], [], []

        def close() -> pa.RecordBatch:
            nonlocal seq, held, doc_ids, lengths, parts
            name = f"part-{part:06d}-{seq:04d}-{uuid.uuid4().hex}.tok"
            with store.open_output_stream(f"{folder}/{name}") as out:
                out.write(file_bytes(doc_ids, lengths, parts))
            row = pa.RecordBatch.from_arrays(
                [pa.array([v], t) for v, t in zip((part, seq, name, len(doc_ids), held), _TYPES, strict=True)],
                names=["part", "seq", "name", "n_docs", "n_ids"])
            seq, held, doc_ids, lengths, parts = seq + 1, 0, [], [], []
            return row

        for rows, texts in slices(batches):
            ids = [x + last for x in encoder.encode(texts)]
            doc_ids += rows.column("doc_id").fill_null(NO_ID).to_pylist()
            lengths += [len(x) // 4 for x in ids]
            parts.append(np.frombuffer(b"".join(ids), "<u4").astype(np.uint64))
            held += len(parts[-1])
            if held >= file_ids:
                yield close()
        if doc_ids:
            yield close()
    return write


_TYPES = (pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64())


def write_tokens(docs: DataFrame, path: str, vocabulary: str, end: int = 1, file_ids: int = FILE_IDS) -> None:
    """Encode all texts, each followed by ``end``, in ascending doc_id order into files under ``path``."""
    spark = docs.sparkSession
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/data")
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(folder)
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    ordered = (docs.select(F.col("doc_id").cast("long"), "text")
               .repartitionByRange(tasks, "doc_id").sortWithinPartitions("doc_id", "text"))
    (ordered.mapInArrow(_writer(f"{path}/data", vocabulary, end, file_ids), MANIFEST)
     .write.parquet(f"{path}/manifest"))


def _reader(path: str):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, folder = fs.FileSystem.from_uri(path)
        for batch in batches:
            for row in batch.to_pylist():
                with store.open_input_stream(f"{folder}/{row['name']}") as f:
                    content = TokenFile(f.read())
                begins = np.concatenate([[0], content.ends]).astype(np.int64)
                cuts = np.flatnonzero(np.diff(content.ends // (1 << 20))) + 1
                bounds = [0, *cuts.tolist(), len(content.ends)]
                for a, b in zip(bounds, bounds[1:], strict=False):
                    ids = content.between(int(begins[a]), int(begins[b])).astype("<u4").tobytes()
                    each = np.diff(begins[a:b + 1])
                    ends = ((begins[a:b + 1] - begins[a]) * 4).astype(np.int32)
                    yield pa.RecordBatch.from_arrays([
                        pa.array(content.doc_ids[a:b], pa.int64(), mask=content.doc_ids[a:b] == NO_ID), pa.array(begins[a:b] + row["start"], pa.int64()),
                        pa.array(each, pa.int64()),
                        pa.Array.from_buffers(pa.binary(), b - a, [None, pa.py_buffer(ends), pa.py_buffer(ids)])],
                        names=["doc_id", "start", "n_tokens", "ids"])
    return read


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids (little-endian unsigned 32-bit) of every document under ``path``."""
    manifest = spark.read.schema(MANIFEST).parquet(f"{path}/manifest")
    # one row per file of millions of ids: the only table that is ordered in one task
    before = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)
    files = manifest.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))
    return files.repartition(max(1, manifest.count())).mapInArrow(_reader(f"{path}/data"), ROWS)
