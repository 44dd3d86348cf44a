"""Token counts with a digest cache.

The cache is a table of (tokenizer digest, content digest, tokens). A text is
looked up by the digest of its normalised content; only contents the cache lacks
are encoded, each once, and appended. The tokenizer digest covers the vocabulary
file, the library's version and the normalisation, so a change of any of them
starts a cache of its own within the same table.

The normalisation trims and collapses ASCII white space. It holds for vocabularies
that drop white space, as ``word_bpe_49k.json`` does; for others pass
``collapse=False``.

Null texts count as empty. Rows that share a text, or repeat, share one cache entry
and get one row each. No rows give no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from importlib.metadata import version

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seqtide.llm.id_filter import passing
from seqtide.llm.skew import attach
from seqtide.llm.texts import slices, word_ids
from seqtide.session import materialise

CACHE = "tokenizer string, content binary, n_tokens long"
_SPACE = "[\\x20\\x09-\\x0D]+"


def tokenizer_digest(vocabulary: str, collapse: bool) -> str:
    with open(vocabulary, "rb") as f:
        content = hashlib.sha256(f.read()).hexdigest()
    return hashlib.sha256(f"{content} tokenizers {version('tokenizers')} {collapse}".encode()).hexdigest()


def content_digest(text: Column, collapse: bool) -> Column:
    text = F.coalesce(text, F.lit(""))
    return F.unhex(F.sha2(F.trim(F.regexp_replace(text, _SPACE, " ")) if collapse else text, 256))


def read_cache(spark: SparkSession, path: str, tokenizer: str) -> DataFrame:
    """content, n_tokens of one tokenizer, one row per content; empty where nothing is stored yet."""
    try:
        stored = spark.read.schema(CACHE).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        stored = spark.createDataFrame([], CACHE)
    # two jobs that miss the same content may both append it
    return stored.where(F.col("tokenizer") == tokenizer).groupBy("content").agg(F.max("n_tokens").alias("n_tokens"))


def _counter(vocabulary: str):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_ids(vocabulary)
        for rows, texts in slices(batches):
            n = np.diff(encoder.encode_flat(texts)[1], prepend=0)
            yield pa.RecordBatch.from_arrays([rows.column("content"), pa.array(n, pa.int64())], names=["content", "n_tokens"])
    return count


def count_tokens(docs: DataFrame, vocabulary: str, cache: str, collapse: bool = True) -> DataFrame:
    """doc_id, n_bytes, n_tokens of every row; what the table at ``cache`` lacks is appended to it."""
    spark, tokenizer = docs.sparkSession, tokenizer_digest(vocabulary, collapse)
    content = content_digest(F.col("text"), collapse)
    keys = materialise(docs.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
                                   content.alias("content")), "contents")
    sizes = materialise(keys.groupBy("content").agg(F.count("*").alias("n"), F.min("doc_id").alias("doc_id")), "sizes")
    known = read_cache(spark, cache, tokenizer)
    missing = materialise(sizes.join(known, "content", "left_anti"), "missing")
    # a content is read from one document that has it; where only rows without an id do, once from those
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    wanted = missing.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"))
    # the same plan at every size: texts move once, those already known mostly not at all
    named = passing(read, wanted).join(wanted.hint("merge"), "doc_id", "left_semi")
    nameless = (docs.where("doc_id is null").select(content.alias("content"), "text").dropDuplicates(["content"])
                .join(missing.where("doc_id is null").select("content"), "content", "left_semi"))
    fresh = (named.select("text").unionByName(nameless.select("text")).select(content.alias("content"), "text")
             .mapInArrow(_counter(vocabulary), "content binary, n_tokens long"))
    # rows that only share the id of a wanted text may bring others
    fresh = fresh.join(missing.select("content"), "content", "left_semi").dropDuplicates(["content"])
    (fresh.select(F.lit(tokenizer).alias("tokenizer"), "content", "n_tokens")
     .write.mode("append").parquet(cache))
    counted = sizes.select("content", "n").join(read_cache(spark, cache, tokenizer), "content")
    total = keys.count()
    return attach(keys, materialise(counted, "counted"), ["content"], "n", total).select("doc_id", "n_bytes", "n_tokens")
