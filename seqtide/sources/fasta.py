"""FASTA as a DataFrame: one row per record, split and read in parallel."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seqtide.functions.text import accession_of, blank, present

# A record starts at a ">" that opens a line, so this separator cuts the file into
# records; a ">" inside a line never cuts. Splits of one big file work as usual.
RECORD_SEPARATOR = "\n>"


def parse_records(raw: DataFrame) -> DataFrame:
    """``value`` holding one raw record -> accession, header, sequence (+ other columns)."""
    rest = [c for c in raw.columns if c != "value"]
    text = F.regexp_replace(F.regexp_replace("value", "^>", ""), "\r", "")
    lines = F.split(text, "\n", 2)
    header = F.rtrim(lines[0])
    # lines are stripped on the right, then joined
    sequence = F.regexp_replace(blank(F.get(lines, F.lit(1))), r"[ \t]*(\n|$)", "")
    return (raw.select(accession_of(header).alias("accession"), header.alias("header"),
                       sequence.alias("sequence"), *rest))


def read_fasta(spark: SparkSession, paths: str | list[str], pattern: str = "*.{fasta,fna}",
               preamble: bool = True, position: bool = False) -> DataFrame:
    """All records of all matching files below ``paths``, with their file.

    Records without an accession (a bare ``>``) are dropped; ``rejected_records``
    counts them. Text before the first ``>`` of a file is no record; finding it costs a
    scan of the first block of each file, which ``preamble=False`` saves for files that
    are known to begin with a record. ``position`` adds the sortable place of a record.
    """
    raw = raw_records(spark, paths, pattern)
    if preamble:
        raw = without_preamble(raw)
    if position:
        raw = raw.withColumn("position", F.struct("path", "block", "row"))
    parsed = parse_records(raw.drop("block", "row"))
    return parsed.where(present("accession"))


def raw_records(spark: SparkSession, paths: str | list[str],
                pattern: str = "*.{fasta,fna}") -> DataFrame:
    return (spark.read.option("lineSep", RECORD_SEPARATOR).option("pathGlobFilter", pattern)
            .option("recursiveFileLookup", "true").text(paths)
            .select("value", F.col("_metadata.file_path").alias("path"),
                    F.col("_metadata.file_block_start").alias("block"))
            # rows of one file block keep their order within a task
            .withColumn("row", F.monotonically_increasing_id()))


def without_preamble(raw: DataFrame) -> DataFrame:
    """Drop each file's first piece when it does not open with ``>``.

    The piece is found again by its text, not its row number, which another scan may
    count differently: within a file's first block no record has the text of the
    preamble. At most one short row per file is joined.
    """
    digest = F.xxhash64("value")
    first = (raw.where(F.col("block") == 0).groupBy("path")
             .agg(F.min_by(F.struct(digest.alias("digest"), F.startswith("value", F.lit(">")).alias("marked")),
                           "row").alias("f")))
    bad = first.where(~F.col("f.marked")).select("path", F.lit(0).cast("long").alias("block"), F.col("f.digest").alias("digest"))
    return raw.withColumn("digest", digest).join(bad, ["path", "block", "digest"], "left_anti").select(*raw.columns)


def rejected_records(spark: SparkSession, paths: str | list[str],
                     pattern: str = "*.{fasta,fna}") -> DataFrame:
    """Per file: records, and how many have no accession."""
    parsed = parse_records(raw_records(spark, paths, pattern).select("value", "path"))
    return parsed.groupBy("path").agg(
        F.count("*").alias("records"),
        F.count_if(~present("accession")).alias("without_accession"))


def count_records(records: DataFrame) -> DataFrame:
    """Number of records; unlike a byte count it ignores ``>`` inside headers."""
    return records.agg(F.count("*").alias("records"))
