"""JSON-lines metadata and plain key lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seqtide.functions.text import present, valid_key

# An explicit schema: no inference pass, and only these fields are materialised.
SCHEMA = "accession string, taxId long, _corrupt_record string"


def read_metadata(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """One row per JSON line, broken lines included (``_corrupt_record`` is set).

    ``position`` orders the rows as they stand in the files.
    """
    return (spark.read.schema(SCHEMA).option("mode", "PERMISSIVE").json(paths)
            .select("*", file_position().alias("position")))


def file_position() -> Column:
    """Sortable place of a row: file, block, then row order within the block."""
    return F.struct(F.col("_metadata.file_path").alias("path"),
                    F.col("_metadata.file_block_start").alias("block"),
                    F.monotonically_increasing_id().alias("row"))


def taxid_map(metadata: DataFrame, restrict_to: DataFrame | None = None) -> DataFrame:
    """accession -> taxid from usable rows; the last row of an accession wins."""
    rows = metadata.where(F.col("_corrupt_record").isNull()) \
        if "_corrupt_record" in metadata.columns else metadata
    rows = rows.where(valid_key("accession", "taxId"))
    if restrict_to is not None:
        rows = rows.join(restrict_to.select("accession").distinct(), "accession", "left_semi")
    return last_wins(rows.select("accession", F.col("taxId").cast("string").alias("taxid"),
                                 "position"), "accession", "position")


def last_wins(rows: DataFrame, key: str, position: str) -> DataFrame:
    """One row per key: the one with the greatest position."""
    value = [c for c in rows.columns if c not in (key, position)]
    # max_by combines on the map side, so a key repeated everywhere costs one row per task
    best = rows.groupBy(key).agg(F.max_by(F.struct(*value), position).alias("_v"))
    return best.select(key, *[F.col("_v")[c].alias(c) for c in value])


def read_keys(spark: SparkSession, paths: str | list[str], name: str = "accession",
              position: bool = False) -> DataFrame:
    """A key per line, trimmed, blank lines dropped; ``position`` adds the sortable place of the line."""
    trimmed = F.regexp_replace("value", r"^\s+|\s+$", "")
    place = [file_position().alias("position")] if position else []
    return spark.read.text(paths).select(trimmed.alias(name), *place).where(present(name))
