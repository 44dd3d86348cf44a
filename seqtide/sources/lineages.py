"""Lineage tables, tool output and the taxonomy tree dump."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seqtide.config import RANKS
from seqtide.sources.metadata import file_position, last_wins

LINEAGE_SCHEMA = "accession string, taxid string, " + ", ".join(f"`{r}` string" for r in RANKS)


def read_lineage_tsv(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """The annotation table, keyed by accession; a later duplicate wins."""
    rows = (spark.read.schema(LINEAGE_SCHEMA).option("sep", "\t").option("header", "true").csv(paths)
            .select("*", file_position().alias("position")).na.fill(""))
    return last_wins(rows, "accession", "position")


def parse_lineage_lines(lines: DataFrame, value: str = "value") -> DataFrame:
    """Tab-separated tool output -> taxid and trimmed ranks; bad lines dropped."""
    fields = F.split(F.col(value), "\t")
    return lines.where(good_lineage_line(value)).select(
        fields[0].alias("taxid"), *[F.trim(fields[i + 1]).alias(r) for i, r in enumerate(RANKS)])


def good_lineage_line(value: str = "value"):
    """At least eight fields and a numeric id."""
    fields = F.split(F.col(value), "\t")
    return (F.size(fields) >= len(RANKS) + 1) & fields[0].rlike("^[0-9]+$")


def read_tree_dump(spark: SparkSession, nodes: str, names: str) -> DataFrame:
    """``nodes.dmp`` and ``names.dmp`` -> tax_id, parent_id, rank, scientific name."""
    def cells(path: str):
        return spark.read.text(path).select(F.split("value", r"\t\|\t?").alias("f"))
    node = cells(nodes).select(F.col("f")[0].cast("long").alias("tax_id"),
                               F.col("f")[1].cast("long").alias("parent_id"),
                               F.col("f")[2].alias("rank"))
    name = (cells(names).where(F.col("f")[3] == "scientific name")
            .select(F.col("f")[0].cast("long").alias("tax_id"), F.col("f")[1].alias("name")))
    return node.join(name, "tax_id", "left")
