"""Representatives per taxon, keep-list filters and exact copies."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqtide.operators.skew import salted_join


def representatives(metadata: DataFrame, group: str = "taxId", value: str = "accession",
                    order: str | None = None) -> DataFrame:
    """One value per group, the first in ``order``; the null group counts as one.

    Both forms combine on the map side, so a group with a third of all rows is
    reduced before the shuffle.
    """
    pick = F.min(value) if order in (None, value) else F.min_by(value, order)
    return metadata.groupBy(group).agg(pick.alias("representative"))


def head(rows: DataFrame, order: list[str], n: int) -> DataFrame:
    """The first n rows in ``order``; each task keeps n at most."""
    return rows.orderBy(*order).limit(n)


def distinct_groups(metadata: DataFrame, group: str = "taxId") -> DataFrame:
    """Number of distinct groups: exact, and a sketch estimate for very large inputs."""
    return metadata.agg(F.countDistinct(group).alias("distinct_groups"),
                        F.approx_count_distinct(group).alias("approximate_groups"))


def keep(records: DataFrame, keys: DataFrame, on: str = "accession") -> DataFrame:
    """Records whose key is on the list; keys may repeat."""
    return records.join(keys.select(on), on, "left_semi")


def pending(records: DataFrame, done: DataFrame, on: str = "accession") -> DataFrame:
    """Records not yet processed; independent of any order, so safe to restart."""
    return records.join(done.select(on), on, "left_anti")


def with_digest(records: DataFrame, text: str = "sequence") -> DataFrame:
    return records.withColumn("digest", F.sha2(F.col(text), 256))


def copy_groups(records: DataFrame, key: str = "accession", text: str = "sequence") -> DataFrame:
    """digest, representative (smallest key) and copy count of identical sequences."""
    return (with_digest(records, text).groupBy("digest")
            .agg(F.min(key).alias("representative"), F.count("*").alias("n")))


def copy_map(records: DataFrame, groups: DataFrame, key: str = "accession",
             text: str = "sequence") -> DataFrame:
    """key -> representative of its identical copies; heavy digests are salted."""
    facts = with_digest(records, text).select(key, "digest")
    return salted_join(facts, groups.select("digest", "representative"), "digest",
                       weights=groups.select("digest", "n")).select(key, "representative")
