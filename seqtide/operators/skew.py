"""Equi-joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seqtide.session import materialise

# A key is salted when it holds more than one in so many fact rows (or, in smaller tables,
# more than ``hot_rows``), so fewer than this many keys are, and no other key outweighs
# the share of one task.
HOT_SHARE = 1 << 16


def salted_join(facts: DataFrame, dim: DataFrame, on: list[str] | str, how: str = "inner",
                hot_rows: int = 100_000, weights: DataFrame | None = None,
                stored: bool = False) -> DataFrame:
    """``facts JOIN dim`` where ``dim`` has one row per key and ``facts`` may be skewed.

    Keys with more than ``hot_rows`` fact rows are cut into salts of about that
    many rows each; the one matching ``dim`` row is repeated per salt. ``how`` is
    ``inner`` or ``left``. Everything is decided on counted rows: ``weights`` (keys,
    ``n``) saves the counting pass; without it ``facts`` are written once, unless
    ``stored`` says that they are a table, so that counting does not compute them
    twice. Fact rows with a null key match nothing and stay out of the shuffle.
    """
    keys = [on] if isinstance(on, str) else list(on)
    if weights is None:
        if not stored:
            facts = materialise(facts, "facts")
        total = facts.count()
        if total <= hot_rows:  # then no key can have more
            return facts.join(dim, keys, how)
        weights = facts.groupBy(*keys).agg(F.count("*").alias("n"))
    else:
        total = weights.agg(F.sum("n")).first()[0] or 0
        if total <= hot_rows:
            return facts.join(dim, keys, how)
    bound = max(hot_rows, total // HOT_SHARE)
    nameless = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    hot = (weights.where((F.col("n") > bound) & ~nameless)
           .select(*keys, F.ceil(F.col("n") / bound).cast("int").alias("_salts")))
    # the place of a row, not its content: equal rows must not share a salt
    spread = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.col("_salts")).cast("int")
    facts_salted = (facts.where(~nameless).join(F.broadcast(hot), keys, "left")
                    .withColumn("_salt", F.when(F.col("_salts").isNull(), 0).otherwise(spread))
                    .drop("_salts"))
    dim_salted = (dim.join(F.broadcast(hot), keys, "left")
                  .withColumn("_salt", F.explode(F.sequence(
                      F.lit(0), F.coalesce(F.col("_salts"), F.lit(1)) - 1)))
                  .drop("_salts"))
    joined = facts_salted.join(dim_salted, keys + ["_salt"], how).drop("_salt")
    if how == "left":
        names = [c for c in dim.columns if c not in keys]
        alone = facts.where(nameless).select(*joined.columns[:len(facts.columns)], *[
            F.lit(None).cast(dim.schema[c].dataType).alias(c) for c in names])
        joined = joined.unionByName(alone)
    return joined


def dense_index(df: DataFrame, order: list[str], name: str = "idx") -> DataFrame:
    """Number the rows 0..n-1 in ``order`` without one global sort task.

    Range partitions are sorted on their own; the only thing gathered is one row
    count per partition, which becomes that partition's offset.
    """
    part = (df.repartitionByRange(*order).sortWithinPartitions(*order)
            .withColumn("_at", F.monotonically_increasing_id()))
    part = materialise(part.withColumn("_part", F.shiftright("_at", 33).cast("int")), "dense")
    offsets = (part.groupBy("_part").agg(F.count("*").alias("_n"))
               .withColumn("_offset", F.sum("_n").over(
                   Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))))
    # one row per range partition: bounded by the partition count, not the data
    joined = part.join(F.broadcast(offsets), "_part")
    mask = F.lit((1 << 33) - 1)
    return joined.withColumn(name, F.coalesce("_offset", F.lit(0)) + F.col("_at").bitwiseAND(mask)) \
        .drop("_part", "_at", "_n", "_offset")
