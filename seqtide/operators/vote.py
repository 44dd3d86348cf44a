"""Rank-wise vote of nearest neighbours and the rules applied to it."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqtide.config import RANKS
from seqtide.functions.text import blank
from seqtide.operators.skew import salted_join

# The words used where no name is given.
UNKNOWN = "Unknown"
AMBIGUOUS = "Unknown (ambiguous clade)"


def resolved_lineages(base: DataFrame, lookup: DataFrame | None, key: str = "accession") -> DataFrame:
    """One lineage per key: the whole row of the lookup table if it has the key, else
    the names stored with the vector."""
    own = base.select(key, *[blank(F.col(f"`{r}`")).alias(r) for r in RANKS])
    if lookup is None:
        return own
    other = lookup.select(key, F.lit(True).alias("_found"),
                          *[blank(F.col(f"`{r}`")).alias(f"_{r}") for r in RANKS])
    joined = own.join(other, key, "full")
    return joined.select(key, *[F.when(F.col("_found"), F.col(f"_{r}")).otherwise(F.col(f"`{r}`")).alias(r)
                                for r in RANKS])


def neighbour_names(neighbours: DataFrame, lineages: DataFrame, key: str = "accession") -> DataFrame:
    """Neighbour rows with seven names, null for a neighbour without a lineage: it is
    counted and names nothing. A popular neighbour is salted."""
    names = lineages.select(F.col(key).alias("neighbour_id"), *[f"`{r}`" for r in RANKS])
    return salted_join(neighbours, names, "neighbour_id", "left")


def _tally(names: Column) -> Column:
    """Count, order of appearance (negative) and text of each distinct name."""
    return F.transform(F.array_distinct(names), lambda name, i: F.struct(
        F.size(F.filter(names, lambda x: x == name)).alias("n"), (-i).alias("seen"), name.alias("name")))


def vote(named: DataFrame) -> DataFrame:
    """query_id, n_neighbours and per rank a struct (name, confidence).

    The k neighbours of a query are packed into one row by the only shuffle, then all
    seven ranks are counted in place; empty names leave the count.
    """
    near = F.sort_array(F.collect_list(F.struct("rn", *[f"`{r}`" for r in RANKS])))
    packed = named.groupBy("query_id").agg(near.alias("near"))
    keep = ["query_id", "n_neighbours"]
    # one step per projection: an expression used twice below is computed once
    names = packed.select("query_id", F.size("near").alias("n_neighbours"), *[
        F.filter(F.col(f"near.`{r}`"), lambda x: x.isNotNull() & (x != "")).alias(r) for r in RANKS])
    # the greatest entry has the highest count, then the earliest appearance
    best = names.select(*keep, *[F.struct(F.array_max(_tally(F.col(f"`{r}`"))).alias("top"),
                                          F.size(f"`{r}`").alias("of")).alias(r) for r in RANKS])
    return best.select(*keep, *[_named(
        F.coalesce(F.col(f"`{r}`.top.name"), F.lit(UNKNOWN)),
        F.coalesce(F.round(F.col(f"`{r}`.top.n") / F.col(f"`{r}`.of"), 4), F.lit(0.0))).alias(r) for r in RANKS])


def with_all(voted: DataFrame, queries: DataFrame) -> DataFrame:
    """A row for every ``query_id``: those without neighbours have 0 of them and no names."""
    none = _named(UNKNOWN, 0.0)
    return queries.select("query_id").join(voted, "query_id", "left").select(
        "query_id", F.coalesce("n_neighbours", F.lit(0)).alias("n_neighbours"),
        *[F.coalesce(F.col(f"`{r}`"), none).alias(r) for r in RANKS])


def _named(name: str | Column, confidence: float | Column) -> Column:
    wrap = lambda x: x if isinstance(x, Column) else F.lit(x)
    return F.struct(wrap(name).alias("name"), wrap(confidence).alias("confidence"))


def family_rule(voted: DataFrame, family_floor: float = 0.95, genus_floor: float = 0.5) -> DataFrame:
    """A sure family with a split genus: genus unnamed (share kept), species unnamed at 0."""
    split = (F.col("family.confidence") >= family_floor) & (F.col("genus.confidence") < genus_floor)
    return voted.withColumns({
        "genus": F.when(split, _named(UNKNOWN, F.col("genus.confidence"))).otherwise(F.col("genus")),
        "species": F.when(split, _named(UNKNOWN, 0.0)).otherwise(F.col("species"))})


def ambiguous_rule(voted: DataFrame, probability: str = "cluster_probability",
                   below: float = 0.85) -> DataFrame:
    """A weak cluster member gets no genus and species; comes after the family rule."""
    weak = F.col(probability) < below
    return voted.withColumn("is_ambiguous_clade", weak).withColumns({
        r: F.when(weak, _named(AMBIGUOUS, 0.0)).otherwise(F.col(r)) for r in ("genus", "species")})


def assignment_records(ruled: DataFrame) -> DataFrame:
    """The nested output record."""
    return ruled.select(
        F.col("query_id").alias("accession"), F.col("cluster_id").cast("int").alias("cluster_id"),
        F.round(F.col("cluster_probability").cast("double"), 4).alias("cluster_probability"),
        "is_ambiguous_clade", F.struct(*[f"`{r}`" for r in RANKS]).alias("taxonomy"),
        F.col("n_neighbours").alias("n_reference_neighbours"))


def rank_report(records: DataFrame) -> DataFrame:
    """Per rank: mean confidence and share without a name. One aggregate row, then turned."""
    def of(rank: str, field: str) -> Column:
        return F.col(f"taxonomy.`{rank}`.{field}")
    sums = records.agg(*[x for r in RANKS for x in (
        F.avg(of(r, "confidence")).alias(f"c_{r}"),
        F.avg(F.startswith(of(r, "name"), F.lit(UNKNOWN)).cast("double")).alias(f"u_{r}"))])
    rows = [F.struct(F.lit(i).alias("level"), F.lit(r).alias("rank"), F.col(f"c_{r}").alias("mean_confidence"),
                     F.col(f"u_{r}").alias("share_unknown")) for i, r in enumerate(RANKS)]
    return sums.select(F.inline(F.array(*rows)))


def adjusted_rand(pairs: DataFrame, left: str, right: str) -> DataFrame:
    """Adjusted Rand index of two labelings, from their contingency table."""
    def two(n: Column) -> Column:
        n = n.cast("double")
        return n * (n - 1) / 2
    cells = pairs.groupBy(left, right).agg(F.count("*").alias("n"))
    both = cells.agg(F.sum(two(F.col("n"))).alias("both"), F.sum("n").alias("rows"))
    rows_side = cells.groupBy(left).agg(F.sum("n").alias("n")).agg(F.sum(two(F.col("n"))).alias("lefts"))
    cols_side = cells.groupBy(right).agg(F.sum("n").alias("n")).agg(F.sum(two(F.col("n"))).alias("rights"))
    parts = [d.withColumn("one", F.lit(1)) for d in (both, rows_side, cols_side)]
    joined = reduce(lambda x, y: x.join(y, "one"), parts)
    expected = F.col("lefts") * F.col("rights") / two(F.col("rows"))
    ceiling = (F.col("lefts") + F.col("rights")) / 2
    return joined.select(F.when(ceiling == expected, 1.0).otherwise(
        (F.col("both") - expected) / (ceiling - expected)).alias("adjusted_rand"))
