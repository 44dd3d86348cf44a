"""Connected components of an edge table by repeated contraction.

In each round every vertex joins its neighbour of smallest random priority, edges
are renamed and repeated ones dropped. The priorities are hashes of the vertex, so
no order of ids makes the rounds many; each is stored in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqtide.llm.skew import attach
from seqtide.session import materialise


def _renamed(edges: DataFrame, to: DataFrame, total: int) -> DataFrame:
    """``edges`` (a, b) with both ends replaced by what they joined; loops and repeats dropped."""
    half = attach(edges, to.select(F.col("v").alias("a"), F.col("m").alias("ma"), "deg"), ["a"], "deg", total)
    half = materialise(half.select(F.col("ma").alias("a"), "b"), "half-renamed")
    both = attach(half, to.select(F.col("v").alias("b"), F.col("m").alias("mb"), "deg"), ["b"], "deg", total)
    return (both.select(F.least("a", "mb").alias("a"), F.greatest("a", "mb").alias("b"))
            .where(F.col("a") != F.col("b")).distinct())


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b), longs -> v, label for every vertex of an edge; label is one of the component's vertices."""
    live = materialise(edges.where(F.col("a") != F.col("b")).select("a", "b").distinct(), "edges")
    rounds = []
    while (total := live.count()):
        ends = live.select(F.col("a").alias("v"), F.col("b").alias("u")).unionByName(
            live.select(F.col("b").alias("v"), F.col("a").alias("u")))
        least = F.min(F.struct(F.xxhash64("u").alias("h"), F.col("u")))
        hooked = ends.groupBy("v").agg(least.alias("n"), F.count("*").alias("deg"))
        own = F.struct(F.xxhash64("v").alias("h"), F.col("v").alias("u"))
        to = materialise(hooked.select("v", F.least(own, F.col("n"))["u"].alias("m"), "deg"), "hooks")
        rounds.append(to)
        live = materialise(_renamed(live, to, total), "edges")
    if not rounds:
        return edges.select(F.col("a").alias("v"), F.col("b").alias("label")).limit(0)
    found = rounds[-1].select("v", F.col("m").alias("label"))
    for to in reversed(rounds[:-1]):
        sizes = to.groupBy("m").agg(F.count("*").alias("n"))
        onward = materialise(found.select(F.col("v").alias("m"), "label").join(sizes, "m"), "labels")
        rows = to.select("v", "m")
        found = materialise(attach(rows, onward, ["m"], "n", to.count(), "left").select(
            "v", F.coalesce("label", "m").alias("label")), "labels")
    return found
