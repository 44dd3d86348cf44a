"""Components and minimum spanning forests of edge tables, in a logarithmic number of rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqtide.operators.skew import salted_join
from seqtide.session import Rounds, materialise


def components(vertices: DataFrame, edges: DataFrame, by: list[str] | None = None) -> DataFrame:
    """``vertices`` (by..., v), ``edges`` (by..., a, b) -> by..., v, component.

    ``component`` is the smallest vertex reached. Each round hooks a vertex and its
    parent to the smallest grandparent among its neighbours and shortens the way to
    the root. ``by`` columns keep separate graphs apart in one job.
    """
    by = by or []
    spark = vertices.sparkSession
    both = edges.select(*by, "a", "b").unionByName(
        edges.select(*by, F.col("b").alias("a"), F.col("a").alias("b")))
    both = materialise(both.where(F.col("a") != F.col("b")).distinct(), "edges")
    hub = materialise(both.groupBy(*by, "b").agg(F.count("*").alias("n")), "hubs")
    lowest = both.groupBy(*by, F.col("a").alias("v")).agg(F.min("b").alias("low"))
    start = vertices.select(*by, "v").join(lowest, [*by, "v"], "left").select(
        *by, "v", F.least("v", "low").alias("p"), F.lit(True).alias("changed"))
    rounds = Rounds(spark, "components")
    state = rounds.keep(start, "changed")
    while rounds.flagged:
        parents = state.select(*by, F.col("v").alias("p"), F.col("p").alias("gp"))
        grand = materialise(salted_join(state.select(*by, "v", "p"), parents, [*by, "p"], stored=True), "grand")
        seen = salted_join(both, grand.select(*by, F.col("v").alias("b"), "gp"), [*by, "b"], weights=hub)
        best = seen.groupBy(*by, F.col("a").alias("v")).agg(F.min("gp").alias("best"))
        hooked = grand.join(best, [*by, "v"], "left").select(
            *by, "v", "p", "gp", F.least("gp", "best").alias("best"))
        offers = (hooked.select(*by, F.col("p").alias("v"), "best")
                  .unionByName(hooked.select(*by, "v", "best"))
                  .groupBy(*by, "v").agg(F.min("best").alias("offer")))
        state = rounds.keep(
            state.select(*by, "v", "p").join(offers, [*by, "v"], "left").select(
                *by, "v", F.least("p", "offer").alias("q"), F.col("p").alias("old"))
            .select(*by, "v", F.col("q").alias("p"), (F.col("q") != F.col("old")).alias("changed")), "changed")
    return state.select(*by, "v", F.col("p").alias("component"))


def roots(pointers: DataFrame) -> DataFrame:
    """``pointers`` (v, p), acyclic but for roots that point to themselves -> v, root."""
    rounds = Rounds(pointers.sparkSession, "roots")
    state = pointers.select("v", "p")
    while True:
        # the way is followed twice per stored round, so it shrinks to a third
        step = state.select(F.col("v").alias("p"), F.col("p").alias("q"))
        once = salted_join(state, step, "p").select("v", "p", F.col("q"))
        twice = salted_join(once, step.select(F.col("p").alias("q"), F.col("q").alias("r")), "q")
        state = rounds.keep(twice.select("v", F.col("r").alias("p"),
                                         (F.col("r") != F.col("p")).alias("moved")), "moved")
        if not rounds.flagged:
            return state.select("v", F.col("p").alias("root"))
        state = state.select("v", "p")


def spanning_forest(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b, w) -> the edges of its minimum spanning forest.

    Boruvka rounds: every component takes its lightest edge out, components joined by
    such edges become one. Equal weights are ordered by the vertex pair, so the result
    does not depend on partitioning. Parallel edges between two components shrink to
    the lightest before the next round.
    """
    spark = edges.sparkSession
    tidy = (edges.where(F.col("a") != F.col("b"))
            .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "w")
            .groupBy("a", "b").agg(F.min("w").alias("w")))
    live, kept = Rounds(spark, "live"), Rounds(spark, "forest")
    current = live.keep(tidy.select(F.col("a").alias("ca"), F.col("b").alias("cb"),
                                    F.struct("w", "a", "b").alias("e"), F.lit(True).alias("open")), "open")
    chosen = None
    while live.flagged:
        out = (current.select(F.col("ca").alias("c"), F.col("cb").alias("to"), "e")
               .unionByName(current.select(F.col("cb").alias("c"), F.col("ca").alias("to"), "e")))
        lightest = materialise(out.groupBy("c").agg(F.min(F.struct("e", "to")).alias("m"))
                               .select("c", "m.e", "m.to"), "lightest")
        picked = lightest.select("e.a", "e.b", "e.w").distinct()
        chosen = kept.keep(picked if chosen is None else chosen.unionByName(picked))
        # two components may choose one another; the smaller of such a pair is the root
        back = lightest.select(F.col("c").alias("to"), F.col("to").alias("back"))
        pointers = salted_join(lightest.select("c", "to"), back, "to", stored=True).select(
            F.col("c").alias("v"),
            F.when((F.col("back") == F.col("c")) & (F.col("c") < F.col("to")), F.col("c"))
            .otherwise(F.col("to")).alias("p"))
        root = materialise(roots(pointers), "root")
        weights = current.groupBy("cb").agg(F.count("*").alias("n"))
        moved = salted_join(current.drop("open"), root.select(F.col("v").alias("ca"), F.col("root").alias("ra")),
                            "ca", stored=True)
        moved = salted_join(moved, root.select(F.col("v").alias("cb"), F.col("root").alias("rb")), "cb",
                            weights=weights)
        current = live.keep(
            moved.where(F.col("ra") != F.col("rb"))
            .groupBy(F.least("ra", "rb").alias("ca"), F.greatest("ra", "rb").alias("cb"))
            .agg(F.min("e").alias("e")).withColumn("open", F.lit(True)), "open")
    if chosen is None:
        return tidy.select("a", "b", "w").limit(0)
    return chosen
