"""Candidate pairs by MinHash that also find a sequence inside a far longer one.

A sequence is the set of its k-mers whose hash is below 1/``scale`` of the range: the same share of every
set, whatever its size. A part's set is therefore a subset of the whole's, which the k smallest hashes of
each are not, and both Jaccard similarity and containment are estimated from the kept hashes alone.

Every kept hash is a bucket, and all holders of one are candidates: blocks of sets meet each other, see ``set_blocks``. Where
``near`` is given, a sequence meets only the longest holder and the next few by length, so candidates grow with the number of
kept hashes; hot buckets are salted and their order is cut into blocks. The sets of these candidates are then intersected, in
groups to which a set travels once.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqtide.functions.kmers import codes_udf, scaled_codes_udf, scaled_kmers_udf
from seqtide.operators import set_blocks
from seqtide.operators.homology import NEXT_HOLDERS, followers
from seqtide.operators.skew import dense_index, salted_join
from seqtide.session import materialise

# 15 letters: half of the k-mers of a copy with 3 % changed letters survive. One hash in 32: 200 letters keep
# six, and none once in 400.
K, SCALE = 15, 32
#: Share of the smaller set that must be in the larger one: 15-letter windows of 94 % identity.
MIN_CONTAINMENT = 0.4


def scaled_sets(records: DataFrame, k: int = K, scale: int = SCALE) -> DataFrame:
    """accession, length, hashes (ascending) of every sequence that keeps one."""
    return (records.select("accession", F.length("sequence").alias("length"), scaled_kmers_udf(k, scale)("sequence").alias("hashes"))
            .where(F.size("hashes") > 0))


def bucket_pairs(sets: DataFrame, near: int = NEXT_HOLDERS) -> DataFrame:
    """Distinct longer, shorter (names): the sequences of stored ``sets`` (number, hashes, and name if rows share one) that
    meet in a bucket.

    Numbers go by length, longest first, so a row of a bucket is a few numbers and carries neither accession nor length.
    """
    named = [F.col("name")] if "name" in sets.columns else []
    own = "name" if named else "accession"
    rows = materialise(sets.select(F.col("number").alias("accession"), F.lit(0).alias("length"), *named, F.explode("hashes").alias("hash")), "buckets")
    longest = materialise(rows.groupBy("hash").agg(F.min_by(own, "accession").alias("longest"), F.count("*").alias("n")).where(F.col("n") > 1), "longest")
    held = materialise(salted_join(rows, longest, "hash", weights=longest.select("hash", "n")), "held")
    first = held.where(F.col(own) != F.col("longest")).select(F.col("longest").alias("longer"), F.col(own).alias("shorter"))
    more = followers(held.where(F.col("n") > 2).select("hash", "accession", "length", *named), "hash", near)
    return first.unionByName(more.select(F.col(f"one.{own}").alias("longer"), F.col(f"other.{own}").alias("shorter"))).distinct()


def shared_names(sets: DataFrame) -> DataFrame:
    """name (the least number), numbers of the accessions that several rows of ``sets`` have."""
    return sets.groupBy("accession").agg(F.collect_list("number").alias("numbers")).where(F.size("numbers") > 1).select(
        "accession", F.array_min("numbers").alias("name"), "numbers")


def each_row(pairs: DataFrame, shared: DataFrame) -> DataFrame:
    """Pairs of names as pairs of numbers: every row of the one with every row of the other."""
    for side in ("longer", "shorter"):
        joined = salted_join(pairs, shared.select(F.col("name").alias(side), "numbers"), side, "left")
        pairs = joined.withColumn(side, F.explode(F.coalesce("numbers", F.array(side)))).select("longer", "shorter")
    return materialise(pairs, "row-pairs")


#: Bytes of the sets of one side that a group holds, and pairs that it compares, about.
SIDE_BYTES, GROUP_PAIRS = 64 << 20, 1 << 22
#: Hashes that are looked up at a time.
LOOKED_UP = 4 << 20


def _counted(pairs: pa.Table, sets: pa.Table) -> pa.Table:
    """longer, shorter, shared, n_long, n_short of the pairs of one group; each set is there once."""
    lists = sets["hashes"].combine_chunks()
    flat, ends = lists.flatten().to_numpy(), np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy())])
    number = sets["number"].to_numpy()
    by = np.argsort(number, kind="stable")
    longer, shorter = pairs["longer"].to_numpy(), pairs["shorter"].to_numpy()
    order = np.argsort(longer, kind="stable")
    longer, shorter = longer[order], shorter[order]
    i, j = by[np.searchsorted(number, longer, sorter=by)], by[np.searchsorted(number, shorter, sorter=by)]
    size = np.diff(ends)
    shared = np.zeros(len(i), np.int64)
    begins = np.flatnonzero(np.diff(i, prepend=-1))
    for a, z in zip(begins, np.append(begins, len(i))[1:], strict=True):
        own = flat[ends[i[a]]:ends[i[a] + 1]]
        while a < z:  # partners in runs of bounded size
            n = size[j[a:z]]
            stop = a + max(1, int(np.searchsorted(np.cumsum(n), LOOKED_UP)))
            n, firsts = n[:stop - a], ends[j[a:stop]]
            sought = flat[np.arange(int(n.sum())) + np.repeat(firsts - (np.cumsum(n) - n), n)]
            at = np.searchsorted(own, sought)
            at[at == len(own)] = 0
            seen = np.concatenate([[0], np.cumsum(own[at] == sought)])
            shared[a:stop] = seen[np.cumsum(n)] - seen[np.cumsum(n) - n]
            a = stop
    return pa.table({"longer": longer, "shorter": shorter, "shared": shared, "n_long": size[i], "n_short": size[j]})


def counted_pairs(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """longer, shorter, shared, n_long, n_short of stored ``pairs`` of numbers.

    Pairs are cut into a grid of blocks of longer by blocks of shorter ones. A set travels once to each group of its row and
    column, whatever the number of its pairs, and a pair is two numbers.
    """
    size = sets.agg(F.sum(F.size("hashes"))).first()[0] or 0
    blocks = max(1, -(-8 * size // SIDE_BYTES), math.ceil(math.sqrt(pairs.count() / GROUP_PAIRS)))
    place = lambda c: F.pmod(F.xxhash64(c), F.lit(blocks)).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    slim = sets.select("number", "hashes")
    sent = slim.select(place("number").alias("row"), every.alias("column"), "number", "hashes").unionByName(
        slim.select(every.alias("row"), place("number").alias("column"), "number", "hashes").where("row <> column"))
    met = pairs.select(place("longer").alias("row"), place("shorter").alias("column"), "longer", "shorter")
    return met.groupBy("row", "column").cogroup(sent.groupBy("row", "column")).applyInArrow(
        _counted, "longer long, shorter long, shared long, n_long long, n_short long")


def similar_pairs(records: DataFrame, k: int = K, scale: int = SCALE, min_containment: float = MIN_CONTAINMENT,
                  near: int | None = None, among: DataFrame | None = None) -> DataFrame:
    """longer, shorter, shared, jaccard, containment of the pairs of distinct sequences that share a kept hash and
    whose smaller set lies in the other one to at least ``min_containment``; with ``near`` only of those that meet as one
    of the next so many, or the longest, in a bucket. ``among``: only accessions that are there.

    Both shares are estimated on the kept hashes. Sequences that keep no hash, empty ones
    and those shorter than k are in no pair; of equal sequences give one only. Rows that share an accession are in its pairs each. Of two as long the smaller name is ``longer``.
    """
    sets = materialise(records.select(F.monotonically_increasing_id().alias("id"), "accession", F.length("sequence").alias("length"),
                                      scaled_codes_udf(k, scale)("sequence").alias("s")).select("id", "accession", "length", "s.*"), "scaled", "zstd")
    slim = sets.where("n > 0").select("id", "accession", (-F.col("length")).alias("_less"))
    slim = slim if among is None else slim.join(among, "accession", "left_semi")
    kept = materialise(dense_index(slim, ["_less", "accession"], "number").select("id", "number", "accession"), "kept")
    shared = materialise(shared_names(kept.where("accession is not null")), "shared-names")
    if shared.isEmpty():
        blocks = set_blocks.stored_blocks(sets, kept.withColumn("several", F.lit(False)), SIDE_BYTES // 32)
        return set_blocks.block_pairs(blocks, min_containment) if near is None else set_blocks.near_pairs(blocks, max(1, blocks.count()), min_containment, near)
    if near is not None:
        return _near_pairs(records if among is None else records.join(among, "accession", "left_semi"), k, scale, min_containment, near)
    known = materialise(salted_join(kept, shared.select("accession", "name"), "accession", "left", stored=True), "known")
    blocks = set_blocks.stored_blocks(sets, known.select("id", "number", "accession", F.col("name").isNotNull().alias("several")), SIDE_BYTES // 32)
    alone = set_blocks.block_pairs(blocks, min_containment, several=False)
    alike = set_blocks.block_pairs(blocks, min_containment, several=True, named=False)
    return alone.unionByName(_shared_pairs(alike, sets, known.withColumn("name", F.coalesce("name", "number")), shared, min_containment))


def _shared_pairs(alike: DataFrame, sets: DataFrame, known: DataFrame, shared: DataFrame, min_containment: float) -> DataFrame:
    """The pairs in which an accession is that several rows have: if a row of one meets a later row of the other, all rows of
    the one with all of the other; and with each other, if two of its rows meet in a bucket that a third holds."""
    named = known.select("number", "name")
    pairs = materialise(alike, "several")
    for side in ("longer", "shorter"):
        pairs = salted_join(pairs.withColumnRenamed(side, "number"), named, "number").withColumnRenamed("name", side).drop("number")
    other = pairs.where("longer <> shorter").select(F.least("longer", "shorter").alias("longer"), F.greatest("longer", "shorter").alias("shorter"))
    rows = sets.join(known.select("id", "number", "name"), "id").select("number", "name", codes_udf()("codes").alias("hashes"))
    own = rows.join(shared.select("name"), "name", "left_semi").select("name", F.explode("hashes").alias("hash"))
    own = materialise(own.groupBy("hash", "name").agg(F.count("*").alias("n")).where("n > 1").select("hash", "name"), "own")
    hold = rows.select(F.explode("hashes").alias("hash")).join(own.select("hash").distinct(), "hash", "left_semi").groupBy("hash").agg(F.count("*").alias("n"))
    itself = own.join(hold.where("n > 2"), "hash").select(F.col("name").alias("longer"), F.col("name").alias("shorter"))
    met = each_row(materialise(other.unionByName(itself).distinct(), "names"), shared)
    numbers = met.select(F.col("longer").alias("number")).unionByName(met.select(F.col("shorter").alias("number"))).distinct()
    counted = materialise(counted_pairs(met, materialise(rows.join(numbers, "number", "left_semi").select("number", "hashes"), "row-sets")), "counted")
    for side in ("longer", "shorter"):
        counted = salted_join(counted, known.select(F.col("number").alias(side), F.col("name").alias(f"{side}_name"), F.col("accession").alias(f"{side}_accession")), side)
    counted = materialise(counted.where("shared > 0"), "counted-names")
    turned = counted.select(*[F.col({"longer": "shorter", "shorter": "longer"}[c.partition("_")[0]] + c[len(c.partition("_")[0]):]).alias(c)
                              if c.startswith(("longer", "shorter")) else F.col(c) for c in counted.columns])
    sides = ["longer_name", "shorter_name"]
    both = counted.unionByName(turned.where("longer_name <> shorter_name"))
    order = both.where("longer < shorter or longer_name = shorter_name").select(*sides).distinct()
    smaller = F.least("n_long", "n_short")
    return both.join(order, sides, "left_semi").select(
        F.col("longer_accession").alias("longer"), F.col("shorter_accession").alias("shorter"), F.col("shared").cast("int").alias("shared"),
        (F.col("shared") / (F.col("n_long") + F.col("n_short") - F.col("shared"))).alias("jaccard"),
        (F.col("shared") / smaller).alias("containment")).where(F.col("containment") >= min_containment)


def _near_pairs(records: DataFrame, k: int, scale: int, min_containment: float, near: int) -> DataFrame:
    """``similar_pairs`` of those that meet as ``near`` ones in a bucket, where several rows have an accession."""
    sets = materialise(scaled_sets(records, k, scale).withColumn("_less", -F.col("length")), "scaled")  # numbering reads them twice
    sets = materialise(dense_index(sets, ["_less", "accession"], "number").select("number", "accession", "hashes"), "sets")
    shared = materialise(shared_names(sets), "shared-names")
    if shared.isEmpty():
        pairs = materialise(bucket_pairs(sets, near), "bucket-pairs")
    else:
        known = salted_join(sets, shared.select("accession", "name"), "accession", "left", stored=True).withColumn("name", F.coalesce("name", "number"))
        pairs = each_row(materialise(bucket_pairs(known, near), "bucket-pairs"), shared)
    counted = counted_pairs(pairs, sets)
    smaller = F.least("n_long", "n_short")
    alike = materialise(counted.select("longer", "shorter", F.col("shared").cast("int").alias("shared"), (
        F.col("shared") / (F.col("n_long") + F.col("n_short") - F.col("shared"))).alias("jaccard"),
        (F.col("shared") / smaller).alias("containment")).where(F.col("containment") >= min_containment), "alike")
    names = sets.select("number", "accession")
    named = salted_join(alike.withColumnRenamed("longer", "number"), names.withColumnRenamed("accession", "longer"), "number", stored=True).drop("number")
    named = salted_join(named.withColumnRenamed("shorter", "number"), names.withColumnRenamed("accession", "shorter"), "number")
    return named.select("longer", "shorter", "shared", "jaccard", "containment")


def recall(planted: DataFrame, pairs: DataFrame) -> DataFrame:
    """kind, planted, found: how many of the ``planted`` pairs (kind, a, b) are among ``pairs``."""
    named = planted.select("kind", F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    known = pairs.select(F.least("longer", "shorter").alias("a"), F.greatest("longer", "shorter").alias("b"), F.lit(True).alias("found"))
    return named.join(known, ["a", "b"], "left").groupBy("kind").agg(
        F.count("*").alias("planted"), F.count("found").alias("found"))
