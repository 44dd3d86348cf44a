"""Near-identical sequences by shared k-mers, linear in the number of sequences.

Each sequence offers a fixed number of k-mers; per k-mer every sequence is compared with the
longest holder and, holders being ordered by length, with the next few, so pairs grow with N,
never with N squared. All holders of a k-mer are kept, however many there are: a heavy k-mer is
salted, not cut off.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seqtide.functions.kmers import matching_bases_udf, smallest_kmers_udf
from seqtide.operators.dedup import copy_groups, copy_map
from seqtide.operators.graph import components
from seqtide.operators.skew import dense_index, salted_join
from seqtide.session import Rounds, materialise

# Joins that carry whole sequences use smaller salts than joins of slim rows.
SEQUENCE_HOT_ROWS = 5_000


def sketches(records: DataFrame, k: int = 21, count: int = 32) -> DataFrame:
    """accession, length, kmer, position: the smallest-hash k-mers of each sequence."""
    sketch = smallest_kmers_udf(k, count)
    return (records.select("accession", F.length("sequence").alias("length"),
                           F.explode(sketch("sequence")).alias("s"))
            .select("accession", "length", "s.kmer", "s.position"))


def kmer_centres(sketch: DataFrame) -> DataFrame:
    """Per shared k-mer its longest sequence (ties: smallest accession) and holder count."""
    best = F.min_by(F.struct(F.col("accession").alias("centre"),
                             F.col("length").alias("centre_length"),
                             F.col("position").alias("centre_position")),
                    F.struct(-F.col("length"), F.col("accession")))
    return (sketch.groupBy("kmer").agg(best.alias("c"), F.count("*").alias("n"))
            .where(F.col("n") > 1).select("kmer", "c.*", "n"))


#: Holders of one k-mer, next in order of length, with which each is compared besides the longest.
NEXT_HOLDERS = 2
#: Holders in order that are looked through together.
WINDOW_ROWS = 4096


def followers(holders: DataFrame, key: str, near: int) -> DataFrame:
    """``holders`` (key, accession, length, ...) -> ``one``, ``other``: every holder of a key with the ``near`` next
    ones by (length descending, accession).

    The holders are numbered in one order over all keys and looked through in blocks of that order, so a key
    that many hold is many blocks. A block also sees the first rows of the next one.
    """
    columns = [c for c in holders.columns if c != key]
    rows = dense_index(holders.withColumn("_less", -F.col("length")), [key, "_less", "accession"], "_idx")
    block, place = F.floor(F.col("_idx") / WINDOW_ROWS), F.col("_idx") % WINDOW_ROWS
    seen = rows.select(key, F.struct(*columns).alias("one"), "_idx", F.explode(
        F.when((place < near) & (block > 0), F.array(block, block - 1)).otherwise(F.array(block))).alias("_block"))
    by = Window.partitionBy("_block").orderBy("_idx")
    after = F.array(*[F.lead(F.struct(key, "one"), j).over(by) for j in range(1, near + 1)])
    return (seen.withColumn("_next", after).where(F.floor(F.col("_idx") / WINDOW_ROWS) == F.col("_block"))
            .select(key, "one", F.explode("_next").alias("n")).where(F.col(f"n.{key}") == F.col(key))
            .select("one", F.col("n.one").alias("other")))


def candidates(sketch: DataFrame, centres: DataFrame, near: int = NEXT_HOLDERS) -> DataFrame:
    """Distinct centre, member, diagonal with both lengths; the centre is the longer one, or of two as long the
    smaller name.

    Every holder of a k-mer meets its longest one and the ``near`` next ones: two that resemble each other
    are found although a longer third one, which resembles neither, holds all of their k-mers.
    """
    joined = materialise(salted_join(sketch, centres, "kmer", weights=centres.select("kmer", "n")), "holders")
    longest = joined.where(F.col("accession") != F.col("centre")).select(
        "centre", F.col("accession").alias("member"), (F.col("centre_position") - F.col("position")).alias("diagonal"),
        "centre_length", F.col("length").alias("member_length"))
    if not near:
        return longest.distinct()
    # of two holders the longest has met the other already
    more = followers(joined.where(F.col("n") > 2).select("kmer", "accession", "length", "position"), "kmer", near)
    return longest.unionByName(more.select(
        F.col("one.accession").alias("centre"), F.col("other.accession").alias("member"),
        (F.col("one.position") - F.col("other.position")).alias("diagonal"),
        F.col("one.length").alias("centre_length"), F.col("other.length").alias("member_length"))).distinct()


def overlap():
    """Letters laid over each other on the diagonal."""
    return F.least(F.col("centre_length") - F.greatest("diagonal", F.lit(0)),
                   F.col("member_length") - F.greatest(-F.col("diagonal"), F.lit(0)))


#: Letters at the end of an overlap that are compared first: so many times those that may differ in all of it, and
#: no more than bound what a worker reads at a time.
PROBE, PROBE_LETTERS = 2, 4096


def probed(close: DataFrame, text: DataFrame, weights: DataFrame, min_identity: float) -> DataFrame:
    """The pairs of ``close`` that the last letters of their overlap do not rule out.

    Letters that differ there differ in the whole overlap, so no pair that reaches ``min_identity`` is lost; most of the
    others are, before whole sequences meet. Only the letters compared travel with a pair.
    """
    share = PROBE * (1 - min_identity)
    size = F.least(F.ceil(F.col("overlap") * share) + 1, F.lit(PROBE_LETTERS), F.col("overlap")).cast("int")
    start = F.col("overlap") - F.col("_size") + 1
    # of sequences that share a name, those of another length are not judged
    ends = (close.withColumn("_size", size)
            .join(text.select(F.col("accession").alias("member"), F.col("sequence").alias("_member")), "member")
            .select(*close.columns, "_size", (F.length("_member") == F.col("member_length")).alias("_known"),
                    F.substring("_member", start + F.greatest(-F.col("diagonal"), F.lit(0)), F.col("_size")).alias("_member")))
    both = salted_join(ends, text.select(F.col("accession").alias("centre"), F.col("sequence").alias("_centre")),
                       "centre", hot_rows=SEQUENCE_HOT_ROWS, weights=weights)
    both = both.select(*close.columns, "_size", (F.col("_known") & (F.length("_centre") == F.col("centre_length"))).alias("_known"), "_member",
                       F.substring("_centre", start + F.greatest("diagonal", F.lit(0)), F.col("_size")).alias("_centre"))
    equal = both.withColumn("_equal", matching_bases_udf()("_centre", "_member", F.lit(0)))
    most = F.col("overlap") - F.col("_size") + F.col("_equal")
    return equal.where(~F.col("_known") | (most / F.col("overlap") >= min_identity)).select(*close.columns)


def aligned_pairs(pairs: DataFrame, records: DataFrame, min_identity: float,
                  min_coverage: float) -> DataFrame:
    """centre, member, identity, coverage of the pairs that pass both limits.

    Coverage of the member follows from lengths alone, so it is tested before any
    sequence is moved, and the ends of the overlaps before whole sequences are. Of
    several diagonals the best identity counts.
    """
    close = (pairs.withColumn("overlap", overlap())
             .withColumn("coverage", F.col("overlap") / F.col("member_length"))
             .where(F.col("coverage") >= min_coverage))
    close = materialise(close, "pairs")
    text = records.select("accession", "sequence")
    weights = close.groupBy("centre").agg(F.count("*").alias("n"))
    close = materialise(probed(close, text, weights, min_identity).distinct(), "open")
    with_member = close.join(text.select(F.col("accession").alias("member"),
                                         F.col("sequence").alias("member_sequence")), "member")
    weights = close.groupBy("centre").agg(F.count("*").alias("n"))
    with_both = salted_join(with_member, text.select(F.col("accession").alias("centre"),
                                                     F.col("sequence").alias("centre_sequence")),
                            "centre", hot_rows=SEQUENCE_HOT_ROWS, weights=weights)
    matches = matching_bases_udf()
    scored = with_both.select(
        "centre", "member", "centre_length", "coverage",
        (matches("centre_sequence", "member_sequence", "diagonal") / F.col("overlap"))
        .alias("identity"))
    return (scored.where(F.col("identity") >= min_identity)
            .groupBy("centre", "member", "centre_length")
            .agg(F.max(F.struct("identity", "coverage")).alias("best"))
            .select("centre", "member", "centre_length", "best.identity", "best.coverage"))


#: Pairs of sequences that are covered one after another in one group.
COVER_PAIRS = 1 << 17


def _cover(pairs: pa.Table) -> pa.Table:
    """The covered members of whole components, longest centre first."""
    members: dict[tuple[int, str], list[str]] = {}
    for centre, member, length in zip(*[pairs.column(c).to_pylist() for c in ("centre", "member", "centre_length")], strict=True):
        members.setdefault((-length, centre), []).append(member)
    covered: set[str] = set()
    for key in sorted(members):
        if key[1] not in covered:
            covered.update(members[key])
    return pa.table({"member": pa.array(sorted(covered), pa.string())})


def covered_members(pairs: DataFrame, most: int | None = None) -> DataFrame:
    """Distinct members that the greedy visit covers, of stored ``pairs`` (centre, member, centre_length).

    Components of at most ``most`` pairs (by default ``COVER_PAIRS``) are visited one after another, many of
    them in one group; only larger ones take rounds, as many as their longest chain of pairs.
    """
    most = most or COVER_PAIRS
    total = pairs.count()
    if total <= most:  # all components together are small enough for one group
        return pairs.groupBy().applyInArrow(_cover, "member string")
    ends = pairs.select(F.col("centre").alias("a"), F.col("member").alias("b"))
    vertices = ends.select(F.col("a").alias("v")).union(ends.select(F.col("b").alias("v"))).distinct()
    found = materialise(components(vertices, ends), "families")
    placed = materialise(salted_join(pairs, found.withColumnRenamed("v", "centre"), "centre", stored=True), "placed")
    sizes = materialise(placed.groupBy("component").agg(F.count("*").alias("n")), "sizes")
    sized = materialise(salted_join(placed, sizes, "component", weights=sizes), "sized")
    bundle = F.pmod(F.xxhash64("component"), F.lit(-(-total // most)))
    small = sized.where(F.col("n") <= most).groupBy(bundle.alias("bundle")).applyInArrow(_cover, "member string")
    large = sized.where(F.col("n") > most)
    return small if large.isEmpty() else small.unionByName(_covered_in_rounds(large))


def _covered_in_rounds(pairs: DataFrame) -> DataFrame:
    """As ``covered_members``: a centre that is nobody's open member is a representative, its
    members are covered, and covered ones stop covering others."""
    spark = pairs.sparkSession
    rounds, done = Rounds(spark, "cover"), Rounds(spark, "covered")
    live, covered = rounds.keep(pairs.select("centre", "member", F.lit(True).alias("open")), "open"), None
    while rounds.flagged:
        members = live.select(F.col("member").alias("centre")).distinct()
        roots = live.select("centre").distinct().join(members, "centre", "left_anti")
        fresh = salted_join(live.select("centre", "member"), roots, "centre", stored=True).select("member").distinct()
        fresh = materialise(fresh, "fresh")
        flagged = fresh.select(F.col("member").alias("centre"), F.lit(True).alias("_covered"))
        remaining = salted_join(live.select("centre", "member").join(fresh, "member", "left_anti"), flagged, "centre", "left")
        live = rounds.keep(remaining.where(F.col("_covered").isNull())
                           .select("centre", "member", F.lit(True).alias("open")), "open")
        covered = done.keep(fresh if covered is None else covered.union(fresh))
    return pairs.select("member").limit(0) if covered is None else covered


def greedy_cover(pairs: DataFrame, most: int | None = None) -> DataFrame:
    """member -> representative, for every member that does not represent itself.

    Sequences are visited longest first; one not yet covered becomes a
    representative and covers its members. A member belongs to the longest of its
    representatives.
    """
    pairs = materialise(pairs.select("centre", "member", "centre_length"), "edges")
    covered = materialise(covered_members(pairs, most), "covered")
    flagged = covered.select(F.col("member").alias("centre"), F.lit(True).alias("_covered"))
    open_pairs = (salted_join(pairs.join(covered, "member", "left_semi"), flagged, "centre", "left")
                  .where(F.col("_covered").isNull()))
    return open_pairs.groupBy("member").agg(
        F.min_by("centre", F.struct(-F.col("centre_length"), F.col("centre")))
        .alias("representative"))


def homology_clusters(records: DataFrame, k: int = 21, count: int = 32,
                      min_identity: float = 0.95, min_coverage: float = 0.80) -> DataFrame:
    """accession -> representative for every record."""
    groups = materialise(copy_groups(records), "copies")
    unique = materialise(
        records.join(groups.select(F.col("representative").alias("accession")), "accession",
                     "left_semi").select("accession", "sequence"), "unique")
    sketch = materialise(sketches(unique, k, count), "sketch")
    centres = materialise(kmer_centres(sketch), "centres")
    pairs = aligned_pairs(candidates(sketch, centres), unique, min_identity, min_coverage)
    cover = greedy_cover(pairs).select(F.col("member").alias("accession"),
                                       F.col("representative").alias("covered_by"))
    own = unique.select("accession").join(cover, "accession", "left").select(
        F.col("accession").alias("copy_of"),
        F.coalesce("covered_by", "accession").alias("representative"))
    copies = copy_map(records, groups).select("accession", F.col("representative").alias("copy_of"))
    weights = groups.select(F.col("representative").alias("copy_of"), "n")
    return salted_join(copies, own, "copy_of", weights=weights).select("accession", "representative")


def cluster_sizes(clusters: DataFrame) -> DataFrame:
    return clusters.groupBy("representative").agg(F.count("*").alias("members"))
