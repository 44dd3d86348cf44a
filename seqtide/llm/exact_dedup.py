"""Exact duplicates by progressive refinement: length, then prefix hash, then full hash.

A first pass stores short keys per row: the length of the normalised text and a
hash of its first characters. Rows whose length, and then whose (length, prefix
hash), stands alone are settled. The keys of the others become a filter of fixed size, and only
the texts that pass it where they are read again are hashed in full.

Texts are equal when they are identical without ``[\\x20\\x09-\\x0D]``; null counts
as empty, so all empty texts are copies of one another. Of a group the row with the
most code points stays, then the one with the smallest doc_id (null last). Rows that
repeat an id are copies like any others, and of identical rows one stays. Other
columns, and their names, do not matter. No rows give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqtide.llm.skew import attach
from seqtide.session import materialise

_SPACE = "[\\x20\\x09-\\x0D]+"
#: Characters of the normalised text that the second key covers.
PREFIX_CHARS = 256
#: Bits of the filter of (length, prefix) keys, 512 KB whatever the number of groups.
FILTER_BITS = 22


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), _SPACE, "")


def full_hash(text: Column) -> Column:
    return F.sha2(normalised(text), 256)


def _short(text: Column, prefix_chars: int) -> Column:
    """Struct of length and prefix hash; a lambda, so that the text is normalised once."""
    return F.transform(F.array(normalised(text)), lambda t: F.struct(
        F.octet_length(t).alias("length"), F.xxhash64(F.substring(t, 1, prefix_chars)).alias("prefix")))[0]


def _id() -> Column:
    """A row's id as a key that is never null."""
    return F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))



def _place(key: Column | str) -> Column:
    """Bit of a (length, prefix) key in the filter."""
    return F.pmod(F.xxhash64(f"{key}.length", f"{key}.prefix"), F.lit(1 << FILTER_BITS))


def refined(docs: DataFrame, prefix_chars: int = PREFIX_CHARS) -> DataFrame:
    """The filter of the (length, prefix) keys that two or more rows have.

    It is a bitmap of fixed size as rows (word, bits): at most 2^16, to be broadcast whatever the number
    of groups. The more groups there are the more other rows pass it; none of a group is ever dropped.
    """
    short = materialise(docs.select(_short(F.col("text"), prefix_chars).alias("k")).select("k.length", "k.prefix"), "short-keys")
    lengths = short.groupBy("length").agg(F.count("*").alias("n")).where("n > 1")
    total = short.count()
    several = attach(short, materialise(lengths, "lengths"), ["length"], "n", total).drop("n")
    prefixes = materialise(several.groupBy("length", "prefix").agg(F.count("*").alias("n")).where("n > 1"), "prefixes")
    place = _place("k")
    words = prefixes.select(F.struct("length", "prefix").alias("k")).select(
        F.shiftright(place, 6).alias("word"), F.expr("1L").alias("one"), (place % 64).cast("int").alias("bit"))
    return materialise(words.groupBy("word").agg(F.bit_or(F.expr("shiftleft(one, bit)")).alias("bits")), "filter")


def _passing(rows: DataFrame, words: DataFrame) -> DataFrame:
    """``rows`` with k (length, prefix) and ``maybe``: whether k may be that of a group."""
    placed = rows.withColumn("_at", _place("k"))
    met = placed.join(F.broadcast(words), F.shiftright("_at", 6) == F.col("word"), "left")
    hit = F.expr("shiftright(bits, cast(_at % 64 as int)) & 1L") == 1
    return met.withColumn("maybe", F.coalesce(hit, F.lit(False))).drop("_at", "word", "bits")


def _best() -> Column:
    return F.max_by(F.struct("doc_id", "chars"), F.struct(F.col("chars"), F.col("doc_id").isNotNull(), -F.col("doc_id")))


def copies(docs: DataFrame, prefix_chars: int = PREFIX_CHARS) -> DataFrame:
    """One row per group of two or more equal texts: full (hash), group_size, keep_id, keep_chars.

    Only texts that share length and prefix with another are hashed in full; texts are not shuffled at all.
    """
    words = refined(docs, prefix_chars)
    read = docs.select("doc_id", "text", _short(F.col("text"), prefix_chars).alias("k"))
    full = _passing(read, words).where("maybe").select(
        "doc_id", F.coalesce(F.char_length("text"), F.lit(0)).alias("chars"), full_hash(F.col("text")).alias("full"))
    return (full.groupBy("full").agg(F.count("*").alias("group_size"), _best().alias("best")).where("group_size > 1")
            .select("full", "group_size", F.col("best.doc_id").alias("keep_id"), F.col("best.chars").alias("keep_chars")))


def report(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, chars, full (hash), keep_id, group_size, kept."""
    rows = materialise(docs.select("doc_id", F.coalesce(F.char_length("text"), F.lit(0)).alias("chars"),
                                   full_hash(F.col("text")).alias("full"), F.monotonically_increasing_id().alias("tag")), "digests")
    groups = materialise(copies(docs), "copies")
    found = attach(rows, groups, ["full"], "group_size", rows.count(), "left")
    alone = F.col("group_size").isNull()
    chosen = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("chars") == F.col("keep_chars"))
    # of rows that repeat the one that stays the first stays
    first = found.where(~alone & chosen).groupBy("full").agg(F.min("tag").alias("tag")).select("tag", F.lit(True).alias("first"))
    return found.join(first, "tag", "left").select(
        "doc_id", "chars", "full", F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"), (alone | F.coalesce("first", F.lit(False))).alias("kept"))


def kept(docs: DataFrame, prefix_chars: int = PREFIX_CHARS) -> DataFrame:
    """The rows of ``docs`` that stay, with the columns of ``docs``.

    Rows whose length and prefix no other row has stay as they are read: neither hashed in full nor shuffled.
    """
    names, keys = docs.columns, ["id", "full", "chars"]
    words = refined(docs, prefix_chars)
    plain = docs.select(*[F.col(f"`{n}`").alias(f"_{i}") for i, n in enumerate(names)], F.col("doc_id"), _id().alias("id"), "text",
                        _short(F.col("text"), prefix_chars).alias("k"), F.coalesce(F.char_length("text"), F.lit(0)).alias("chars"))
    tried = _passing(plain, words)
    hashed = tried.where("maybe").withColumn("full", full_hash(F.col("text")))
    stay = hashed.groupBy("full").agg(_best().alias("best")).select(
        F.coalesce(F.col("best.doc_id").cast("string"), F.lit("none")).alias("id"), "full", F.col("best.chars").alias("chars"))
    # of identical rows one stays; both steps use the same partitioning
    once = hashed.join(stay, keys, "left_semi").dropDuplicates(keys)
    back = [F.col(f"_{i}").alias(n) for i, n in enumerate(names)]
    return once.select(*back).unionByName(tried.where("not maybe").select(*back))


ORACLE = """
with t as (select doc_id, length(coalesce(text, '')) as chars,
                  regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', '', 'g') as norm from documents)
select doc_id, first_value(doc_id) over g as keep_id, count(*) over (partition by norm) as group_size,
       row_number() over g = 1 as kept, sha256(norm) as text_sha256
from t window g as (partition by norm order by chars desc, doc_id)
"""
