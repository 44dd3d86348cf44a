"""N-gram Jaccard join with Bayesian pruning of candidates.

Texts are sets of five-word shingles (lower-cased words; a text of one to four words
is one shingle). Two texts are linked when their Jaccard similarity is 0.8 or more.

1. One pass gives every text a key (hash of its words), MinHash values and band keys.
   Equal texts share a key and are handled once from here on.
2. Texts that share a band meet in blocks. MinHash values are compared a few at a
   time, and a pair is dropped as soon as the posterior probability of similarity
   >= 0.8, given the matches so far under a uniform prior, falls below 1e-6. What is
   left connects texts into neighbourhoods; pairs themselves are not written.
3. Of the texts, those that have a neighbourhood are read again; a filter of fixed size
   over their ids keeps most others out of the shuffle. In each neighbourhood, again in blocks and after the same pruning, pairs are
   verified on their whole shingle sets. Links are counted per text where they are
   found, and verified links make the classes.

A pair of similarity 0.8 shares one of 30 bands of 5 with probability 1 - 7e-6, and
more similar pairs more often; nothing else can lose a link. A neighbourhood of n
different texts takes n^2 comparisons, spread over blocks, as its links may be that
many; a task sees two blocks at most. Shingles and words are compared by 64-bit
hashes.

Null texts count as empty. Empty texts equal one another and no other. Rows that
share a text, repeated rows too, are copies: linked to each other and to all that
the text is linked to. A class without any doc_id has a null class_id. Other columns
are not read. No rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import chain
from math import comb

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqtide.llm.components import components
from seqtide.llm.id_filter import passing
from seqtide.llm.skew import attach
from seqtide.llm.texts import forget, slices, words
from seqtide.session import materialise

SHINGLE = 5
#: The least similarity of a link, as a fraction.
LEAST = (4, 5)
BANDS, ROWS = 30, 5
HASHES = BANDS * ROWS
#: MinHash values compared between two looks at the posterior, and the tolerance.
LOOK, TOLERANCE = 10, 1e-6
#: Texts of one block; a group of more is cut into blocks that meet in pairs.
BLOCK = 512
#: Pairs, and shingles, that a task works on at a time.
CHUNK_PAIRS, CHUNK_SHINGLES = 200_000, 4_000_000

_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M2
    x = (x ^ (x >> np.uint64(27))) * _M1
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=1)
def _functions() -> tuple[np.ndarray, np.ndarray]:
    """Multipliers and shifts of the MinHash functions, from a fixed rule."""
    at = _mix(np.arange(1, 2 * HASHES + 1, dtype=np.uint64))
    return (at[:HASHES] | np.uint64(1)).astype(np.uint32), at[HASHES:].astype(np.uint32)


def shingles(split: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(shingle hashes of all texts, first shingle of each text and the end, key of each text)."""
    import xxhash

    distinct = set(chain.from_iterable(split))
    code = {w: xxhash.xxh3_64_intdigest(w) for w in distinct}
    n = np.fromiter(map(len, split), np.int64, len(split))
    flat = np.fromiter(map(code.__getitem__, chain.from_iterable(split)), np.uint64, int(n.sum()))
    ends = np.cumsum(n)
    starts = ends - n
    keys = np.array([xxhash.xxh3_64_intdigest(b" ".join(s)) for s in split], np.uint64)
    rolled = np.zeros(len(flat), np.uint64)
    for k in range(SHINGLE):  # where fewer words follow, the value is not used
        rolled[:len(flat) - k] = _mix(rolled[:len(flat) - k] + flat[k:] + _M1)
    counts = np.where(n == 0, 0, np.maximum(n - SHINGLE + 1, 1))
    first = np.concatenate([[0], np.cumsum(counts)])
    out = np.empty(int(first[-1]), np.uint64)
    long = n >= SHINGLE
    at = np.repeat(starts - first[:-1], counts) + np.arange(len(out))
    whole = np.repeat(long, counts)
    out[whole] = rolled[at[whole]]
    out[first[:-1][~long & (n > 0)]] = keys[~long & (n > 0)]
    return out, first, keys


def minhashes(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """16 bits of each MinHash value, one row per text that has shingles."""
    out = np.empty((len(first) - 1, HASHES), np.uint16)
    if not len(out):
        return out
    small = (hashes >> np.uint64(32)).astype(np.uint32)
    times, plus = _functions()
    for k in range(HASHES):
        least = np.minimum.reduceat(small * times[k] + plus[k], first[:-1]).astype(np.uint64)
        out[:, k] = _mix(least + np.uint64(k + 1)) >> np.uint64(48)
    return out


def band_keys(signatures: np.ndarray) -> np.ndarray:
    """One 64-bit key per text and band, over the band's number and its values."""
    parts = signatures.reshape(len(signatures), BANDS, ROWS).astype(np.uint64)
    key = np.tile(np.arange(1, BANDS + 1, dtype=np.uint64), (len(signatures), 1))
    for r in range(ROWS):
        key = _mix(key * _M1 + parts[:, :, r])
    return key.view(np.int64)


SIGNED = "doc_id long, key long, signature binary, bands array<long>, mark long"


def _lower(texts: pa.Array) -> list[list[bytes]]:
    return words(pc.utf8_lower(texts))


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    forget()  # workers of a pipeline have encoded texts before
    for rows, texts in slices(batches):
        split = _lower(texts)
        hashes, first, keys = shingles(split)
        # a text below the shingle length can only be linked to its copies
        long = np.fromiter(map(len, split), np.int64, len(split)) >= SHINGLE
        has = np.flatnonzero(long)
        signed = minhashes(hashes[np.repeat(long, np.diff(first))], np.concatenate([[0], np.cumsum(np.diff(first)[has])]))
        signatures, bands = [None] * len(split), [None] * len(split)
        for i, s, b in zip(has.tolist(), signed, band_keys(signed).tolist() if len(has) else [], strict=True):
            signatures[i], bands[i] = s.tobytes(), b
        yield pa.RecordBatch.from_arrays(
            [rows.column("doc_id"), pa.array(keys.view(np.int64)), pa.array(signatures, pa.binary()),
             pa.array(bands, pa.list_(pa.int64())), rows.column("mark")], names=["doc_id", "key", "signature", "bands", "mark"])


@lru_cache(maxsize=1)
def least_matches() -> list[int]:
    """Fewest matches after each look that keep a pair.

    With a uniform prior, m matches of n give a Beta(m + 1, n - m + 1) posterior, and
    P(similarity >= t) = P(Binomial(n + 1, t) <= m).
    """
    t, out = LEAST[0] / LEAST[1], []
    for n in range(LOOK, HASHES + 1, LOOK):
        total, m = 0.0, -1
        while total < TOLERANCE:
            m += 1
            total += comb(n + 1, m) * t ** m * (1 - t) ** (n + 1 - m)
        out.append(m)
    return out


def pruned(signatures: np.ndarray, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pairs (i, j) that stay after comparing values look by look."""
    matches = np.zeros(len(i), np.int16)
    for look, least in enumerate(least_matches()):
        if not len(i):
            break
        part = slice(look * LOOK, (look + 1) * LOOK)
        matches += (signatures[i, part] == signatures[j, part]).sum(axis=1, dtype=np.int16)
        stay = matches >= least
        i, j, matches = i[stay], j[stay], matches[stay]
    return i, j


def _whole_groups(batches: Iterator[pa.RecordBatch], by: list[str]) -> Iterator[pa.Table]:
    """Sorted rows as tables that end where a group ends."""
    held: list[pa.RecordBatch] = []

    def changes(batch: pa.RecordBatch) -> np.ndarray:
        moved = np.zeros(batch.num_rows - 1, bool)
        for name in by:
            v = batch.column(name).to_numpy(zero_copy_only=False)
            moved |= v[1:] != v[:-1]
        return np.flatnonzero(moved) + 1

    def same(a: pa.RecordBatch, b: pa.RecordBatch) -> bool:
        return all(a.column(n)[a.num_rows - 1] == b.column(n)[0] for n in by)
    for batch in batches:
        if not batch.num_rows:
            continue
        if held and not same(held[-1], batch):
            yield pa.Table.from_batches(held)
            held = []
        cut = changes(batch)
        if len(cut):
            last = int(cut[-1])
            yield pa.Table.from_batches([*held, batch.slice(0, last)])
            held = [batch.slice(last)]
        else:
            held.append(batch)
    if held:
        yield pa.Table.from_batches(held)


def _pairs(bounds: np.ndarray, side: np.ndarray, cross: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row pairs inside each group; in a group of two blocks only pairs between them.

    Pairs come in chunks of bounded size that are ordered by the first row.
    """
    held_i, held_j, size = [], [], 0
    for g in range(len(bounds) - 1):
        a, b = int(bounds[g]), int(bounds[g + 1])
        if cross[g]:
            rows = np.arange(a, b)
            left, right = rows[side[a:b] == 0], rows[side[a:b] == 1]
            step = max(1, CHUNK_PAIRS // max(len(right), 1))
            for k in range(0, len(left), step):
                part = left[k:k + step]
                yield np.repeat(part, len(right)), np.tile(right, len(part))
            continue
        n = b - a
        i, j = np.triu_indices(n, 1)
        if n > 64:
            for k in range(0, len(i), CHUNK_PAIRS):
                yield i[k:k + CHUNK_PAIRS] + a, j[k:k + CHUNK_PAIRS] + a
            continue
        held_i.append(i + a)
        held_j.append(j + a)
        size += len(i)
        if size >= CHUNK_PAIRS:
            yield np.concatenate(held_i), np.concatenate(held_j)
            held_i, held_j, size = [], [], 0
    if size:
        yield np.concatenate(held_i), np.concatenate(held_j)


def _lowest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest row that each of n rows is connected to by the pairs."""
    label = np.arange(n)
    while len(i):
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, label[i], low)
        np.minimum.at(new, label[j], low)
        new = np.minimum(new, new[new])
        if (new == label).all():
            break
        label = new
    return label[label]


def _grouped(table: pa.Table, by: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bounds of the groups, 0/1 side of each row, which groups are of two blocks)."""
    v = [table.column(n).to_numpy() for n in by]
    moved = np.zeros(max(table.num_rows - 1, 0), bool)
    for x in v:
        moved |= x[1:] != x[:-1]
    bounds = np.concatenate([[0], np.flatnonzero(moved) + 1, [table.num_rows]])
    lo, hi = v[-2], v[-1]
    side = (table.column("own").to_numpy() != lo).astype(np.int8)
    return bounds, side, (lo != hi)[bounds[:-1]]


def _signatures(table: pa.Table) -> np.ndarray:
    column = table.column("signature").combine_chunks()
    data = b"".join(column.to_pylist())
    return np.frombuffer(data, np.uint16).reshape(table.num_rows, HASHES)


def _connect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Band groups -> star edges (a, b) of the pairs that pass the pruning."""
    by = ["band", "lo", "hi"]
    for table in _whole_groups(batches, by):
        signatures, keys = _signatures(table), table.column("key").to_numpy()
        distinct, row = np.unique(keys, return_inverse=True)
        found_i, found_j = [], []
        for i, j in _pairs(*_grouped(table, by)):
            i, j = pruned(signatures, i, j)
            both = np.unique(np.stack([row[i], row[j]]), axis=1) if len(i) else np.zeros((2, 0), np.int64)
            found_i.append(both[0])
            found_j.append(both[1])
        if found_i:
            low = _lowest(len(distinct), np.concatenate(found_i), np.concatenate(found_j))
            rows = np.flatnonzero(low != np.arange(len(distinct)))
            yield pa.RecordBatch.from_arrays([pa.array(distinct[rows]), pa.array(distinct[low[rows]])], names=["a", "b"])


def _blocks(rows: DataFrame, by: str, size: str) -> DataFrame:
    """Each row once for every pair of blocks that its block is part of, as own, lo, hi."""
    blocks = F.ceil(F.col(size) / BLOCK).cast("int")
    cut = rows.withColumn("own", F.pmod(F.xxhash64("key"), blocks).cast("int"))
    met = cut.withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    return met.select(*rows.columns, "own", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"))


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """key and distinct shingles of each text; with a wanted key, of the texts that have it."""
    for rows, texts in slices(batches):
        hashes, first, keys = shingles(_lower(texts))
        keys = keys.view(np.int64)
        for i in range(0, len(keys), 1000):
            at = [k for k in range(i, min(i + 1000, len(keys)))
                  if "key" not in rows.schema.names or rows.column("key")[k].as_py() == keys[k]]
            sets = [np.unique(hashes[first[k]:first[k + 1]]).tobytes() for k in at]
            yield pa.RecordBatch.from_arrays([pa.array(keys[at], pa.int64()), pa.array(sets, pa.binary())], names=["key", "shingles"])


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of a neighbourhood -> links of each text and the smallest text it is connected to there."""
    by = ["label", "lo", "hi"]
    up, down = LEAST
    for table in _whole_groups(batches, by):
        bounds, side, cross = _grouped(table, by)
        keys, copies = table.column("key").to_numpy(), table.column("copies").to_numpy()
        signatures = _signatures(table)
        raw = table.column("shingles").combine_chunks().to_pylist()
        sizes = np.fromiter(map(len, raw), np.int64, len(raw)) // 8
        links, texts = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        found_i, found_j = [], []
        for i, j in _pairs(bounds, side, cross):
            i, j = pruned(signatures, i, j)
            both = _overlap(raw, sizes, i, j)
            real = (up + down) * both >= up * (sizes[i] + sizes[j])  # both / union >= up / down
            i, j = i[real], j[real]
            for x, y in ((i, j), (j, i)):
                np.add.at(links, x, copies[y])
                np.add.at(texts, x, 1)
            found_i.append(i)
            found_j.append(j)
        low = np.arange(len(keys))
        if found_i:
            low = _lowest(len(keys), np.concatenate(found_i), np.concatenate(found_j))
        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(links), pa.array(texts), pa.array(keys[low])],
                                         names=["key", "links", "texts", "low"])


def _overlap(raw: list[bytes], sizes: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Common shingles of each pair; pairs are ordered by i."""
    out = np.zeros(len(i), np.int64)
    begins = np.flatnonzero(np.concatenate([[True], i[1:] != i[:-1]])) if len(i) else []
    for a, b in zip(begins, [*begins[1:], len(i)], strict=True):
        own = np.frombuffer(raw[i[a]], np.uint64)
        step = a
        while step < b:  # partners in runs of bounded size
            stop = step + max(1, int(np.searchsorted(np.cumsum(sizes[j[step:b]]), CHUNK_SHINGLES)))
            others = j[step:stop]
            flat = np.frombuffer(b"".join(raw[k] for k in others.tolist()), np.uint64)
            at = np.searchsorted(own, flat)
            at[at == len(own)] = 0
            same = own[at] == flat
            ends = np.cumsum(sizes[others])
            counted = np.concatenate([[0], np.cumsum(same)])
            out[step:stop] = counted[ends] - counted[ends - sizes[others]]
            step = stop
    return out


def _mark() -> Column:
    """Tells apart the texts of rows that share a doc_id."""
    return F.xxhash64(F.coalesce("text", F.lit(""))).alias("mark")


def join(docs: DataFrame) -> DataFrame:
    """doc_id, class_id, class_size, n_links (rows), n_text_links (different texts) of every row."""
    return _classified(docs).select("doc_id", "class_id", "class_size", "n_links", "n_text_links")


def _classified(docs: DataFrame) -> DataFrame:
    """The columns of ``join`` with label (of the class), key (of the shingles) and mark (of the text)."""
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    signed = materialise(read.select("doc_id", "text", _mark()).mapInArrow(_sign, SIGNED), "signed")
    texts = materialise(signed.groupBy("key").agg(
        F.count("*").alias("copies"), F.min("doc_id").alias("least_id"),
        F.any_value("signature").alias("signature"), F.any_value("bands").alias("bands")), "texts")

    # neighbourhoods
    banded = texts.select("key", F.explode("bands").alias("band"))
    shared = banded.groupBy("band").agg(F.count("*").alias("n")).where("n > 1")
    members = banded.join(shared, "band").join(texts.select("key", "signature"), "key")
    met = _blocks(members, "band", "n").drop("n").repartition(parts, "band", "lo", "hi").sortWithinPartitions("band", "lo", "hi")
    near = components(met.mapInArrow(_connect, "a long, b long"))
    near = materialise(near.withColumnRenamed("v", "key"), "near")
    sizes = near.groupBy("label").agg(F.count("*").alias("n"))
    placed = attach(near, materialise(sizes, "sizes"), ["label"], "n", near.count())
    placed = materialise(placed.join(texts.select("key", "copies", "least_id", "signature"), "key"), "placed")

    # verification on whole shingle sets
    wanted = placed.where("least_id is not null").select(F.col("least_id").alias("doc_id"), "key")
    named = passing(read, wanted).join(wanted, "doc_id")
    nameless = read.where("doc_id is null").select("text").mapInArrow(_sets, "key long, shingles binary")
    nameless = nameless.join(placed.where("least_id is null").select("key"), "key", "left_semi")
    sets = named.select("key", "text").mapInArrow(_sets, "key long, shingles binary").unionByName(nameless)
    sets = sets.join(placed, "key").dropDuplicates(["key"]).select("key", "label", "n", "copies", "signature", "shingles")
    checked = _blocks(sets, "label", "n").drop("n").repartition(parts, "label", "lo", "hi").sortWithinPartitions("label", "lo", "hi")
    found = materialise(checked.mapInArrow(_verify, "key long, links long, texts long, low long"), "verified")
    linked = found.groupBy("key").agg(F.sum("links").alias("links"), F.sum("texts").alias("texts"))
    labels = materialise(components(found.select(F.col("key").alias("a"), F.col("low").alias("b"))).select(
        F.col("v").alias("key"), "label"), "labels")

    # back to the rows
    own = texts.select("key", "copies", "least_id").join(labels, "key", "left").join(linked, "key", "left").select(
        "key", "copies", "least_id", F.coalesce("label", "key").alias("label"),
        F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("texts", F.lit(0)).alias("texts"))
    own = materialise(own, "linked")
    classes = materialise(own.groupBy("label").agg(
        F.count("*").alias("n"), F.min("least_id").alias("class_id"), F.sum("copies").alias("class_size")), "classes")
    classed = materialise(attach(own, classes, ["label"], "n", own.count()).drop("n", "least_id"), "classed")
    rows = signed.select("doc_id", "mark", "key")
    return attach(rows, classed, ["key"], "copies", rows.count()).select(
        "doc_id", "mark", "key", "label", "class_id", "class_size", (F.col("links") + F.col("copies") - 1).alias("n_links"), F.col("texts").alias("n_text_links"))


def kept(docs: DataFrame) -> DataFrame:
    """One document of each class, with the columns of ``docs``: that whose id names the class.

    Where several texts of the class have that id, the one of the smallest key stays; texts of
    other classes stay with their own, whatever ids they share. Equal rows count as one document. Rows
    without an id cannot be named and stay.
    """
    names = docs.columns
    plain = docs.select(*[F.col(f"`{n}`").alias(f"_{i}") for i, n in enumerate(names)], F.col("doc_id").cast("long").alias("id"), _mark())
    stay = _classified(docs).where(F.col("doc_id") == F.col("class_id")).groupBy("label").agg(
        F.min(F.struct("key", "mark")).alias("least"), F.any_value("class_id").alias("id")).select("id", F.col("least.mark").alias("mark"))
    once = plain.join(stay, ["id", "mark"], "left_semi").dropDuplicates(["id", "mark"])
    return once.unionByName(plain.where("id is null")).select(*[F.col(f"_{i}").alias(n) for i, n in enumerate(names)])
