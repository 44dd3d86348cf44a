"""Alignment of two tokenizers over a corpus: groups of tokens that end together, links, and how common each link is.

Texts are shuffled by their full content, so that each distinct one is encoded and aligned
once; its weight is the number of rows that hold it. A link is a token of A and
one of B whose bytes overlap. The count of a pair of ids is the number of rows with such a
link, so a distinct text adds its weight once per pair.

A task cuts its distinct texts into blocks of bounded size. A block sends each of its distinct pairs
once, with the summed weight, and keeps for each text the places of its links in that list. Pairs
are added up by Spark, ranked within their A id (at most one row per B id), sent back to the
blocks that asked, and there added up per text. So a pair that every text has meets one row per
block, never one per text. Measures return to the rows by a digest of the text.

Both tokenizers end a token at every space that stands alone between other characters.
The stretches in between are therefore encoded apart, each distinct one once, and remembered.

A text that is null or empty, or that one of the tokenizers does not give back byte by byte
(one with U+2581, for instance), has no tokens: zeros, and an empty digest. Repeated rows and
ids give one row each, no rows give none, other columns are not read.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqtide.llm.skew import attach
from seqtide.llm.texts import byte_letters, slices
from seqtide.session import materialise

#: Bytes of distinct text in a block.
BLOCK = 4 << 20
#: Stretches that a Python worker remembers, and how long they may be; beyond, the older half goes.
CACHE, CACHE_CHARS = 300_000, 48
#: Characters of stretches that are aligned at a time, and that one call of a library reads as one text.
JOINED, TEXT = 1 << 18, 1 << 12
#: Distinct pairs that a worker numbers before it starts anew.
PAIRS = 2_000_000
#: A pair of ids is (id of A) * 2^B_BITS + (id of B).
B_BITS = 20

_BLOCKS = ("block long, digest binary, copies long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
           "links binary, pairs array<long>, weights array<long>")
_MEASURES = "digest binary, copies long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
_NAMES = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")


def _spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions of the ranges ``starts[i] .. starts[i] + lengths[i]``, one after another."""
    return np.arange(int(lengths.sum()), dtype=np.int64) + np.repeat(starts - (np.cumsum(lengths) - lengths), lengths)


class Side:
    """One tokenizer: ids of joined texts, and the bytes of every id."""

    def __init__(self, token: dict[int, bytes]):
        self.token = token
        self.width = np.zeros(max(token) + 1, np.int64)
        for i, raw in token.items():
            self.width[i] = len(raw)
        self.decimal = {i: b"%d" % i for i in token}

    def ids(self, texts: list[str]) -> list[int]:
        """Of texts that start with a space, one after another."""
        raise NotImplementedError


class ByteLevel(Side):
    """A byte-level vocabulary of the tokenizers library; special strings are plain text."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        byte = {letter: b for b, letter in byte_letters().items()}
        super().__init__({i: bytes(byte[c] for c in piece) if all(c in byte for c in piece) else piece.encode()
                          for piece, i in self.tokenizer.get_vocab().items()})

    def ids(self, texts: list[str]) -> list[int]:
        return [i for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False) for i in e.ids]


class Pieces(Side):
    """A sentencepiece model that puts a space before every text."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        super().__init__({i: bytes([int(self.model.id_to_piece(i)[3:5], 16)]) if self.model.is_byte(i)
                          else self.model.id_to_piece(i).replace("▁", " ").encode() for i in range(self.model.get_piece_size())})

    def ids(self, texts: list[str]) -> list[int]:
        return list(chain.from_iterable(self.model.encode([t[1:] for t in texts], out_type=int, num_threads=1)))


def stretches(text: str) -> list[str]:
    """Parts of ``text``, cut at every space between two characters that are not white space."""
    parts = text.split(" ")
    out = [parts[0]]
    for before, part in zip(parts, parts[1:], strict=False):
        if before and part and not before[-1].isspace() and not part[0].isspace():
            out.append(part)
        else:
            out[-1] += " " + part
    return out


class Aligner:
    """Both tokenizers, and the alignment of the stretches seen so far."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = ByteLevel(path_a), Pieces(path_b)
        self.reset()

    def reset(self) -> None:
        self.at: dict[str, int] = {}
        self.listed: list[bytes] = []
        self.counts = np.zeros((0, 4), np.int32)  # tokens of A and B, groups, links; -1 where bytes differ
        self.links = np.zeros(0, np.int32)  # numbers of pairs
        self.first = np.zeros(1, np.int64)
        self.number: dict[int, int] = {}
        self.pairs = np.zeros(0, np.int64)

    def _forget(self) -> None:
        half = len(self.listed) // 2
        self.at = {s: p - half for s, p in self.at.items() if p >= half}
        self.links, self.first = self.links[self.first[half]:].copy(), self.first[half:] - self.first[half]
        self.listed, self.counts = self.listed[half:], self.counts[half:].copy()

    def _tokens(self, side: Side, texts: list[str], raw: bytes, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids and their ends in bytes; None where they do not give back the text or run across a stretch."""
        ids = side.ids(texts)
        if b"".join(map(side.token.__getitem__, ids)) != raw:
            return None
        array = np.array(ids, np.int64)
        at = np.cumsum(side.width[array])
        return (array, at) if (at[np.searchsorted(at, ends).clip(max=len(at) - 1)] == ends).all() else None

    def _align(self, some: list[str]) -> list[tuple]:
        """Places, counts, groups and links of stretches, which are encoded in a few texts."""
        spaced = [" " + s for s in some]
        raw = [s.encode() for s in spaced]
        lengths = np.array(list(map(len, raw)))
        ends, whole = np.cumsum(lengths), b"".join(raw)
        begins = [0, *(np.flatnonzero(np.diff(ends // TEXT)) + 1).tolist(), len(some)]
        texts = ["".join(spaced[i:j]) for i, j in zip(begins, begins[1:], strict=False)]
        found = [self._tokens(side, texts, whole, ends) for side in (self.a, self.b)]
        if found[0] is None or found[1] is None:
            if len(some) > 1:
                return self._align(some[:len(some) // 2]) + self._align(some[len(some) // 2:])
            return [(some, np.full((1, 4), -1), [b""], np.zeros(0, np.int64), np.zeros(1, np.int64))]
        (a, end_a), (b, end_b) = found
        common = np.intersect1d(end_a, end_b, assume_unique=True)
        # token i of A meets the tokens of B from the one that holds its first byte to the one that holds its last
        low = np.searchsorted(end_b, end_a - self.a.width[a], "right")
        n = np.searchsorted(end_b, end_a, "left") + 1 - low
        pairs = np.repeat(a << B_BITS, n) | b[_spread(low, n)]
        cuts = [np.searchsorted(x, ends, "right") for x in (end_a, end_b, common)]
        links = np.cumsum(n)[cuts[0] - 1]
        sizes = np.stack([np.diff(c, prepend=0) for c in (*cuts, links)], axis=1)
        groups = self._groups(a, b, np.searchsorted(end_a, common, "right"), np.searchsorted(end_b, common, "right"))
        starts = [0, *cuts[2].tolist()]
        listed = [groups[i] if j == i + 1 else b";".join(groups[i:j]) for i, j in zip(starts, starts[1:], strict=False)]
        return [(some, sizes, listed, pairs, links)]

    def _groups(self, a: np.ndarray, b: np.ndarray, to_a: np.ndarray, to_b: np.ndarray) -> list[bytes]:
        """``a1,a2|b1`` of every group, given where each ends."""
        from_a, from_b = np.concatenate([[0], to_a[:-1]]), np.concatenate([[0], to_b[:-1]])
        single = (to_a - from_a == 1) & (to_b - from_b == 1)
        pair, place = np.unique(a[from_a[single]] << B_BITS | b[from_b[single]], return_inverse=True)
        names = np.array([b"%d|%d" % (p >> B_BITS, p & (1 << B_BITS) - 1) for p in pair.tolist()], object)
        out = np.empty(len(to_a), object)
        out[single] = names[place]
        text_a, text_b = self.a.decimal, self.b.decimal
        for k in np.flatnonzero(~single).tolist():
            out[k] = (b",".join([text_a[i] for i in a[from_a[k]:to_a[k]].tolist()]) + b"|"
                      + b",".join([text_b[i] for i in b[from_b[k]:to_b[k]].tolist()]))
        return out.tolist()

    def learn(self, missing: list[str]) -> None:
        """Align stretches and remember them."""
        done: list[tuple] = []
        some, held = [], 0
        for s in missing:
            some.append(s)
            held += len(s)
            if held >= JOINED:
                done += self._align(some)
                some, held = [], 0
        if some:
            done += self._align(some)
        at, first = len(self.listed), [self.first]
        for names, _, listed, pairs, ends in done:
            self.at.update(zip(names, range(at, at + len(names)), strict=True))
            at += len(names)
            self.listed += listed
            first.append(ends + first[-1][-1])
        self.first = np.concatenate(first)
        self.counts = np.concatenate([self.counts, *(d[1].astype(np.int32) for d in done)])
        distinct, place = np.unique(np.concatenate([d[3] for d in done]), return_inverse=True)
        fresh = [p for p in distinct.tolist() if p not in self.number]
        self.number.update(zip(fresh, range(len(self.pairs), len(self.pairs) + len(fresh)), strict=True))
        self.pairs = np.concatenate([self.pairs, np.array(fresh, np.int64)])
        numbers = np.array([self.number[p] for p in distinct.tolist()], np.int32)
        self.links = np.concatenate([self.links, numbers[place]])

    def align(self, texts: pa.Array) -> tuple[np.ndarray, list[str], np.ndarray]:
        """Per text its four counts and digest; the links of all texts in order, as places in ``self.pairs``."""
        if len(self.pairs) > PAIRS:
            self.reset()
        if len(self.listed) > CACHE:
            self._forget()
        split = pc.split_pattern(texts, " ")
        coded = split.flatten().dictionary_encode()
        words, word = coded.dictionary.to_pylist(), coded.indices.to_numpy()
        sizes = pc.list_value_length(split).to_numpy().astype(np.int64)
        of_text = np.repeat(np.arange(len(texts)), sizes)
        plain = np.array([bool(w) and not w[0].isspace() and not w[-1].isspace() for w in words], bool)
        # with white space of other kinds, or more than one space, stretches hold several words
        odd = np.bincount(of_text, ~plain[word], len(texts)) > 0
        merged = {i: stretches(texts[i].as_py()) for i in np.flatnonzero(odd).tolist()}
        regular = ~odd[of_text]
        used = np.zeros(len(words), bool)
        used[word[regular]] = True
        wanted = [words[i] for i in np.flatnonzero(used).tolist()]
        wanted += set(chain.from_iterable(merged.values())).difference(wanted)
        missing = [s for s in wanted if s not in self.at]
        if missing:
            self.learn(missing)
        of = self.at.get
        place = np.array([of(w, -1) for w in words], np.int64)[word]
        if merged:
            ends = np.cumsum(sizes)
            parts, at = [], 0
            for i, names in merged.items():
                parts += [place[at:ends[i] - sizes[i]], np.array([self.at[s] for s in names], np.int64)]
                at, sizes[i] = ends[i], len(names)
            place = np.concatenate([*parts, place[at:]])
        starts = np.cumsum(sizes) - sizes
        per = self.counts[place]
        bad = np.minimum.reduceat(per[:, 0], starts) < 0
        counts = np.add.reduceat(per, starts, axis=0, dtype=np.int64)
        counts[bad] = 0
        listed, at = list(map(self.listed.__getitem__, place.tolist())), starts.tolist()
        digests = ["" if wrong else hashlib.sha256(b";".join(listed[i:i + n])).hexdigest()
                   for i, n, wrong in zip(at, sizes.tolist(), bad.tolist(), strict=True)]
        place = place[~np.repeat(bad, sizes)]
        links = self.links[_spread(self.first[place], self.first[place + 1] - self.first[place])]
        for s in missing:
            if len(s) > CACHE_CHARS:
                del self.at[s]
        return counts, digests, links


@lru_cache(maxsize=1)
def aligner(path_a: str, path_b: str) -> Aligner:
    return Aligner(path_a, path_b)


def _encode(path_a: str, path_b: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, part, seq = aligner(path_a, path_b), TaskContext.get().partitionId(), 0
        for rows, texts in slices(batches, size=BLOCK):
            block = part << 32 | seq
            seq += 1
            counts, digests, links = both.align(texts)
            n = counts[:, 3]
            copies = rows.column("copies").to_numpy()
            used = np.zeros(len(both.pairs), bool)
            used[links] = True
            pairs, place = both.pairs[used], (np.cumsum(used) - 1)[links]
            # a text adds its weight once for each of its pairs
            width = max(len(pairs), 1)
            once = np.sort(np.repeat(np.arange(len(texts)) * width, n) + place)
            once = once[np.diff(once, prepend=-1) > 0]
            weights = np.bincount(once % width, copies[once // width], len(pairs)).astype(np.int64)
            packed = place.astype("<u4").tobytes()
            ends = 4 * np.concatenate([[0], np.cumsum(n)])
            kept = len(texts)
            yield pa.RecordBatch.from_arrays([
                pa.array([block] * kept, pa.int64()), rows.column("digest"), rows.column("copies"), *(pa.array(counts[:, i]) for i in range(4)),
                pa.array(digests, pa.string()), pa.array([packed[a:b] for a, b in zip(ends, ends[1:], strict=False)], pa.binary()),
                pa.nulls(kept, pa.list_(pa.int64())), pa.nulls(kept, pa.list_(pa.int64()))], names=_FIELDS)
            yield pa.RecordBatch.from_arrays([
                pa.array([block], pa.int64()), pa.nulls(1, pa.binary()), *[pa.nulls(1, pa.int64())] * 5, pa.nulls(1, pa.string()), pa.nulls(1, pa.binary()),
                pa.array([pairs], pa.list_(pa.int64())), pa.array([weights], pa.list_(pa.int64()))], names=_FIELDS)
    return run


_FIELDS = [f.split()[0] for f in _BLOCKS.split(", ")]


def _measure(rows: pa.Table, answers: pa.Table) -> pa.Table:
    """Sums over the links of the texts of a block; ``answers`` has count and rank of each of its pairs."""
    order = answers.column("place").to_numpy()
    count, best = np.zeros(len(order), np.int64), np.zeros(len(order), np.int64)
    count[order], best[order] = answers.column("n").to_numpy(), answers.column("best").to_numpy(zero_copy_only=False)
    sums = []
    for links in rows.column("links").to_pylist():
        at = np.frombuffer(links, "<u4")
        sums.append((int(best[at].sum()), int(count[at].sum())))
    columns = {name: rows.column(name) for name in ("digest", "copies", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")}
    columns["n_best"], columns["count_sum"] = (pa.array([s[i] for s in sums], pa.int64()) for i in (0, 1))
    return pa.table([columns[f.split()[0]] for f in _MEASURES.split(", ")], names=[f.split()[0] for f in _MEASURES.split(", ")])


def aligned_blocks(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Stored table of all distinct texts with their links, and one row per block with its pairs and their weights."""
    distinct = (docs.where("text is not null and text <> ''").groupBy("text").agg(F.count("*").alias("copies"))
                .select(F.unhex(F.sha2("text", 256)).alias("digest"), "copies", "text"))
    return materialise(distinct.mapInArrow(_encode(path_a, path_b), _BLOCKS), "blocks")


def pair_counts(blocks: DataFrame) -> DataFrame:
    """pair, n (rows that hold it linked), best (whether no pair of its A id has more)."""
    asked = blocks.where("pairs is not null").select(F.explode(F.arrays_zip("pairs", "weights")).alias("p")).select("p.pairs", "p.weights")
    counts = materialise(asked.groupBy(F.col("pairs").alias("pair")).agg(F.sum("weights").alias("n")), "pairs")
    first = F.shiftright("pair", B_BITS).alias("id_a")
    most = counts.groupBy(first).agg(F.max("n").alias("most"))
    return counts.select("pair", "n", first).join(most, "id_a").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def align(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every row.

    A reads space + text by the tokenizers file ``path_a``, B the text by the sentencepiece
    model ``path_b``, which adds the space itself.
    """
    keys = materialise(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.unhex(F.sha2("text", 256)).alias("digest")), "keys")
    blocks = aligned_blocks(docs.select("text"), path_a, path_b)
    asked = blocks.where("pairs is not null").select(F.col("block").alias("of"), F.posexplode("pairs").alias("place", "pair"))
    answers = asked.join(pair_counts(blocks), "pair").select("of", "place", "n", F.col("best").cast("long").alias("best"))
    rows = blocks.where("digest is not null").drop("pairs", "weights")
    measures = materialise(rows.groupBy("block").cogroup(answers.groupBy("of")).applyInArrow(_measure, _MEASURES), "measures")
    joined = attach(keys, measures, ["digest"], "copies", keys.count(), "left")
    return joined.select("doc_id", *[F.coalesce(name, F.lit(0)).alias(name) for name in _NAMES],
                         F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"))
