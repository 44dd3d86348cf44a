"""Language-model scores from a log-frequency Bloom filter.

Tokens are words ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased, and one end per text.
Documents whose ``crc32(doc_id as text) mod 7`` is 2 are held out of all counts.

*Words* with at least a share of 2^-20 of all tokens are at most 2^20; their counts
are broadcast. They are known by their place in that list, other words by hash.

*Bigrams* of the training texts are all counted exactly and all enter the filter: one
of count c at the levels 1 .. 1 + floor(2 log2(c)). A probe asks level after level
until one is missing, and the last one present gives the count back within a factor
of sqrt(2), never too high but for a false positive (about 1 in 10^6).

*Shards.* The filter is cut into shards of about 2^18 tokens: by the second word if it
is rare, so that a shard also counts its rare words, and else by both words. Texts send
each shard the distinct bigrams of a slice by document; the shard counts, builds its
part of the filter, answers and adds up by document. A bigram comes at most once from
a document, and counts of a slice travel in one block, so frequent ones stay small.

*Score.* A bigram of the filter has the probability (c - 1/2) / c(v) after v; any other
word has b(v) times its add-one unigram probability, where b(v) hands out exactly what
is left. At the beginning the unigram probability holds. b(v) is a sum over all shards:
what needs it meets it in a broadcast if v is frequent, in a shuffle if v is rare.

Null texts count as empty: the end alone. A null doc_id is not held out. Rows that
repeat are counted and scored each. No rows give no rows. Other columns are not read.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqtide.llm.texts import slices
from seqtide.session import materialise

#: Frequent words have at least one in so many of the tokens.
FREQUENT = 1 << 20
#: Tokens whose bigrams one shard of the filter holds, on average.
SHARD = 1 << 18
FOLDS, HELD_OUT = 7, 2
DISCOUNT = 0.5
#: Tokens whose shards one task answers: a task has one row of sums for each document and frequent word that it meets.
TASK = 1 << 23
#: Probes of one level; together they are wrong once in 2^20.
PROBES, BITS_PER_INSERTION = 20, 29
SLICE = 4 << 20
#: Of the blocks that travel.
CODEC = "zstd"
#: Stands for the end of a text; no word holds a line feed.
END = b"\n"
#: Stands for the beginning of a text before its first word; no place is as high.
BEGIN = 1 << 40

_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M2
    x = (x ^ (x >> np.uint64(27))) * _M1
    return x ^ (x >> np.uint64(31))


def _hash(word: bytes) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(word)


def held_out(doc_id: int | None) -> bool:
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % FOLDS == HELD_OUT


def tokens(texts: pa.Array) -> list[list[bytes]]:
    """The words of each text and its end."""
    split = [t.lower().split() for t in texts.cast(pa.binary()).to_pylist()]
    for s in split:
        s.append(END)
    return split


def _sums(group: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Sum of the values of each of n groups; bincount alone gives integers for no values."""
    return np.bincount(group, values, n).astype(np.float64)


class LogFrequencyFilter:
    """A Bloom filter of (key, level) that gives back the highest level below the first one missing."""

    def __init__(self, keys: np.ndarray, levels: np.ndarray):
        self.size = int(levels.sum()) * BITS_PER_INSERTION // 64 * 64 + 64
        bits = np.zeros(self.size // 64, np.uint64)
        for level in range(1, int(levels.max(initial=0)) + 1):
            first, step = self._hashes(keys[levels >= level], level)
            for probe in range(PROBES):
                at = (first + np.uint64(probe) * step) % np.uint64(self.size)
                np.bitwise_or.at(bits, (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63)))
        self.bits = bits

    @staticmethod
    def _hashes(keys: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
        first = _mix(keys * _M1 + np.uint64(level))
        return first, _mix(first + _M2) | np.uint64(1)

    def levels(self, keys: np.ndarray) -> np.ndarray:
        """Level of each key, 0 where it is not in the filter."""
        out = np.zeros(len(keys), np.int32)
        alive, level = np.arange(len(keys)), 0
        while len(alive):
            level += 1
            first, step = self._hashes(keys[alive], level)
            for probe in range(PROBES):
                at = (first + np.uint64(probe) * step) % np.uint64(self.size)
                stay = (self.bits[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63)) & np.uint64(1)) == 1
                alive, first, step = alive[stay], first[stay], step[stay]
                if not len(alive):
                    break
            out[alive] = level
        return out


@dataclass
class Model:
    """What workers need: frequent words (hash, sorted; training count), bigrams and back-off weights."""

    words: np.ndarray
    counts: np.ndarray
    n: int
    v: int
    least: int
    bigrams: LogFrequencyFilter | None = None
    backoff: np.ndarray | None = None  # log10, by word

    def place(self, hashes: np.ndarray) -> np.ndarray:
        """Place of each hash among the frequent words, -1 for others."""
        if not len(self.words):
            return np.full(len(hashes), -1)
        at = np.searchsorted(self.words, hashes)
        at[at == len(self.words)] = 0
        return np.where(self.words[at] == hashes, at, -1)

    def unigram(self) -> np.ndarray:
        """log10 of the add-one probability of each frequent word."""
        return np.log10((self.counts + 1) / (self.n + self.v + 1))

    def count_at(self, level: np.ndarray) -> np.ndarray:
        """The least count that enters at ``level``."""
        return self.least * np.exp2((level - 1) / 2)

    def levels_of(self, counts: np.ndarray) -> np.ndarray:
        """The levels at which these counts enter."""
        return 1 + np.floor(2 * np.log2(np.maximum(counts / self.least, 1)) + 1e-9).astype(np.int64)

    def add_bigrams(self, pairs: np.ndarray, counts: np.ndarray) -> None:
        """``pairs`` hold two places, the first in the upper half."""
        levels = self.levels_of(counts)
        self.bigrams = LogFrequencyFilter(_mix(pairs.astype(np.uint64)), levels)
        first, second = (pairs >> 32).astype(np.int64), (pairs & 0xFFFFFFFF).astype(np.int64)
        given = np.maximum(self.counts, 1)
        seen = _sums(first, (self.count_at(levels) - DISCOUNT) / given[first], len(self.words))
        base = _sums(first, 10 ** self.unigram()[second], len(self.words))
        self.backoff = np.log10(np.maximum(1 - seen, 1e-9) / np.maximum(1 - base, 1e-9))


def _coded(split: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash of each distinct word, code of each token, first token of each text and the end)."""
    distinct = list(set(chain.from_iterable(split)))
    code = dict(zip(distinct, range(len(distinct)), strict=True))
    n = np.fromiter(map(len, split), np.int64, len(split))
    codes = np.fromiter(map(code.__getitem__, chain.from_iterable(split)), np.int64, int(n.sum()))
    return np.fromiter(map(_hash, distinct), np.uint64, len(distinct)), codes, np.concatenate([[0], np.cumsum(n)])


def _batch(**columns: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns.values()], names=list(columns))


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, texts in slices(batches, size=SLICE):
        split = tokens(texts)
        out = [held_out(d) for d in rows.column("doc_id").to_pylist()]
        learned = Counter(chain.from_iterable(s for s, h in zip(split, out, strict=True) if not h))
        every = Counter(learned)
        every.update(chain.from_iterable(s for s, h in zip(split, out, strict=True) if h))
        yield _batch(word=np.fromiter(map(_hash, every), np.uint64, len(every)).view(np.int64),
                     learned=np.fromiter(map(learned.__getitem__, every), np.int64, len(every)),
                     n=np.fromiter(every.values(), np.int64, len(every)))


def _previous(codes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The token before each token, -1 at the beginning of a text."""
    out = np.concatenate([[-1], codes[:-1]])
    out[first[:-1]] = -1
    return out


def _starts(*sorted_keys: np.ndarray) -> np.ndarray:
    """Where a new group begins."""
    new = np.ones(len(sorted_keys[0]), bool)
    if len(new):
        new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in sorted_keys])
    return np.flatnonzero(new)


def _summed(keys: list[np.ndarray], values: list[np.ndarray]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Distinct keys and the sums of their values."""
    order = np.lexsort(keys[::-1])
    keys = [k[order] for k in keys]
    at = _starts(*keys)
    return [k[at] for k in keys], [np.add.reduceat(x[order], at) if len(at) else x for x in values]


def _packed(columns: list[np.ndarray]) -> bytes:
    """Columns of 8, 8, 4 and 4 bytes behind their number of rows, the first, which ascends, as its steps; equal bytes of a
    column side by side for the codec."""
    columns = [np.diff(columns[0], prepend=np.int64(0)), *columns[1:]]
    data = b"".join(c.view(np.uint8).reshape(len(c), c.itemsize).T.tobytes() for c in columns)
    return len(columns[0]).to_bytes(4, "little") + pa.compress(data, codec=CODEC, asbytes=True)


_COLUMNS = (np.int64, np.int64, np.uint32, np.uint32)


def _unpacked(packed: bytes) -> list[np.ndarray]:
    n, at, out = int.from_bytes(packed[:4], "little"), 0, []
    data = pa.decompress(packed[4:], 24 * n, codec=CODEC, asbytes=True)
    for kind in _COLUMNS:
        size = np.dtype(kind).itemsize
        out.append(np.ascontiguousarray(np.frombuffer(data, np.uint8, n * size, at).reshape(size, n).T).view(kind).ravel())
        at += n * size
    return [np.cumsum(out[0]), *out[1:]]


#: Shards from 0 on: v, w, 2 * document + held out, times. Below 0: one slice's documents: id, tokens, 2 * document + held out, id known.
BLOCKS = "shard long, row long, data binary"


def _sender(model, shards: int):
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model = model.value
        part = TaskContext.get().partitionId()
        row = part << 33
        for rows, texts in slices(batches, size=SLICE):
            hashes, codes, first = _coded(tokens(texts))
            docs, n = len(first) - 1, np.diff(first)
            ids = rows.column("doc_id").to_pylist()
            mark = np.arange(docs, dtype=np.uint32) << np.uint32(1) | np.fromiter(map(held_out, ids), np.uint32, docs)
            out = [(-1 - row, _packed([np.fromiter((d or 0 for d in ids), np.int64, docs), n.astype(np.int64), mark,
                                       np.fromiter((d is not None for d in ids), np.uint32, docs)]))]
            place = m.place(hashes)
            word = np.where(place >= 0, place, (hashes | np.uint64(1 << 63)).view(np.int64))
            # codes in the order of the words, so that the words of a block ascend
            order = np.argsort(word, kind="stable")
            rank = np.empty_like(order)
            rank[order] = np.arange(len(order))
            word, codes = np.append(word[order], BEGIN), rank[codes]
            before = _previous(codes, first)  # -1 is the last of word
            pair, doc = (before + 1) * len(hashes) + codes, np.repeat(mark, n)
            order = np.argsort(pair, kind="stable")
            pair, doc = pair[order], doc[order]
            at = _starts(pair, doc)
            times = np.diff(np.append(at, len(pair))).astype(np.uint32)
            v, w, doc = word[pair[at] // len(hashes) - 1], word[pair[at] % len(hashes)], doc[at]
            key = np.where(w >= 0, v, 0).astype(np.uint64) * _M1 + w.astype(np.uint64)
            shard = (_mix(key) % np.uint64(shards)).astype(np.int64)
            order = np.argsort(shard, kind="stable")
            v, w, doc, times, shard = (x[order] for x in (v, w, doc, times, shard))
            at = np.append(_starts(shard), len(shard)).tolist()
            out += [(int(shard[a]), _packed([v[a:b], w[a:b], doc[a:b], times[a:b]])) for a, b in zip(at, at[1:], strict=False)]
            yield pa.RecordBatch.from_arrays([pa.array([s for s, _ in out], pa.int64()), pa.array([row] * len(out), pa.int64()),
                                              pa.array([x for _, x in out], pa.binary())], names=["shard", "row", "data"])
            row += docs
    return send


#: What shards answer, by kind, in the columns row, v, a, b, n, k.
#: A document: id, -, -, tokens, held out. Sums of a document: base, more, known. Sums of a word v: what its bigrams hold, their unigram
#: probabilities, count if rare. To be done with v: bigrams found after it, bigrams not found.
DOCUMENT, SUMS, WORD, LATER = range(4)
ANSWERS = "kind int, row long, v long, a double, b double, n long, k long"


def _answers(kind: int, size: int, v_known: np.ndarray | None = None, **columns: np.ndarray) -> pa.RecordBatch:
    types = {"row": np.int64, "v": np.int64, "a": np.float64, "b": np.float64, "n": np.int64, "k": np.int64}
    filled = {c: np.asarray(columns[c]).astype(t) if c in columns else np.zeros(size, t) for c, t in types.items()}
    arrays = {c: pa.array(x, mask=~v_known if c == "v" and v_known is not None else None) for c, x in filled.items()}
    return pa.RecordBatch.from_arrays([pa.array(np.full(size, kind, np.int32)), *arrays.values()], names=["kind", *types])


class _Sums:
    """Sums by key over the shards of a task, in bounded memory."""

    def __init__(self, kind: int, key: str, values: list[str], most: int = SHARD):
        self.kind, self.key, self.values, self.most, self.parts, self.size = kind, key, values, most, [], 0

    def add(self, key: np.ndarray, *values: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.parts.append((key, *values))
        self.size += len(key)
        if self.size > 2 * self.most:
            (key,), values = self._sum()
            self.parts, self.size = [(key, *values)], len(key)
            if self.size > self.most:
                yield from self.rest()

    def _sum(self):
        key, *values = (np.concatenate(x) for x in zip(*self.parts, strict=True))
        return _summed([key], values)

    def rest(self) -> Iterator[pa.RecordBatch]:
        if self.parts:
            (key,), values = self._sum()
            yield _answers(self.kind, len(key), **{self.key: key}, **dict(zip(self.values, values, strict=True)))
        self.parts, self.size = [], 0


def _shard(m: Model, v, w, row, held, times, sums: _Sums, words: _Sums, rare: _Sums) -> Iterator[pa.RecordBatch]:
    """Counts of one shard, its part of the filter and its answers."""
    order = np.lexsort((v, w))
    v, w, row, held, times = (x[order] for x in (v, w, row, held, times))
    learned = np.where(held, 0, times)
    at = _starts(w)  # rare words have all their bigrams here
    of_word = np.repeat(np.arange(len(at)), np.diff(np.append(at, len(w))))
    second, c = w[at], np.add.reduceat(learned, at)
    frequent = second >= 0
    c[frequent] = m.counts[second[frequent]]
    yield from rare.add(second[~frequent], np.zeros((~frequent).sum()), np.zeros((~frequent).sum()), c[~frequent])
    uni = np.log10((c + 1) / (m.n + m.v + 1))
    at = _starts(w, v)
    of_pair = np.repeat(np.arange(len(at)), np.diff(np.append(at, len(w))))
    first, count, word_of = v[at], np.add.reduceat(learned, at), of_word[at]
    keys = _mix(first.astype(np.uint64) * _M2 + _mix(w[at].astype(np.uint64)))
    bigram, level = first != BEGIN, np.zeros(len(at), np.int64)
    enters = bigram & (count > 0)
    entered = m.levels_of(count[enters])
    level[bigram] = LogFrequencyFilter(keys[enters], entered).levels(keys[bigram])
    given = np.ones(len(at))  # rare v: counted elsewhere
    known_v = bigram & (first >= 0)
    given[known_v] = np.maximum(m.counts[first[known_v]], 1)
    held_by, base = (m.count_at(entered) - DISCOUNT) / given[enters], 10 ** uni[word_of[enters]]
    for known, part in ((known_v[enters], words), (~known_v[enters], rare)):
        yield from part.add(first[enters][known], held_by[known], base[known], np.zeros(int(known.sum()), np.int64))
    found = level > 0
    gain = np.zeros(len(at))
    gain[found] = np.log10((m.count_at(level[found]) - DISCOUNT) / given[found]) - uni[word_of[found]]
    yield from sums.add(row, times * uni[of_word], times * gain[of_pair], times * (c[of_word] > 0))
    later = (bigram & (~found | (first < 0)))[of_pair]
    hit = found[of_pair][later]
    (row, v), (hits, misses) = _summed([row[later], v[later]], [times[later] * hit, times[later] * ~hit])
    yield _answers(LATER, len(row), row=row, v=v, n=hits, k=misses)


def _answerer(model):
    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model = model.value
        sums, rare = _Sums(SUMS, "row", ["a", "b", "n"]), _Sums(WORD, "v", ["a", "b", "n"])
        words = _Sums(WORD, "v", ["a", "b", "n"], FREQUENT)  # these never pass on until the end of a task
        now, blocks = None, []

        def close() -> Iterator[pa.RecordBatch]:
            if blocks:
                v, w, row, held, times = (np.concatenate(x) for x in zip(*blocks, strict=True))
                blocks.clear()
                yield from _shard(m, v, w, row, held, times, sums, words, rare)

        for batch in batches:
            for shard, start, data in zip(*(batch.column(c) for c in ("shard", "row", "data")), strict=True):
                a, b, mark, c = _unpacked(data.as_py())
                row, held = start.as_py() + (mark >> np.uint32(1)).astype(np.int64), (mark & np.uint32(1)).astype(bool)
                if shard.as_py() < 0:
                    yield _answers(DOCUMENT, len(row), c > 0, row=row, v=a, n=b, k=held)
                    continue
                if shard.as_py() != now:
                    yield from close()
                    now = shard.as_py()
                blocks.append((a, b, row, held, c.astype(np.int64)))
        yield from close()
        for left in (sums, words, rare):
            yield from left.rest()
    return answer


def train(docs: DataFrame) -> tuple[Model, int]:
    """The model of frequent words, and the number of all tokens."""
    counted = materialise(docs.mapInArrow(_count_words, "word long, learned long, n long").groupBy("word").agg(
        F.sum("learned").alias("learned"), F.sum("n").alias("n")), "words")
    total = counted.agg(F.sum("learned"), F.count_if(F.col("learned") > 0), F.sum("n")).first()
    n, v, every = (x or 0 for x in total)
    common = max(1, -(-every // FREQUENT))
    # at most FREQUENT rows, as each has that share of all tokens
    head = counted.where(F.col("n") >= common).select("word", "learned").toArrow()
    hashes, counts = head.column("word").to_numpy().view(np.uint64), head.column("learned").to_numpy()
    order = np.argsort(hashes)
    return Model(hashes[order], counts[order], n, v, 1), every


def score(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row."""
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    model, every = train(read)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    tasks = max(docs.sparkSession.sparkContext.defaultParallelism, -(-every // TASK))
    blocks = read.mapInArrow(_sender(shared, max(1, -(-every // SHARD))), BLOCKS).repartition(tasks, "shard").sortWithinPartitions("shard")
    answers = materialise(blocks.mapInArrow(_answerer(shared), ANSWERS), "answers", "zstd")
    kind, v, zero = F.col("kind"), F.col("v"), F.lit(0.0)
    given = F.greatest(F.coalesce("c", F.lit(1)), F.lit(1))
    # frequent words are divided by their counts before
    left = (1 - F.col("held") / given, 1 - F.col("base"))
    of_word = answers.where(kind == WORD).groupBy("v").agg(F.sum("a").alias("held"), F.sum("b").alias("base"), F.sum("n").alias("c")).select(
        "v", F.log10(given).alias("log_c"), F.log10(F.greatest(left[0], F.lit(1e-9)) / F.greatest(left[1], F.lit(1e-9))).alias("backoff"))
    later = answers.where(kind == LATER)
    met = later.where(v >= 0).join(F.broadcast(of_word.where(v >= 0)), "v", "left").unionByName(
        later.where(v < 0).join(of_word.where(v < 0), "v", "left"))
    done = met.select("kind", "row", F.lit(None).cast("long").alias("v"), zero.alias("a"), (
        F.coalesce(F.col("k") * F.col("backoff"), zero) - F.coalesce(F.col("n") * F.col("log_c"), zero)).alias("b"),
        F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("k"))
    document = kind == DOCUMENT
    known = F.sum(F.when(kind == SUMS, F.col("n")).otherwise(0))
    return answers.where(kind.isin(DOCUMENT, SUMS)).unionByName(done).groupBy("row").agg(
        F.max(F.when(document, v)).alias("doc_id"), F.max(F.when(document, F.col("k"))).alias("held"),
        F.max(F.when(document, F.col("n"))).alias("n_tokens"), known.alias("n_known"), F.sum("a").alias("base_score"),
        F.sum("b").alias("more")).select(
        "doc_id", (F.col("held") == 1).alias("held_out"), "n_tokens", "n_known", F.lit(model.n).cast("long").alias("train_tokens"),
        "base_score", (F.col("base_score") + F.col("more")).alias("score"))
