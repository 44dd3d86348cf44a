"""Language identification by unigrams of pieces, summed over all segmentations.

A text is its runs of letters, in lower case, each with the vocabulary's mark for a
word's begin in front. A language gives every piece of a fixed public vocabulary a
probability; a run's probability is the sum, over all ways to cut it into pieces, of the
products of their probabilities (a forward pass). A character outside the vocabulary
is the pieces of its bytes. The language with the highest posterior wins.

Learning is one expectation step: every piece counts by its posterior over all
segmentations of the training runs, where all pieces start alike. Each task adds up one array per
language, Spark adds those of the tasks, so the model is (languages x vocabulary)
numbers whatever the size of the corpus; more than ``LANGUAGES`` languages are an error.

The distinct runs of a slice are worked on together: the pieces that end at a
place are looked up for all runs of one length at once by a rolling hash.

A null text, or one without letters, gives ``und`` and score 0; so does a table
without training rows. Rows without an id are training rows and not held out. Rows are
judged one by one: repeated rows give one row each, no rows give none, other columns are
not read. Equal posteriors go to the smaller name.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqtide.llm.texts import slices

#: Bound on the languages of a model: 512 numbers by 32,000 pieces are 130 MB on every worker.
LANGUAGES = 512
#: Added to the count of every piece in every language.
SMOOTHING = 0.1
#: In learning, longer runs are taken in stretches of so many characters.
STRETCH = 96
#: Characters of distinct runs that are worked on at a time, and languages times these when scoring.
BATCH = 1 << 17
#: A piece in the expectation step, before anything is learnt.
START = 2.0 ** -10
#: Bytes of text of a slice: the larger, the fewer distinct runs in all.
SLICE = 8 << 20
UNKNOWN = "und"

_RUNS = r"[^\p{L}\p{M}]+"
_MARK = "▁"
_BASE, _ODD = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_SLOTS = 20


def held_out(of: int = 4, part: int = 2) -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % of == part, F.lit(False))


class Pieces:
    """The vocabulary: characters' hashes to piece numbers, and the pieces of bytes."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = model.get_piece_size()
        self.bytes = np.full(256, 0, np.int64)
        self.longest, keys, numbers = 1, [], []
        for i in range(self.size):
            if model.is_byte(i):
                self.bytes[int(model.id_to_piece(i)[3:5], 16)] = i
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                piece = model.id_to_piece(i)
                self.longest = max(self.longest, len(piece))
                total = np.uint64(0)
                with np.errstate(over="ignore"):
                    for c in piece:
                        total = total * _BASE + np.uint64(ord(c))
                    keys.append(total * _ODD + np.uint64(len(piece)))
                numbers.append(i)
        # two tables: the second holds the pieces whose slot in the first is taken
        self.keys, self.numbers = np.array([*keys, 0], np.uint64), np.array([*numbers, self.size], np.int32)
        self.first, rest = self._table(range(len(keys)), np.uint64(64 - _SLOTS), np.uint64(1))
        for seed in range(3, 1 << 20, 2):
            self.seed = np.uint64(seed)
            self.second, left = self._table(rest, np.uint64(64 - _SLOTS), self.seed)
            if not left:
                break
        self.powers = np.cumprod(np.array([1] + [_BASE] * self.longest, np.uint64))

    def _table(self, which, shift: np.uint64, seed: np.uint64) -> tuple[np.ndarray, list[int]]:
        table, left = np.full(1 << _SLOTS, len(self.keys) - 1, np.int32), []
        with np.errstate(over="ignore"):
            for i in which:
                slot = int(self.keys[i] * seed >> shift)
                if table[slot] == len(self.keys) - 1:
                    table[slot] = i
                else:
                    left.append(i)
        return table, left

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Piece numbers; ``size`` where there is none."""
        shift, empty = np.uint64(64 - _SLOTS), len(self.keys) - 1
        at = self.first[keys >> shift]
        same = self.keys[at] == keys
        out = np.full(keys.shape, self.size, np.int32)
        out[same] = self.numbers[at[same]]
        other = (at != empty) & ~same  # a piece in the second table always has another in its slot of the first
        rest = keys[other]
        at = self.second[rest * self.seed >> shift]
        out[other] = np.where(self.keys[at] == rest, self.numbers[at], self.size)
        return out

    def ending(self, letters: np.ndarray) -> Iterator[tuple[int, list[tuple[int, np.ndarray, np.ndarray]]]]:
        """``letters`` (n code points x runs): for each end 1 .. n the lengths k, runs and numbers of the pieces
        that end there. Characters that are no piece are numbered ``size`` + 1 + code point."""
        n, runs = letters.shape
        block = max(BATCH // runs, 64)
        for begin in range(0, n, block):
            stop = min(begin + block, n)
            found = []
            total = np.zeros((stop - begin, runs), np.uint64)
            for k in range(1, min(self.longest, stop) + 1):
                low = max(begin - k + 1, 0)  # first letter of the first window that fits
                skip = low + k - 1 - begin  # ends of the block that are nearer to the begin than k
                total[skip:] += letters[low:stop - k + 1] * self.powers[k - 1]
                ids = np.full(total.shape, self.size, np.int32)
                ids[skip:] = self.find(total[skip:] * _ODD + np.uint64(k))
                if k == 1:
                    bare = ids == self.size
                    ids[bare] = self.size + 1 + letters[begin:stop][bare].astype(np.int32)
                found.append(ids)
            for end in range(begin, stop):
                here = []
                for k, ids in enumerate(found, 1):
                    row = ids[end - begin]
                    at = np.flatnonzero(row != self.size)
                    if len(at):
                        here.append((k, at, row[at]))
                yield end + 1, here


@lru_cache(maxsize=2)
def pieces(path: str) -> Pieces:
    return Pieces(path)


class Runs:
    """The distinct runs of letters of some texts. Texts are cut at ASCII white space first, so that letters
    are looked for in distinct words only."""

    def __init__(self, texts: pa.Array):
        cut = pc.ascii_split_whitespace(texts)
        words = cut.flatten().dictionary_encode()
        self.word, self.text = words.indices.to_numpy(), pc.list_parent_indices(cut).to_numpy()
        self.n_texts, self.n_words = len(texts), len(words.dictionary)
        found = pc.split_pattern_regex(pc.utf8_lower(words.dictionary), _RUNS)
        flat, holder = found.flatten(), pc.list_parent_indices(found)
        full = pc.greater(pc.binary_length(flat), 0)
        coded = flat.filter(full).dictionary_encode()
        self.names: list[str] = coded.dictionary.to_pylist()
        self.run, self.holder = coded.indices.to_numpy(), holder.filter(full).to_numpy()

    def weights(self, group: np.ndarray, groups: int) -> np.ndarray:
        """How often each run occurs in the texts of each group."""
        of_word = np.bincount(self.word * np.int64(groups) + group[self.text], minlength=self.n_words * groups).reshape(-1, groups)
        return np.stack([np.bincount(self.run, of_word[self.holder, g], len(self.names)) for g in range(groups)], axis=1)

    def totals(self, values: np.ndarray) -> np.ndarray:
        """Sum over the runs of each text of one value a run."""
        of_word = np.bincount(self.holder, values[self.run], self.n_words)
        return np.bincount(self.text, of_word[self.word], self.n_texts)


def by_length(words: list[str], width: int = 1) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Numbers of the words and their code points (n x words) behind the mark, words of one length at a time."""
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
    flat = np.frombuffer((_MARK + _MARK.join(words)).encode("utf-32-le"), "<u4")
    starts = np.cumsum(lengths) - lengths
    order = np.argsort(lengths, kind="stable")
    cuts = np.flatnonzero(np.diff(lengths[order])) + 1
    for group in np.split(order, cuts):
        n = int(lengths[group[0]])
        step = max(BATCH // (n * width), 1)
        for a in range(0, len(group), step):
            some = group[a:a + step]
            yield some, flat[starts[some] + np.arange(n)[:, None]].astype(np.uint64)


def expected(vocabulary: Pieces, letters: np.ndarray, weights: np.ndarray, counts: np.ndarray) -> None:
    """Add to ``counts`` (languages x pieces) the posterior of every piece in runs that
    occur ``weights`` (runs x languages) times, all pieces being alike."""
    n, runs = letters.shape
    ends = [here for _, here in vocabulary.ending(letters)]
    before = np.zeros((n + 1, runs))
    before[0] = 1
    for j, here in enumerate(ends, 1):
        for k, at, _ in here:
            before[j, at] += before[j - k, at] * START
    after = np.zeros((n + 1, runs))
    after[n] = 1 / before[n]
    ids, shares, words = [], [], []
    for j in range(n, 0, -1):
        for k, at, number in ends[j - 1]:
            onward = after[j, at] * START
            after[j - k, at] += onward
            ids.append(number)
            words.append(at)
            shares.append(before[j - k, at] * onward)
    ids, shares, words = map(np.concatenate, (ids, shares, words))
    bare = np.flatnonzero(ids > vocabulary.size)
    if len(bare):  # a character outside the vocabulary counts for the pieces of its bytes
        raw = [vocabulary.bytes[np.frombuffer(chr(c).encode(), np.uint8)] for c in (ids[bare] - vocabulary.size - 1).tolist()]
        sizes = [len(r) for r in raw]
        known = np.flatnonzero(ids < vocabulary.size)
        ids = np.concatenate([ids[known], *raw])
        shares = np.concatenate([shares[known], np.repeat(shares[bare], sizes)])
        words = np.concatenate([words[known], np.repeat(words[bare], sizes)])
    for language in np.flatnonzero(weights.any(axis=0)).tolist():
        counts[language] += np.bincount(ids, shares * weights[words, language], vocabulary.size)


def _learner(path: str):
    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = pieces(path)
        names: dict[str, int] = {}
        counts, texts_of = np.zeros((0, vocabulary.size)), []
        for rows, texts in slices(batches, size=SLICE):
            langs = rows.column("lang").dictionary_encode()
            for name in langs.dictionary.to_pylist():
                if name not in names:
                    names[name] = len(names)
                    texts_of.append(0)
            if len(names) > LANGUAGES:
                raise ValueError(f"more than {LANGUAGES} languages")
            counts = np.concatenate([counts, np.zeros((len(names) - len(counts), vocabulary.size))])
            number = np.array([names[n] for n in langs.dictionary.to_pylist()], np.int64)[langs.indices.to_numpy()]
            for language in number.tolist():
                texts_of[language] += 1
            runs = Runs(texts)
            words = runs.names
            if not words:
                continue
            weights = runs.weights(number, len(names))
            short = [w[i:i + STRETCH] for w in words for i in range(0, len(w), STRETCH)] if max(map(len, words)) > STRETCH else words
            if short is not words:
                weights = np.repeat(weights, [-(-len(w) // STRETCH) for w in words], axis=0)
            for some, letters in by_length(short):
                expected(vocabulary, letters, weights[some], counts)
        for name, language in names.items():
            used = np.flatnonzero(counts[language])
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * (len(used) + 1), pa.string()), pa.array([-1, *used.tolist()], pa.int32()),
                 pa.array([float(texts_of[language]), *counts[language, used].tolist()], pa.float64())], names=["lang", "piece", "n"])
    return learn


class Model:
    """Names, log priors and piece probabilities (pieces x languages) of the languages."""

    def __init__(self, names: list[str], texts: np.ndarray, counts: np.ndarray):
        self.names, self.prior = names, np.log(texts / texts.sum()) if len(names) else texts
        smooth = counts + SMOOTHING
        self.share = (smooth / smooth.sum(axis=1, keepdims=True)).T.copy()


def learn(docs: DataFrame, vocabulary: str) -> Model:
    """The model of all rows of ``docs`` (text, lang) that have both."""
    rows = docs.where("text is not null and lang is not null").select("text", "lang")
    partial = rows.mapInArrow(_learner(vocabulary), "lang string, piece int, n double")
    # at most (languages x vocabulary) rows
    table = partial.groupBy("lang", "piece").agg(F.sum("n").alias("n")).toArrow()
    names = sorted(set(table.column("lang").to_pylist()))
    if len(names) > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages")
    of = {name: i for i, name in enumerate(names)}
    counts = np.zeros((len(names), pieces(vocabulary).size + 1))
    language = np.array([of[n] for n in table.column("lang").to_pylist()], np.int64)
    counts[language, table.column("piece").to_numpy()] = table.column("n").to_numpy()
    return Model(names, counts[:, -1], counts[:, :-1])  # piece -1: texts


def forward(vocabulary: Pieces, share: np.ndarray, letters: np.ndarray) -> np.ndarray:
    """Log-probability (runs x languages) of runs of one length."""
    runs, languages = letters.shape[1], share.shape[1]
    ring = [np.ones((runs, languages))]  # places behind the last ``longest`` characters, nearest last
    scale = np.zeros((runs, languages))
    bare: dict[int, np.ndarray] = {}
    for j, here in vocabulary.ending(letters):
        total = np.zeros((runs, languages))
        for k, at, number in here:
            if k == 1 and (number > vocabulary.size).any():
                chance = np.empty((len(at), languages))
                known = number < vocabulary.size
                chance[known] = share[number[known]]
                for c in np.unique(number[~known]).tolist():
                    if c not in bare:
                        raw = vocabulary.bytes[np.frombuffer(chr(c - vocabulary.size - 1).encode(), np.uint8)]
                        bare[c] = share[raw].prod(axis=0)
                    chance[number == c] = bare[c]
            else:
                chance = share[number]
            if len(at) == runs:
                total += ring[-k] * chance
            else:
                total[at] += ring[-k][at] * chance
        ring.append(total)
        if len(ring) > vocabulary.longest:
            del ring[0]
        if j % 8 == 0:  # products of so many small numbers would leave the range of doubles
            scale += np.log(total)
            ring = [r / total for r in ring]
    return scale + np.log(ring[-1])


def _judge(path: str, shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, model = pieces(path), shared.value
        for rows, texts in slices(batches, size=SLICE):
            runs = Runs(texts)
            words = runs.names
            lettered = np.asarray(pc.match_substring_regex(texts, r"\p{L}"))
            names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
            if words and model.names:
                logs = np.empty((len(words), len(model.names)))
                for some, letters in by_length(words, len(model.names)):
                    logs[some] = forward(vocabulary, model.share, letters)
                total = np.stack([runs.totals(logs[:, i]) for i in range(len(model.names))], axis=1) + model.prior
                best = total.argmax(axis=1)
                score = 1 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
                for i in np.flatnonzero(lettered).tolist():
                    names[i], scores[i] = model.names[best[i]], score[i]
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), rows.column("held_out"), pa.array(names, pa.string()), pa.array(scores)],
                                             names=["doc_id", "held_out", "lang_pred", "score"])
    return run


def identify(docs: DataFrame, vocabulary: str, model: Model | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred, score (the posterior of that language) of every row.

    Without ``model`` one is learnt from the rows of ``docs`` that are not held out.
    """
    if model is None:
        model = learn(docs.where(~held_out()), vocabulary)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), "text")
    return rows.mapInArrow(_judge(vocabulary, shared), "doc_id long, held_out boolean, lang_pred string, score double")
