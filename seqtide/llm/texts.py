"""Text batches inside Arrow tasks: bounded slices, words, ids by word.

Every operator on texts reads them through ``slices``, so the memory of a task
follows the slice, not the partition. A single text longer than a slice is a
slice of its own.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that a task works on at a time.
SLICE_BYTES = 4 << 20
#: Words whose ids a Python worker remembers between slices, unless it is told another number.
CACHE_WORDS = 1_000_000
#: Longer words are encoded in each slice anew.
CACHE_WORD_BYTES = 64


def text_array(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    """One string array; null becomes the empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return pc.fill_null(column.cast(pa.string()), "")


def slices(batches: Iterator[pa.RecordBatch], text: str = "text",
           size: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """Row ranges of about ``size`` bytes of text, each with its texts."""
    for batch in batches:
        if not batch.num_rows:
            continue
        texts = text_array(batch.column(text))
        ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False), dtype=np.int64)
        cuts = np.flatnonzero(np.diff(ends // size)) + 1
        bounds = [0, *cuts.tolist(), batch.num_rows]
        for a, b in zip(bounds, bounds[1:], strict=False):
            yield batch.slice(a, b - a), texts.slice(a, b - a)


def words(texts: pa.Array) -> list[list[bytes]]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of each text, in UTF-8."""
    return [t.split() for t in texts.cast(pa.binary()).to_pylist()]


def expand(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions of the ranges ``starts[i] .. starts[i] + lengths[i]``, one after another."""
    return np.arange(int(lengths.sum()), dtype=np.int64) + np.repeat(starts - (np.cumsum(lengths) - lengths), lengths)


def id_bytes(ids: list[int]) -> bytes:
    """Little-endian unsigned 32-bit ids."""
    return np.array(ids, "<u4").tobytes() if array("I").itemsize != 4 else array("I", ids).tobytes()


#: Letters a word may consist of to skip the library's normaliser and splitter: one
#: case-folded run of them is one pre-token, whatever version of Unicode is in use.
_PLAIN = "^(?P<stem>[A-Za-zÀ-ÖØ-öø-ÿ]+)(?P<mark>[.,;:!?]?)$"
#: Ends of words that are looked up apart.
_MARKS = ("", ".", ",", ";", ":", "!", "?")


def byte_letters() -> dict[int, str]:
    """The printable stand-ins that byte-level vocabularies use, by byte: printable
    Latin-1 stands for itself, the other bytes for U+0100 onwards in order."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


def _pool(ids: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids of several words: all of them, where those of a word begin, and how many they are."""
    size = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
    return np.frombuffer(b"".join(ids), "<u4"), np.cumsum(size) - size, size


class WordIds:
    """Ids of texts by a tokenizer for which white space only separates words.

    Each distinct word of a slice is looked up once, and the ids are put in place by arrays. The vocabulary
    ``word_bpe_49k.json`` splits at white space before any merge, its special
    tokens hold none, and its normaliser composes no character across it, so
    the ids of a text are those of its words in order. Its splitter also parts
    letters from punctuation: a word of plain letters goes straight to the
    library's merges, any other word through the whole library.
    """

    def __init__(self, path: str, remembered: int = CACHE_WORDS):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.remembered = remembered
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.letters = byte_letters()
        self.known: dict[str, bytes] = {}
        self.stems: dict[str, bytes] = {}
        self.marks = _pool(self._whole(list(_MARKS)))

    def _whole(self, parts: list[str]) -> list[bytes]:
        return [id_bytes(e.ids)
                for at in range(0, len(parts), 4096)
                for e in self.tokenizer.encode_batch_fast(parts[at:at + 4096], add_special_tokens=False)]

    def _stems(self, stems: list[str]) -> list[bytes]:
        """Ids of runs of plain lower-case letters, straight from the library's merges."""
        known, tokenize, letters = self.stems, self.tokenizer.model.tokenize, self.letters
        for stem in stems:
            if stem not in known:
                shown = stem if stem.isascii() else stem.encode().decode("latin-1").translate(letters)
                known[stem] = array("I", [t.id for t in tokenize(shown)]).tobytes()
        return list(map(known.__getitem__, stems))

    def _others(self, words: list[str]) -> list[bytes]:
        """Ids of other words, by the whole library."""
        missing = [w for w in words if w not in self.known]
        self.known.update(zip(missing, self._whole(missing), strict=True))
        return list(map(self.known.__getitem__, words))

    def _forget(self) -> None:
        if len(self.known) + len(self.stems) > self.remembered:  # the older half goes
            self.known = dict(islice(self.known.items(), len(self.known) // 2, None))
            self.stems = dict(islice(self.stems.items(), len(self.stems) // 2, None))

    def _drop_long(self, words: list[str], known: dict[str, bytes]) -> None:
        for word in words:
            if len(word) > CACHE_WORD_BYTES:
                known.pop(word, None)

    def _words(self, distinct: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of distinct words: all of them, where those of a word begin, and how many they are."""
        parts = pc.extract_regex(distinct, _PLAIN)
        plain = pc.is_valid(parts).to_numpy(zero_copy_only=False)
        stems = pc.utf8_lower(pc.struct_field(parts, "stem").filter(pa.array(plain))).dictionary_encode()
        marks = pc.index_in(pc.struct_field(parts, "mark").filter(pa.array(plain)), pa.array(_MARKS)).to_numpy()
        names, rest = stems.dictionary.to_pylist(), distinct.filter(pa.array(~plain)).to_pylist()
        heads, tails, others = _pool(self._stems(names)), self.marks, _pool(self._others(rest))
        self._drop_long(names, self.stems)
        self._drop_long(rest, self.known)
        stem = stems.indices.to_numpy()
        head, tail = heads[2][stem], tails[2][marks]
        size = np.empty(len(distinct), np.int64)
        size[plain], size[~plain] = head + tail, others[2]
        first = np.cumsum(size) - size
        out = np.empty(int(size.sum()), "<u4")
        out[expand(first[plain], head)] = heads[0][expand(heads[1][stem], head)]
        out[expand(first[plain] + head, tail)] = tails[0][expand(tails[1][marks], tail)]
        out[expand(first[~plain], others[2])] = others[0]
        return out, first, size

    def encode_flat(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after another, and the place where each text ends."""
        self._forget()
        split = pc.ascii_split_whitespace(texts)
        coded = split.flatten().dictionary_encode()
        ids, first, size = self._words(coded.dictionary)
        index = coded.indices.to_numpy()
        n = size[index]
        word_ends = np.cumsum(pc.list_value_length(split).to_numpy())
        return ids[expand(first[index], n)], np.concatenate([[0], np.cumsum(n)])[word_ends]

    def encode(self, texts: pa.Array) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        flat, ends = self.encode_flat(texts)
        raw, ends = flat.tobytes(), (ends * 4).tolist()
        return [raw[a:b] for a, b in zip([0, *ends], ends, strict=False)]


@lru_cache(maxsize=2)
def word_ids(path: str, remembered: int = CACHE_WORDS) -> WordIds:
    """One encoder for a Python worker."""
    return WordIds(path, remembered)


def forget() -> None:
    """Gives back what an earlier stage has left in this Python worker: its encoders and the words they remember."""
    word_ids.cache_clear()
    pa.default_memory_pool().release_unused()
