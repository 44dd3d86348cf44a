"""Byte-level BPE through a sentencepiece model that is written from the rank file.

Every byte gets a printable letter; a token is the letters of its bytes and its
score is the negative rank, so sentencepiece merges the lowest rank first, as the
rank file asks. The model normalises nothing. Texts are cut by the vocabulary's
pattern before and each match is encoded by itself; ids are ranks, and decoding
joins the bytes of the ranks.

Texts are cut at single spaces first: before a space between two other characters
every match ends, so the stretches in between are encoded once each and remembered.

Null texts count as empty and have no ids. Rows are independent: repeated rows and
ids give one row each, no rows give none, other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator
from functools import cached_property, lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from seqtide.llm.texts import byte_letters, id_bytes, slices

#: Stretches of text that a Python worker remembers.
CACHE = 500_000
#: Longer stretches are encoded each time.
CACHE_CHARS = 64


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


def _field(number: int, wire: int, payload: bytes) -> bytes:
    return _varint(number << 3 | wire) + payload


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes(out + bytes([n]))


def _bytes(number: int, payload: bytes) -> bytes:
    return _field(number, 2, _varint(len(payload)) + payload)


def _integer(number: int, value: int) -> bytes:
    return _field(number, 0, _varint(value & (1 << 64) - 1))


def model_bytes(ranks: dict[bytes, int], letters: dict[int, str]) -> bytes:
    """A sentencepiece BPE model: piece 0 is unknown, piece i + 1 the i-th lowest rank."""
    # sentencepiece_model.proto: pieces = 1 (piece 1, score 2, type 3: 1 normal, 2 unknown),
    # trainer_spec = 2 (model_type 3: 2 BPE, vocab_size 4, unk_id 40, bos_id 41, eos_id 42, pad_id 43),
    # normalizer_spec = 3 (name 1, add_dummy_prefix 3, remove_extra_whitespaces 4, escape_whitespaces 5)
    pieces = [_bytes(1, _bytes(1, b"<unk>") + _field(2, 5, struct.pack("<f", 0)) + _integer(3, 2))]
    for token, rank in sorted(ranks.items(), key=lambda x: x[1]):
        text = "".join(letters[b] for b in token).encode()
        pieces.append(_bytes(1, _bytes(1, text) + _field(2, 5, struct.pack("<f", -rank)) + _integer(3, 1)))
    trainer = _integer(3, 2) + _integer(4, len(pieces)) + _integer(40, 0) + b"".join(
        _integer(n, -1) for n in (41, 42, 43))
    normaliser = _bytes(1, b"identity") + _integer(3, 0) + _integer(4, 0) + _integer(5, 0)
    return b"".join(pieces) + _bytes(2, trainer) + _bytes(3, normaliser)


class ByteBpe:
    """Encoder and decoder of one rank file."""

    def __init__(self, path: str, pattern: str):
        import regex

        self.ranks = read_ranks(path)
        self.letters = byte_letters()
        self.by_piece = np.array([0, *sorted(self.ranks.values())], np.int64)
        self.token = {rank: token for token, rank in self.ranks.items()}
        self.decimal = {rank: b"%d," % rank for rank in self.token}
        self.matches = regex.compile(pattern).findall
        self.known: dict[str, bytes] = {}

    @cached_property
    def model(self):
        """Built by workers that encode, not by those that only decode."""
        import sentencepiece

        return sentencepiece.SentencePieceProcessor(model_proto=model_bytes(self.ranks, self.letters))

    def _stretches(self, text: str, plain: dict[str, bool]) -> list[str]:
        """Parts of ``text`` between whose ends no match runs on."""
        parts = text.split(" ")
        if all(map(plain.__getitem__, parts)):
            return [parts[0], *map(" ".__add__, parts[1:])]
        return self.matches(text)  # white space of other kinds, or more than one space

    def _pretokens(self, distinct: list[str]) -> list[bytes]:
        out: list[bytes] = [b""] * len(distinct)
        rest, mapped = [], []
        for i, text in enumerate(distinct):
            raw = text.encode()
            rank = self.ranks.get(raw)
            if rank is not None:  # a match that is a token stays whole, even where merges do not lead to it
                out[i] = id_bytes([rank])
            else:
                rest.append(i)
                mapped.append(raw.decode("latin-1").translate(self.letters))
        for i, pieces in zip(rest, self.model.encode(mapped, out_type=int, num_threads=1) if rest else [], strict=True):
            out[i] = self.by_piece[pieces].astype("<u4").tobytes()
        return out

    def _learn(self, missing: list[str]) -> None:
        cut = [self.matches(s) for s in missing]
        distinct = list(set(chain.from_iterable(cut)))
        ids = dict(zip(distinct, self._pretokens(distinct), strict=True)).__getitem__
        self.known.update((s, b"".join(map(ids, c))) for s, c in zip(missing, cut, strict=True))

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        if len(self.known) > CACHE:
            self.known = {}
        words = set(chain.from_iterable(t.split(" ") for t in texts))
        plain = {w: bool(w) and not w[0].isspace() and not w[-1].isspace() for w in words}
        cut = [self._stretches(t, plain) if t else [] for t in texts]
        missing = set(chain.from_iterable(cut)).difference(self.known)
        self._learn(list(missing))
        out = [b"".join(map(self.known.__getitem__, c)) for c in cut]
        for s in missing:
            if len(s) > CACHE_CHARS:
                del self.known[s]
        return out

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.token.__getitem__, ids))

    def listed(self, ids: list[int]) -> bytes:
        """Decimal ids joined by commas."""
        return b"".join(map(self.decimal.__getitem__, ids))[:-1]


@lru_cache(maxsize=2)
def byte_bpe(path: str, pattern: str) -> ByteBpe:
    """One encoder for a Python worker."""
    return ByteBpe(path, pattern)


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, ids (little-endian unsigned 32-bit) of every text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = byte_bpe(path, pattern)
        for rows, texts in slices(batches):
            ids = pa.array(bpe.encode(texts.to_pylist()), pa.binary())
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), ids], names=["doc_id", "ids"])
    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(run, "doc_id long, ids binary")


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (of the decimal ids, comma-separated), decoded bytes of every row of ids."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = byte_bpe(path, pattern)
        for batch in batches:
            ends = np.cumsum(pc.binary_length(batch.column("ids")).to_numpy(zero_copy_only=False), dtype=np.int64)
            bounds = [0, *(np.flatnonzero(np.diff(ends // (8 << 20))) + 1).tolist(), batch.num_rows]
            for a, b in zip(bounds, bounds[1:], strict=False):
                rows = batch.slice(a, b - a)
                ids = [np.frombuffer(x, "<u4").tolist() for x in rows.column("ids").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [rows.column("doc_id"), pa.array(map(len, ids), pa.int64()),
                     pa.array([hashlib.sha256(bpe.listed(x)).hexdigest() for x in ids], pa.string()),
                     pa.array(map(bpe.decode, ids), pa.binary())],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded"])
    return encoded.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded binary")
