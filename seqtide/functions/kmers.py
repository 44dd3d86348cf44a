"""K-mer helpers: numpy kernels behind Arrow functions.

Each works on the joined letters of a whole batch, in runs of bounded size; no loop
touches single letters or k-mers. Windows holding a letter other than A, C, G, T, and
windows that would reach into the next sequence, are skipped.
"""

from __future__ import annotations

import ctypes
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

# A k-mer is a base-4 number of at most 62 bits; its hash is (code * FACTOR + SHIFT) mod
# PRIME, a bijection for k <= 30, simple enough to state in SQL as well.
PRIME = (1 << 61) - 1
FACTOR = 1103515245
SHIFT = 12345
MAX_K = 30

#: Letters that a kernel works on at a time: the arrays of 8 bytes a letter stay in a core's cache.
RUN_LETTERS = 1 << 17

_DIGIT = np.full(256, -1, np.int8)
for _i, _base in enumerate("ACGT"):
    _DIGIT[ord(_base)] = _DIGIT[ord(_base.lower())] = _i


def letters(sequences: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all sequences, offset of each and the end): one byte per letter, null as empty."""
    if isinstance(sequences, pa.ChunkedArray):
        sequences = sequences.combine_chunks()
    flat = sequences.fill_null("").cast(pa.string())
    offsets = np.frombuffer(flat.buffers()[1], np.int32, len(flat) + 1, 4 * flat.offset).astype(np.int64)
    data = flat.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    if len(raw) and raw.max() > 127:  # letters of several bytes count as one unknown letter
        parts = [s.encode("ascii", "replace") for s in flat.to_pylist()]
        offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
        return np.frombuffer(b"".join(parts), np.uint8), offsets
    return raw, offsets - offsets[0]


def runs(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``RUN_LETTERS`` letters."""
    cuts = np.flatnonzero(np.diff(offsets[1:] // RUN_LETTERS)) + 1
    bounds = [0, *cuts.tolist(), len(offsets) - 1]
    yield from ((a, b) for a, b in zip(bounds, bounds[1:]) if b > a)


def kmer_codes(raw: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(base-4 code, place in ``raw``) of every clean window, in order."""
    if k > MAX_K:
        raise ValueError(f"k is at most {MAX_K}")
    n = len(raw) - k + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    digits = _DIGIT[raw]
    codes, width = np.maximum(digits, 0).astype(np.int64), 1
    whole, done = None, 0
    rest = k
    while True:  # codes of width 1, 2, 4, ... are put together
        if rest & 1:
            if whole is None:
                whole, done = codes, width
            else:
                m = len(raw) - done - width + 1
                whole, done = (codes[:m] << np.int64(2 * done)) + whole[width:width + m], done + width
        rest >>= 1
        if not rest:
            break
        m = len(raw) - 2 * width + 1
        codes, width = (codes[:m] << np.int64(2 * width)) + codes[width:width + m], 2 * width
    bad = np.concatenate([[0], np.cumsum(digits < 0)])
    clean = bad[k:] == bad[:-k]
    ends = np.repeat(offsets[1:], np.diff(offsets))[:n]
    clean &= np.arange(n) + k <= ends
    places = np.flatnonzero(clean)
    return whole[places], places


def kmer_hash(codes: np.ndarray) -> np.ndarray:
    """(code * FACTOR + SHIFT) mod 2^61 - 1, in 64-bit steps."""
    factor = np.uint64(FACTOR)
    code = _modulo(codes.astype(np.uint64))
    high, low = code >> np.uint64(31), code & np.uint64((1 << 31) - 1)
    high = _modulo(high * factor)
    turned = ((high << np.uint64(31)) & np.uint64(PRIME)) | (high >> np.uint64(30))  # times 2^31
    return _modulo(turned + _modulo(low * factor) + np.uint64(SHIFT)).astype(np.int64)


def _modulo(x: np.ndarray) -> np.ndarray:
    """x mod 2^61 - 1 without a division: the upper bits count once more."""
    prime = np.uint64(PRIME)
    x = (x & prime) + (x >> np.uint64(61))
    return np.where(x >= prime, x - prime, x)


def frequency_matrix(sequences: pa.Array, k: int, dimension: int) -> np.ndarray:
    """Hashed k-mer counts per sequence, scaled to unit length (zero when there is no k-mer)."""
    raw, offsets = letters(sequences)
    out = np.zeros((len(offsets) - 1, dimension), np.float32)
    for a, b in runs(offsets):
        own = offsets[a:b + 1] - offsets[a]
        codes, places = kmer_codes(raw[offsets[a]:offsets[b]], own, k)
        row = np.repeat(np.arange(b - a), np.diff(own))[places]
        cells = row * dimension + kmer_hash(codes) % dimension
        counts = np.bincount(cells, minlength=(b - a) * dimension).reshape(b - a, dimension).astype(np.float64)
        length = np.sqrt((counts * counts).sum(axis=1, keepdims=True))
        out[a:b] = counts / np.where(length == 0, 1, length)
    return out


def kmer_vector_udf(k: int, dimension: int):
    """sequence -> array<float> of length ``dimension``."""
    @F.arrow_udf("array<float>")
    def encode(sequences: pa.Array) -> pa.Array:
        rows = frequency_matrix(sequences, k, dimension)
        offsets = np.arange(0, rows.size + 1, dimension, dtype=np.int32)
        return pa.ListArray.from_arrays(offsets, pa.array(rows.reshape(-1)))
    return encode


def smallest_distinct(hashes: np.ndarray, starts: np.ndarray, count: int
                      ) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` smallest distinct hashes with their first starts.

    Only the lower end is sorted; if repeats leave it short of distinct values, all is.
    """
    lower = 4 * count
    if len(hashes) > 2 * lower:
        near = np.flatnonzero(hashes <= np.partition(hashes, lower)[lower])
        values, first = np.unique(hashes[near], return_index=True)
        if len(values) >= count:
            return values[:count], starts[near[first[:count]]]
    values, first = np.unique(hashes, return_index=True)
    return values[:count], starts[first[:count]]


SKETCH = "array<struct<kmer:bigint,position:int>>"


def smallest_kmers_udf(k: int, count: int):
    """sequence -> its ``count`` smallest distinct k-mer hashes, with first positions."""
    @F.arrow_udf(SKETCH)
    def sketch(sequences: pa.Array) -> pa.Array:
        raw, offsets = letters(sequences)
        kmers, positions, sizes = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], []
        for a, b in runs(offsets):
            own = offsets[a:b + 1] - offsets[a]
            codes, places = kmer_codes(raw[offsets[a]:offsets[b]], own, k)
            hashes, cuts = kmer_hash(codes), np.searchsorted(places, own)
            for i in range(b - a):
                values, first = smallest_distinct(hashes[cuts[i]:cuts[i + 1]], places[cuts[i]:cuts[i + 1]] - own[i], count)
                kmers.append(values)
                positions.append(first)
                sizes.append(len(values))
        ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
        both = pa.StructArray.from_arrays([pa.array(np.concatenate(kmers)), pa.array(np.concatenate(positions).astype(np.int32))],
                                          ["kmer", "position"])
        return pa.ListArray.from_arrays(ends, both)
    return sketch


def matching_bases_udf():
    """Equal letters of two sequences laid over each other on one diagonal.

    ``diagonal`` is centre position minus member position.
    """
    @F.arrow_udf("long")
    def matches(centre: pa.Array, member: pa.Array, diagonal: pa.Array) -> pa.Array:
        (a, a_off), (b, b_off) = letters(centre), letters(member)
        d = diagonal.to_numpy(zero_copy_only=False).astype(np.int64)
        a_from, b_from = a_off[:-1] + np.maximum(d, 0), b_off[:-1] + np.maximum(-d, 0)
        sizes = np.maximum(np.minimum(a_off[1:] - a_from, b_off[1:] - b_from), 0)
        out = np.zeros(len(d), np.int64)
        for i, (x, y, n) in enumerate(zip(a_from.tolist(), b_from.tolist(), sizes.tolist(), strict=True)):
            out[i] = np.count_nonzero(a[x:x + n] == b[y:y + n])
        return pa.array(out)
    return matches


def _scaled(sequences: pa.Array, k: int, scale: int, hashed: bool) -> tuple[np.ndarray, np.ndarray]:
    """(values ascending by sequence, how many of each) of the distinct k-mers whose hash is below 1/``scale`` of the
    range: their hashes, or else their codes."""
    raw, offsets = letters(sequences)
    kept, sizes = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for a, b in runs(offsets):
        own = offsets[a:b + 1] - offsets[a]
        codes, places = kmer_codes(raw[offsets[a]:offsets[b]], own, k)
        hashes = kmer_hash(codes)
        low = np.flatnonzero(hashes < PRIME // scale)
        row, values = np.searchsorted(own, places[low], "right") - 1, (hashes if hashed else codes)[low]
        order = np.lexsort((values, row))
        row, values = row[order], values[order]
        new = np.ones(len(row), bool)
        new[1:] = (row[1:] != row[:-1]) | (values[1:] != values[:-1])
        kept.append(values[new])
        sizes.append(np.bincount(row[new], minlength=b - a))
    return np.concatenate(kept), np.concatenate(sizes)


def scaled_kmers_udf(k: int, scale: int):
    """sequence -> its distinct k-mer hashes below 1/``scale`` of their range, ascending.

    Which hashes are kept does not depend on the sequence: those of a part are among those of the whole.
    """
    @F.arrow_udf("array<bigint>")
    def sketch(sequences: pa.Array) -> pa.Array:
        kept, sizes = _scaled(sequences, k, scale, True)
        return pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32), pa.array(kept))
    return sketch


def varint(numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, end of each number) of numbers that are not negative: seven bits a byte, the highest bit on all but the last."""
    size = np.ones(len(numbers), np.int8)
    for step in range(1, 9):
        more = numbers >= 1 << 7 * step
        if not more.any():
            break
        size += more
    ends = np.cumsum(size, dtype=np.int64)
    out = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint8)
    for step in range(int(size.max(initial=0))):
        some = np.flatnonzero(size > step)
        more = np.where(size[some] > step + 1, 128, 0)
        out[ends[some] - size[some] + step] = ((numbers[some] >> np.int64(7 * step)) & 127) | more
    return out, ends


def from_varint(data: np.ndarray) -> np.ndarray:
    """The numbers of ``varint``."""
    last = np.flatnonzero(data < 128)
    first = np.concatenate([[0], last[:-1] + 1]) if len(last) else last
    size = last - first + 1
    out = (data[first] & 127).astype(np.int64)
    for step in range(1, int(size.max(initial=0))):
        some = np.flatnonzero(size > step)
        out[some] |= (data[first[some] + step] & 127).astype(np.int64) << np.int64(7 * step)
    return out


_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None) if os.name == "posix" else None


def give_back() -> None:
    """Memory that holds nothing goes back to the system: a worker keeps little of it while it waits."""
    pa.default_memory_pool().release_unused()
    if _TRIM is not None:
        _TRIM(0)


SCALED = "struct<n:int,codes:binary>"


def scaled_codes_udf(k: int, scale: int):
    """sequence -> number and codes of the k-mers that ``scaled_kmers_udf`` keeps, as steps of ascending codes in ``varint``.

    Code and hash stand for each other, so the sets have the same sizes and the same common members.
    """
    @F.arrow_udf(SCALED)
    def sketch(sequences: pa.Array) -> pa.Array:
        kept, sizes = _scaled(sequences, k, scale, False)
        steps = np.diff(kept, prepend=0)
        first = (np.cumsum(sizes) - sizes)[sizes > 0]
        steps[first] = kept[first]
        data, ends = varint(steps)
        ends = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(sizes)])].astype(np.int32)
        codes = pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(ends), pa.py_buffer(data)])
        give_back()
        return pa.StructArray.from_arrays([pa.array(sizes.astype(np.int32)), codes], ["n", "codes"])
    return sketch


def codes_udf():
    """``codes`` of ``scaled_codes_udf`` -> the codes, ascending."""
    @F.arrow_udf("array<bigint>")
    def unpacked(codes: pa.Array) -> pa.Array:
        lists = [np.cumsum(from_varint(np.frombuffer(x.as_buffer(), np.uint8))) for x in codes]
        ends = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int32)
        return pa.ListArray.from_arrays(ends, pa.array(np.concatenate([np.zeros(0, np.int64), *lists])))
    return unpacked
