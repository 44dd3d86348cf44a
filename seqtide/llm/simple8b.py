"""Simple-8b: selectors pack 1 to 60 values into the low 60 bits of a 64-bit word.

Values are cut into blocks that are packed on their own, so that a block can be
decoded without the others. A word's top four bits choose how many values it
holds; selector 15 is an escape whose low bits number a value of more than 60
bits, kept apart at full width.
"""

from __future__ import annotations

import numpy as np

#: Values a word holds, by selector; each has 60 // count bits.
COUNTS = (60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1)
ESCAPE = 15
BLOCK = 1024

_BITS16 = np.array([int(v).bit_length() for v in range(1 << 16)], np.uint8)
_COUNT_OF = np.array([*COUNTS, 0, 1], np.int64)


def _bits(values: np.ndarray) -> np.ndarray:
    out = _BITS16[(values & np.uint64(0xFFFF)).astype(np.int64)]
    for shift in (16, 32, 48):
        part = ((values >> np.uint64(shift)) & np.uint64(0xFFFF)).astype(np.int64)
        if part.any():
            out = np.where(part > 0, _BITS16[part] + np.uint8(shift), out)
    return out


def pack(values: np.ndarray, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``values`` -> (words, first word of each block, escaped values), all uint64."""
    values = np.ascontiguousarray(values, np.uint64)
    n = len(values)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    bits = _bits(values)
    left = block - np.arange(n) % block  # values from here to the end of the block
    left[n - n % block:] = np.arange(n % block, 0, -1)
    selector = np.full(n, 255, np.uint8)
    widest, reach = bits, 1  # widest[i] over reach values from i on
    spans = {1: bits}
    for count in sorted(COUNTS)[1:]:
        base = max(k for k in spans if k <= count)
        widest = spans[base].copy()
        reach = base
        while reach < count:
            step = max(k for k in spans if k <= count - reach)
            widest[:n - reach] = np.maximum(widest[:n - reach], spans[step][reach:])
            reach += step
        spans[count] = widest
    for s, count in enumerate(COUNTS):
        fits = (selector == 255) & (spans[count] <= 60 // count) & (left >= count)
        selector[fits] = s
    selector[selector == 255] = ESCAPE
    step = _COUNT_OF[selector]
    first = np.arange(0, n, block)
    last = np.minimum(first + block, n)
    rows, at = [], first.copy()
    while True:  # one word of every block at a time
        open_ = at < last
        if not open_.any():
            break
        rows.append(np.where(open_, at, -1))
        at = np.where(open_, at + step[np.where(open_, at, 0)], at)
    grid = np.stack(rows, axis=1)
    starts = grid[grid >= 0]
    blocks = np.cumsum(np.concatenate([[0], (grid >= 0).sum(axis=1)[:-1]])).astype(np.uint64)
    chosen = selector[starts]
    words = chosen.astype(np.uint64) << np.uint64(60)
    for s, count in enumerate(COUNTS):
        mine = np.flatnonzero(chosen == s)
        if len(mine):
            total = np.zeros(len(mine), np.uint64)
            for k in range(count):
                total |= values[starts[mine] + k] << np.uint64(k * (60 // count))
            words[mine] |= total
    mine = np.flatnonzero(chosen == ESCAPE)
    words[mine] |= np.arange(len(mine), dtype=np.uint64)
    return words, blocks, values[starts[mine]]


def unpack(words: np.ndarray, escaped: np.ndarray) -> np.ndarray:
    """The values of ``words``, any run of whole words of one ``pack``."""
    chosen = (words >> np.uint64(60)).astype(np.int64)
    counts = _COUNT_OF[chosen]
    ends = np.cumsum(counts)
    out = np.empty(int(ends[-1]) if len(ends) else 0, np.uint64)
    starts = ends - counts
    for s, count in enumerate(COUNTS):
        mine = np.flatnonzero(chosen == s)
        if len(mine):
            width = 60 // count
            mask = np.uint64((1 << width) - 1)
            w, at = words[mine], starts[mine]
            for k in range(count):
                out[at + k] = (w >> np.uint64(k * width)) & mask
    mine = np.flatnonzero(chosen == ESCAPE)
    if len(mine):
        out[starts[mine]] = escaped[(words[mine] & np.uint64((1 << 60) - 1)).astype(np.int64)]
    return out
