"""Plain restatements that the operators are tested against."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def crc_of(ids) -> int:
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def sha(data: bytes | str) -> str:
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def word_ids(texts):
    import public_tokenizers
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    return [e.ids for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def shingles(text):
    w = WORD.findall((text or "").lower())
    return frozenset([tuple(w)] if 0 < len(w) < 5 else [tuple(w[i:i + 5]) for i in range(len(w) - 4)])


def links(texts):
    """(component label by position, links by position) of similarity >= 0.8; empty sets are equal."""
    sets = [shingles(t) for t in texts]
    holders = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s or [None]:
            holders[x].append(i)
    parent, n = list(range(len(sets))), [0] * len(sets)

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i, s in enumerate(sets):
        shared = Counter(j for x in s or [None] for j in holders[x] if j > i)
        for j, k in shared.items():
            if not s or 5 * k >= 4 * (len(s) + len(sets[j]) - k):
                n[i] += 1
                n[j] += 1
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(sets))], n


def scores(rows):
    """(doc_id, text) rows -> (held_out, n_tokens, n_known, train tokens, base score) per row."""
    split = [((t or "").encode().lower().split()) + [b"\n"] for _, t in rows]
    out = [d is not None and zlib.crc32(str(d).encode()) % 7 == 2 for d, _ in rows]
    c = Counter(w for s, h in zip(split, out, strict=True) if not h for w in s)
    n, v = sum(c.values()), len(c)
    return [(h, len(s), sum(c[w] > 0 for w in s), n, sum(math.log10((c[w] + 1) / (n + v + 1)) for w in s))
            for s, h in zip(split, out, strict=True)]


def quality(text):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words)"""
    text = text or ""
    w = WORD.findall(text)
    tri = Counter(zip(w, w[1:], w[2:], strict=False))
    covered = {i + k for i in range(len(w) - 2) if tri[tuple(w[i:i + 3])] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


def exact(rows):
    """(doc_id, text) rows -> list of (keep_id, group size, digest)"""
    norm = [re.sub(r"[\x20\x09-\x0D]+", "", t or "") for _, t in rows]
    groups = defaultdict(list)
    for (d, t), x in zip(rows, norm, strict=True):
        groups[x].append((-len(t or ""), d is None, d or 0, d))
    return [(min(groups[x])[3], len(groups[x]), sha(x)) for x in norm]


def pieces(n, largest=2048):
    return [largest] * (n // largest) + [b for b in (1 << k for k in range(largest.bit_length() - 2, -1, -1)) if n % largest & b]
