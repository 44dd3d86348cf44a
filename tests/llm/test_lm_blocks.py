"""Blocks of the language model's bigrams are small on their way to the shards."""

import numpy as np
import pyarrow as pa

from seqtide.llm import lm_scoring


def test_blocks_come_back_and_cost_few_bytes_a_bigram():
    rng = np.random.default_rng(8)
    v = np.sort(rng.integers(0, 1 << 20, 3000))
    columns = [v, rng.integers(0, 1 << 20, 3000), rng.integers(0, 800, 3000).astype(np.uint32), np.ones(3000, np.uint32)]
    data = lm_scoring._packed(columns)
    assert all((a == b).all() and a.dtype == b.dtype for a, b in zip(columns, lm_scoring._unpacked(data), strict=True))
    assert len(data) < 7 * 3000  # 24 bytes before Spark's codec until now
    odd = [np.array([-(1 << 63), (1 << 63) - 1, 1 << 40, 0]), np.array([-1, 1 << 62, 0, -(1 << 63)]), *[np.array([0, 1, 2, (1 << 32) - 1], np.uint32)] * 2]
    assert all((a == b).all() for a, b in zip(odd, lm_scoring._unpacked(lm_scoring._packed(odd)), strict=True))


def test_words_of_a_block_ascend(monkeypatch):
    class Shared:
        value = lm_scoring.Model(np.sort(np.array([lm_scoring._hash(b"w%d" % i) for i in range(40)], np.uint64)), np.ones(40, np.int64), 99, 50, 1)

    monkeypatch.setattr(lm_scoring, "TaskContext", type("T", (), {"get": staticmethod(lambda: type("C", (), {"partitionId": lambda self: 0})())}))
    rng = np.random.default_rng(9)
    texts = [" ".join(f"W{i}" for i in rng.integers(0, 60, 200)) for _ in range(5)]
    batch = pa.RecordBatch.from_pydict({"doc_id": [3, 1, None, 7, 5], "text": texts})
    pairs = {}
    for sent in lm_scoring._sender(Shared, 3)(iter([batch])):
        for shard, data in zip(sent.column("shard").to_pylist(), sent.column("data").to_pylist(), strict=True):
            if shard >= 0:
                v, w, doc, times = lm_scoring._unpacked(data)
                assert (np.diff(v[v != lm_scoring.BEGIN]) >= 0).all()
                for key in zip(v.tolist(), w.tolist(), (doc >> 1).tolist(), times.tolist(), strict=True):
                    pairs[key[:3]] = key[3]
    word = {i: int(Shared.value.place(np.array([h], np.uint64))[0]) for i in range(60) if (h := lm_scoring._hash(b"w%d" % i)) is not None}
    code = {i: p if p >= 0 else int(np.array([lm_scoring._hash(b"w%d" % i) | 1 << 63], np.uint64).view(np.int64)[0]) for i, p in word.items()}
    end = int(np.array([lm_scoring._hash(lm_scoring.END) | 1 << 63], np.uint64).view(np.int64)[0])
    want = {}
    for d, t in enumerate(texts):
        s = [lm_scoring.BEGIN, *(code[int(x[1:])] for x in t.split()), end]
        for key in zip(s, s[1:], [d] * len(s), strict=False):
            want[key] = want.get(key, 0) + 1
    assert pairs == want
