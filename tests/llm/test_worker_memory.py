"""What a Python worker keeps from one stage of the pipeline to the next."""

from functools import lru_cache

import pyarrow as pa

from seqtide.llm import jaccard_join, texts


def test_signing_gives_back_the_words_of_an_earlier_stage(monkeypatch):
    encoder = lru_cache(maxsize=2)(lambda path: object())
    monkeypatch.setattr(texts, "word_ids", encoder)
    encoder("vocabulary")
    rows = pa.RecordBatch.from_pydict({"doc_id": pa.array([1], pa.int64()), "text": pa.array(["a b c d e f"]), "mark": pa.array([7], pa.int64())})
    assert sum(b.num_rows for b in jaccard_join._sign(iter([rows]))) == 1
    assert encoder.cache_info().currsize == 0
