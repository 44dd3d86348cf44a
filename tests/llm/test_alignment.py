"""Tokenizer alignment against whole texts given to both libraries, with rows counted one by one."""

import os
import sys
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
import brute  # noqa: E402

from seqtide.llm import alignment, registry, texts  # noqa: E402

SF = "/root/testdata/sf0.001"
A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def aligned(rows):
    """The rows of the contract for (doc_id, text) rows."""
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B)
    byte = {c: k for k, c in texts.byte_letters().items()}
    linked = []
    for _, text in rows:
        ta = [(i, bytes(byte[c] for c in a.id_to_token(i))) for i in (a.encode(" " + text, add_special_tokens=False).ids if text else [])]
        tb = [(i, bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode())
              for i in (b.encode(text) if text else [])]
        raw = [b"".join(t for _, t in side) for side in (ta, tb)]
        if not text or raw[0] != raw[1] or raw[0] != (" " + text).encode():
            linked.append(([], [], [], None))
            continue
        spans = []
        for side in (ta, tb):
            at, out = 0, []
            for i, t in side:
                out.append((i, at, at + len(t)))
                at += len(t)
            spans.append(out)
        ends = sorted({e for _, _, e in spans[0]} & {e for _, _, e in spans[1]})
        groups, low = [], 0
        for e in ends:
            groups.append("|".join(",".join(str(i) for i, s, f in side if low <= s and f <= e) for side in spans))
            low = e
        links = [(i, j) for i, s, f in spans[0] for j, t, g in spans[1] if s < g and t < f]
        linked.append((ta, tb, links, ";".join(groups)))
    count = Counter(p for *_, links, _ in linked for p in set(links))
    most = Counter()
    for (i, _), n in count.items():
        most[i] = max(most[i], n)
    for (doc, _), (ta, tb, links, groups) in zip(rows, linked, strict=True):
        yield (doc, len(ta), len(tb), 0 if groups is None else groups.count(";") + 1, len(links), sum(count[p] == most[p[0]] for p in links),
               sum(count[p] for p in links), "" if groups is None else brute.sha(groups))


ODD = ["", None, " ", "a", " a", "a ", "a  b", "two   spaces\n\n  and lines \t tab", "a▁b", "ﬁ é日本語 <|endoftext|> <s> </s> don't 'LL it's",
       " x 　y  z", "x" * 3000, "the the the", "\x00 nul \x1c fs", "né é \U0001f600 \U0001f600", "the the the", "end.\n", "9" * 80, "a\r\nb"]
SCHEMA = "doc_id long, text string, n_a int, copies int, digest string, block int, pairs string"


def found(frame):
    return sorted((tuple(r[c] for c in COLUMNS) for r in frame.select(*COLUMNS).collect()), key=repr)


@pytest.mark.parametrize("block", [1 << 23, 40])
def test_odd_rows(spark, monkeypatch, block):
    monkeypatch.setattr(alignment, "BLOCK", block)
    rows = [(i, t) for i, t in enumerate(ODD)] + [(None, "the cat"), (3, "the cat"), (3, "the cat"), (3, "other")]
    docs = spark.createDataFrame([(*r, 1, 2, "d", 3, "p") for r in rows], SCHEMA).repartition(3)
    assert found(alignment.align(docs, A, B)) == sorted(aligned(rows), key=repr)


def test_no_rows(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert alignment.align(docs, A, B).count() == 0
    assert found(alignment.align(spark.createDataFrame([(1, None, 1, 2, "d", 3, "p")], SCHEMA), A, B)) == [(1, 0, 0, 0, 0, 0, 0, "")]


def test_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    short = [(d, t) for d, t in rows if t is None or len(t) < 3000]
    docs = spark.createDataFrame(short, "doc_id long, text string").repartition(4)
    assert found(alignment.align(docs, A, B)) == sorted(aligned(short), key=repr)
    whole = {r[0]: r for r in found(registry.load()[0]["op13_tokenizer_alignment"](spark, SF))}
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B)
    assert set(whole) == {d for d, _ in rows}
    for d, t in rows:
        assert whole[d][1:3] == (len(a.encode(" " + t, add_special_tokens=False).ids), len(b.encode(t)))


def test_forgetting_changes_nothing(monkeypatch):
    import pyarrow as pa
    texts_of = [f"word{i} shared and  odd{i % 7} spaces " + "l" * (i % 60) for i in range(300)]
    large = alignment.Aligner(A, B)
    want = large.align(pa.array(texts_of))
    monkeypatch.setattr(alignment, "CACHE", 50)
    monkeypatch.setattr(alignment, "JOINED", 300)
    small = alignment.Aligner(A, B)
    parts, links = [], []
    for i in range(0, 300, 10):
        parts.append(small.align(pa.array(texts_of[i:i + 10])))
        links += small.pairs[parts[-1][2]].tolist()
    assert links == large.pairs[want[2]].tolist()
    assert [x for p in parts for x in p[0].tolist()] == want[0].tolist()
    assert [x for p in parts for x in p[1]] == want[1] and len(small.listed) <= 50 + 10 * 70
