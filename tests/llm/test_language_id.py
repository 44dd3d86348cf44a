"""Language identification: sums over segmentations by enumeration, held-out accuracy, odd rows."""

import math
import os
import sys
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from seqtide.llm import language_id  # noqa: E402

PATH = public_tokenizers.path("piece_bpe_32k.model")
SF = "/root/testdata/sf0.01"
WORDS = ["the", "hélène", "straße", "a", "日本語", "ﬁn", "x" * 20, "queneau", "\U0001d51e\U0001d51f"]


@pytest.fixture(scope="module")
def vocabulary():
    return language_id.pieces(PATH)


def cuts(vocabulary, word):
    """Every segmentation of the marked word, as lists of lists of pieces: a character that is no piece is those of its bytes."""
    model = sentencepiece.SentencePieceProcessor(model_file=PATH)
    text = "▁" + word

    def number(part):
        i = model.piece_to_id(part)
        return i if i != model.unk_id() and not model.is_byte(i) and not model.is_control(i) else None

    def grow(at):
        if at == len(text):
            yield []
            return
        for k in range(1, min(vocabulary.longest, len(text) - at) + 1):
            i = number(text[at:at + k])
            if i is not None:
                first = [i]
            elif k == 1:
                first = [model.piece_to_id(f"<0x{b:02X}>") for b in text[at].encode()]
            else:
                continue
            for rest in grow(at + k):
                yield [first, *rest]
    return list(grow(0))


def batch(words):
    return next(iter(language_id.by_length(words)))[1]


@pytest.mark.parametrize("word", WORDS[:6] + WORDS[7:])
def test_forward_sums_all_segmentations(vocabulary, word):
    share = np.random.default_rng(1).dirichlet(np.ones(vocabulary.size), 3).T.copy()
    want = sum(np.prod([share[i] for part in cut for i in part], axis=0) for cut in cuts(vocabulary, word))
    assert language_id.forward(vocabulary, share, batch([word]))[0] == pytest.approx(np.log(want), rel=1e-9)


@pytest.mark.parametrize("word", WORDS[:6] + WORDS[7:])
def test_expected_counts(vocabulary, word):
    counts = np.zeros((2, vocabulary.size))
    language_id.expected(vocabulary, batch([word]), np.array([[2, 0]]), counts)
    found = cuts(vocabulary, word)
    chance = [language_id.START ** len(cut) for cut in found]
    want = np.zeros(vocabulary.size)
    for cut, p in zip(found, chance, strict=True):
        for part in cut:
            for i in part:
                want[i] += 2 * p / sum(chance)
    assert counts[0] == pytest.approx(want, rel=1e-9) and not counts[1].any()


def test_long_runs_and_batches(vocabulary, monkeypatch):
    """Scores do not leave the range of doubles, and blocks of places change nothing."""
    share = np.random.default_rng(2).dirichlet(np.ones(vocabulary.size), 2).T.copy()
    words = ["ab" * 1500, "日é" * 1500]
    whole = language_id.forward(vocabulary, share, batch(words))
    monkeypatch.setattr(language_id, "BATCH", 200)
    for w, row in zip(words, whole, strict=True):
        assert np.isfinite(row).all()
        assert language_id.forward(vocabulary, share, batch([w]))[0] == pytest.approx(row, rel=1e-12)


def test_runs_and_their_weights():
    import pyarrow as pa
    runs = language_id.Runs(pa.array(["The cat,the 9cats!", "", "cat　Cat", "12 34"]))
    of = dict(zip(runs.names, runs.weights(np.array([0, 0, 1, 1]), 2).tolist(), strict=True))
    assert of == {"the": [2, 0], "cat": [1, 2], "cats": [1, 0]}
    assert runs.totals(np.ones(len(runs.names))).tolist() == [4, 0, 2, 0]


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    lang = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    found = language_id.identify(docs, PATH).collect()
    assert len(found) == len(lang)
    for r in found:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1
    tried = [r for r in found if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in tried) >= 0.97 * len(tried) > 100


def test_odd_rows(spark):
    schema = "doc_id long, text string, lang string, score double, lang_pred string, held_out string"
    rows = [(i, f"the cat and the dog {i}", "en", None, None, None) for i in range(20)]
    rows += [(i, f"le chat et la souris {i}", "fr", None, None, None) for i in range(20, 40)]
    odd = [(100, None, "en"), (101, "", "fr"), (102, "12 345 _-!", "en"), (103, "THE DOG", None), (None, "la souris", None), (103, "LE CHAT", None),
           (104, "the " * 20_000, None), (105, "\x00 et", None), (106, "z" * 500, None), (107, "日本", None)]
    docs = spark.createDataFrame(rows + [(*o, None, None, None) for o in odd], schema).repartition(3)
    found = sorted(((r.doc_id, r.lang_pred) for r in language_id.identify(docs, PATH).where("doc_id is null or doc_id >= 100").collect()), key=repr)
    assert [p for d, p in found if d in (100, 101, 102)] == ["und"] * 3
    assert [p for d, p in found if d == 103] == ["en", "fr"] and (None, "fr") in found and (104, "en") in found and (105, "fr") in found
    assert {p for d, p in found if d in (106, 107)} <= {"en", "fr"} and len(found) == len(odd)
    nothing = language_id.identify(docs.where("doc_id = 104"), PATH).collect()
    assert [(r.lang_pred, r.score) for r in nothing] == [("und", 0)]
    assert language_id.identify(docs.where("false"), PATH).count() == 0


def test_prior_decides_between_equals(vocabulary):
    model = language_id.Model(["a", "b"], np.array([1.0, 3.0]), np.zeros((2, vocabulary.size)))
    assert math.exp(model.prior[1]) == pytest.approx(0.75) and model.share.sum(axis=0) == pytest.approx([1, 1])
