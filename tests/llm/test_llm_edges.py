"""Nulls, empty and long texts, ties, repeated rows, clashing columns, empty tables."""

import math
import os
import sys
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
import brute  # noqa: E402

from seqtide.llm import (  # noqa: E402
    byte_bpe,
    chat_format,
    components,
    exact_dedup,
    jaccard_join,
    license_scan,
    lm_scoring,
    packing,
    quality_rules,
    simple8b,
    token_counts,
    token_files,
)
from seqtide.session import scratch_path  # noqa: E402

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
PROSE = " ".join(f"word{i % 97} the of {i}" for i in range(60))
TEXTS = [
    (1, PROSE), (2, PROSE.replace(" ", "\n")), (2, PROSE.replace(" ", "\n")), (3, PROSE + " and one more end"), (4, None), (5, ""),
    (6, " \t\r\n "), (7, "one"), (8, "One two three four"), (9, "one  two three FOUR"), (10, "x" * 30_000), (11, "a b c d e " * 9_000),
    (12, "é̂ ẞ İ <|endoftext|> \x00 \x1c日本 don't 'LL"), (None, PROSE), (None, None), (None, "alone without a name at all here"),
    (13, "same line\nsame line\n\nReleased under the MIT License.\n"), (14, PROSE + "   "), (-5, "minus"), (13, "another text of document 13"),
]
SCHEMA = "doc_id long, text string, key long, n int, full string, id string, label string, row long, chars int, kept boolean, _0 string"


@pytest.fixture(scope="module")
def docs(spark):
    more = [(1, 2, "f", "i", "l", 3, 4, False, None)] * len(TEXTS)
    return spark.createDataFrame([t + m for t, m in zip(TEXTS, more, strict=True)], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def order(values):
    return sorted(values, key=repr)


def test_quality(docs, none):
    found = quality_rules.judge(docs).collect()
    want = order((d, *brute.quality(t)) for d, t in TEXTS)
    assert order((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in found) == want
    for r in found:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)
    assert quality_rules.kept(docs).columns == docs.columns and quality_rules.kept(none).count() == 0
    assert {r.doc_id for r in quality_rules.kept(docs).collect()} >= {1, 3, 14}


def test_exact_dedup(docs, none):
    found = exact_dedup.report(docs).collect()
    want = order((d, *x) for (d, _), x in zip(TEXTS, brute.exact(TEXTS), strict=True))
    assert order((r.doc_id, r.keep_id, r.group_size, r.full) for r in found) == want
    assert sum(r.kept for r in found) == len({r.full for r in found})
    kept = exact_dedup.kept(docs)
    assert kept.columns == docs.columns and kept.count() == len({r.full for r in found})
    assert 14 in {r.doc_id for r in kept.collect()} and exact_dedup.report(none).count() == exact_dedup.kept(none).count() == 0


def test_prefix_alone_does_not_decide(spark):
    rows = [(1, "a" * 300 + "b"), (2, "a" * 300 + "c"), (3, "a" * 300 + "b")]
    found = {r.doc_id: r.keep_id for r in exact_dedup.report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == {1: 1, 2: 2, 3: 1}


def test_token_counts_and_cache(spark, docs, none):
    cache = scratch_path(spark, "cache")
    want = order((d, len((t or "").encode()), len(i)) for (d, t), i in zip(TEXTS, brute.word_ids([t for _, t in TEXTS]), strict=True))
    assert order(map(tuple, token_counts.count_tokens(docs, VOCABULARY, cache).collect())) == want
    stored = spark.read.parquet(cache)
    first = stored.count()
    assert stored.select("content").distinct().count() == first
    assert order(map(tuple, token_counts.count_tokens(docs, VOCABULARY, cache).collect())) == want
    named = spark.read.parquet(cache)
    assert named.select("content").distinct().count() == first  # nothing new to know
    # what the cache says is believed: no text is encoded again
    lies = scratch_path(spark, "cache")
    stored.withColumn("n_tokens", stored.n_tokens + 1000).write.parquet(lies)
    some = docs.where("doc_id in (1, 10)")
    assert all(r.n_tokens >= 1000 for r in token_counts.count_tokens(some, VOCABULARY, lies).collect())
    assert token_counts.count_tokens(none, VOCABULARY, scratch_path(spark, "cache")).count() == 0


def test_ids_of_odd_words(monkeypatch):
    """Plain words, their case and marks, and all others, as the library gives them; forgetting changes nothing."""
    import pyarrow as pa

    from seqtide.llm import texts
    odd = ["É. ÀÉ, ß! ÿ? Þing; word: a.b don't 'LL .. !? × ÷ æÆ", "İ ı ﬁ ẞ é̂ e\u0301 日本 <|endoftext|> x\x00y \x1c fs\u3000wide", "", " \t\r\n\v\f ",
           " ".join(f"w{i} Word{chr(97 + i % 26)}{'abc'[i % 3] * (i % 9)}," for i in range(400)), "l" * 300 + " " + "9" * 200]
    for remembered in (1_000_000, 10):
        encoder = texts.WordIds(VOCABULARY, remembered)
        for _ in range(2):
            assert [np.frombuffer(x, "<u4").tolist() for x in encoder.encode(pa.array(odd))] == brute.word_ids(odd)
        assert not any(len(w) > texts.CACHE_WORD_BYTES for w in [*encoder.known, *encoder.stems])


def test_texts_without_ids_are_read_once(spark):
    cache = scratch_path(spark, "cache")
    rows = [(None, f"text number {i}") for i in range(50)] * 2
    token_counts.count_tokens(spark.createDataFrame(rows, "doc_id long, text string"), VOCABULARY, cache).count()
    more = spark.createDataFrame([*rows, (None, "a new text"), (None, "a  new text"), (1, "text number 3")], "doc_id long, text string")
    found = token_counts.count_tokens(more, VOCABULARY, cache).collect()
    assert len(found) == 103 and spark.read.parquet(cache).count() == 51


def test_packing(spark, docs, none, tmp_path):
    found = packing.pack(docs, VOCABULARY, largest=64).collect()
    want = []
    for (d, _), ids in zip(TEXTS, brute.word_ids([t for _, t in TEXTS]), strict=True):
        ids, at = [*ids, 1], 0
        for n in brute.pieces(len(ids), 64):
            want.append((d, at, n, np.array(ids[at:at + n], "<u4").tobytes()))
            at += n
    assert order((r.doc_id, r.start, r.length, bytes(r.ids)) for r in found) == order(want)
    assert len({r.sequence_id for r in found}) == len(found) and {r.offset for r in found} == {0}
    packing.write_buckets(packing.pack(docs, VOCABULARY, largest=64), str(tmp_path / "packed"))
    assert {r.length for r in spark.read.parquet(str(tmp_path / "packed")).where("bucket = 6").collect()} == {64}
    assert packing.pack(none, VOCABULARY).count() == 0


def test_token_files(spark, docs, none):
    path = scratch_path(spark, "tokens")
    token_files.write_tokens(docs, path, VOCABULARY, file_ids=2000)
    found = token_files.read_tokens(spark, path).orderBy("start").collect()
    ids = dict(enumerate(brute.word_ids([t for _, t in TEXTS])))
    ranked = sorted(range(len(TEXTS)), key=lambda i: (TEXTS[i][0] is not None, TEXTS[i][0] or 0, TEXTS[i][1] is not None, TEXTS[i][1] or ""))
    at = 0
    assert len(found) == len(TEXTS)
    for i, r in zip(ranked, found, strict=True):
        assert (r.doc_id, r.start, r.n_tokens) == (TEXTS[i][0], at, len(ids[i]) + 1)
        assert np.frombuffer(r.ids, "<u4").tolist() == [*ids[i], 1]
        at += r.n_tokens
    empty = scratch_path(spark, "tokens")
    token_files.write_tokens(none, empty, VOCABULARY)
    assert token_files.read_tokens(spark, empty).count() == 0


@pytest.mark.parametrize("high", [2, 50_000, 1 << 33, (1 << 64) - 1])
def test_simple8b(high):
    values = np.random.default_rng(high % 1000).integers(0, high, 5000, np.uint64, endpoint=True)
    values[100:400] = 0
    for n in (0, 1, 59, 60, 61, 1023, 1024, 1025, 5000):
        words, blocks, escaped = simple8b.pack(values[:n])
        assert (simple8b.unpack(words, escaped) == values[:n]).all() and len(blocks) == -(-n // simple8b.BLOCK)
    parts = [values[:1500], values[1500:1500], values[1500:]]
    f = token_files.TokenFile(token_files.file_bytes([1, 2, 3], [1500, 0, 3500], parts))
    for a, b in ((0, 5000), (0, 1), (1499, 1501), (1023, 2600), (4999, 5000), (7, 7)):
        assert (f.between(a, b) == values[a:b]).all()


def test_byte_bpe(docs, none):
    import tiktoken
    path, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    own = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=byte_bpe.read_ranks(path), special_tokens={})
    encoded = byte_bpe.encode(docs, path, pattern)
    want = [own.encode_ordinary(t or "") for _, t in TEXTS]
    assert order((r.doc_id, np.frombuffer(r.ids, "<u4").tolist()) for r in encoded.collect()) == order(
        (d, i) for (d, _), i in zip(TEXTS, want, strict=True))
    found = byte_bpe.decode(encoded, path, pattern).collect()
    assert order((r.doc_id, bytes(r.decoded)) for r in found) == order((d, (t or "").encode()) for d, t in TEXTS)
    assert byte_bpe.decode(byte_bpe.encode(none, path, pattern), path, pattern).count() == 0


def test_byte_bpe_white_space():
    import tiktoken
    path, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    bpe = byte_bpe.ByteBpe(path, pattern)
    own = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=bpe.ranks, special_tokens={})
    rng = np.random.default_rng(5)
    texts = ["".join(rng.choice(list("ab1é'st.  \n\t  \r"), 40)) for _ in range(400)]
    assert [np.frombuffer(x, "<u4").tolist() for x in bpe.encode(texts)] == [own.encode_ordinary(t) for t in texts]


def test_lm_scoring(docs, none):
    found = lm_scoring.score(docs).collect()
    want = order((d, *x[:4], round(x[4], 6)) for (d, _), x in zip(TEXTS, brute.scores(TEXTS), strict=True))
    assert order((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in found) == want
    assert all(r.score <= 0 for r in found) and lm_scoring.score(none).count() == 0


def test_rare_words_are_counted_elsewhere(docs, monkeypatch):
    whole = order((r.doc_id, r.n_known, round(r.base_score, 6)) for r in lm_scoring.score(docs).collect())
    monkeypatch.setattr(lm_scoring, "FREQUENT", 40)
    assert order((r.doc_id, r.n_known, round(r.base_score, 6)) for r in lm_scoring.score(docs).collect()) == whole


def katz(rows):
    """Score of every row by all bigrams of the training texts, counts cut to powers of sqrt(2)."""
    split = [((t or "").encode().lower().split()) + [b"\n"] for _, t in rows]
    trained = [s for s, (d, _) in zip(split, rows, strict=True) if not lm_scoring.held_out(d)]
    c, pairs = Counter(w for s in trained for w in s), Counter(p for s in trained for p in zip(s, s[1:], strict=False))
    size = sum(c.values()) + len(c) + 1
    cut = {p: 2 ** (math.floor(2 * math.log2(n) + 1e-9) / 2) for p, n in pairs.items()}
    held, base = Counter(), Counter()
    for (v, w), n in cut.items():
        held[v] += (n - 0.5) / c[v]
        base[v] += (c[w] + 1) / size
    out = []
    for s in split:
        p = [(c[s[0]] + 1) / size]
        for v, w in zip(s, s[1:], strict=False):
            b = max(1 - held[v], 1e-9) / max(1 - base[v], 1e-9)
            p.append((cut[v, w] - 0.5) / c[v] if (v, w) in cut else b * (c[w] + 1) / size)
        out.append(sum(map(math.log10, p)))
    return out


@pytest.mark.parametrize("frequent, shard", [(1 << 20, 1 << 18), (40, 1 << 12), (1, 50)])
def test_all_bigrams_are_in_the_filter(docs, monkeypatch, frequent, shard):
    monkeypatch.setattr(lm_scoring, "FREQUENT", frequent)
    monkeypatch.setattr(lm_scoring, "SHARD", shard, raising=False)
    found = order((r.doc_id, r.n_tokens, round(r.score, 4)) for r in lm_scoring.score(docs).collect())
    want = order((d, len((t or "").encode().split()) + 1, round(x, 4)) for (d, t), x in zip(TEXTS, katz(TEXTS), strict=True))
    assert [x[:2] for x in found] == [x[:2] for x in want]
    assert [x[2] for x in found] == pytest.approx([x[2] for x in want], abs=1e-3)


def test_filter_gives_levels_back():
    rng = np.random.default_rng(1)
    keys = rng.integers(0, 1 << 63, 3000).astype(np.uint64)
    levels = rng.integers(1, 30, 3000)
    f = lm_scoring.LogFrequencyFilter(keys, levels)
    assert (f.levels(keys) == levels).mean() > 0.999 and (f.levels(keys) >= levels).all()
    assert (f.levels(rng.integers(0, 1 << 63, 100_000).astype(np.uint64)) > 0).mean() < 1e-3


def test_backoff_sums_to_one():
    """Over all words after a frequent one the probabilities of the model sum to one."""
    counts = np.array([40, 30, 20, 10])
    m = lm_scoring.Model(np.arange(4, dtype=np.uint64), counts, 100, 4, 1)
    m.add_bigrams(np.array([0 << 32 | 1, 0 << 32 | 2, 1 << 32 | 0]), np.array([17, 5, 30]))
    uni = 10 ** m.unigram()
    rest = 1 - uni.sum()  # what add-one leaves to words that were never seen
    for v in (0, 1):
        pairs = np.array([v << 32 | w for w in range(4)])
        level = m.bigrams.levels(lm_scoring._mix(pairs.astype(np.uint64)))
        p = np.where(level > 0, (m.count_at(level) - 0.5) / counts[v], 10 ** m.backoff[v] * uni)
        assert p.sum() + 10 ** m.backoff[v] * rest == pytest.approx(1)


def test_chat_edges(spark):
    rows = [(1, 1, "assistant", "second"), (1, 0, "user", None), (1, 1, "assistant", "second"), (2, 0, None, "<|im_end|>"), (2, 1, "assistant", ""),
            (None, 0, "assistant", "no id"), (3, 0, "a<|im_sep|>", "<\\|im_end|> <\\\\| <|endoftext|> \n\n"), (3, 1, "assistant", "\n<"),
            (3, 2, "assistant", "\\|im_end|>é😀"), (4, None, "assistant", "x" * 50_000)]
    frame = spark.createDataFrame([(*r, "t") for r in rows], "conv_id long, turn long, role string, text string, turns string")
    path = public_tokenizers.path("byte_bpe_50k.json")
    found = {r.conv_id: r for r in chat_format.read_back(chat_format.format_conversations(frame, path), path).collect()}
    assert set(found) == {1, 2, 3, 4, None}
    for conv, r in found.items():
        said = sorted(((t is not None, t or 0, a or "", b or "") for c, t, a, b in rows if c == conv))
        learned = "".join(b for *_, a, b in said if a == "assistant")
        assert r.turns_sha256 == brute.sha("".join(f"{a}\n{b}\n" for *_, a, b in said)) and r.n_turns == len(said)
        assert (r.loss_chars, r.loss_sha256) == (len(learned), brute.sha(learned))
    empty = spark.createDataFrame([], frame.schema)
    assert chat_format.read_back(chat_format.format_conversations(empty, path), path).count() == 0


def test_escape_is_reversible():
    rng = np.random.default_rng(3)
    for _ in range(500):
        text = "".join(rng.choice(["<", "|", "\\", "<|", "im_end", "|>"], 12))
        assert chat_format.unescape(chat_format.escape(text)) == text and "<|" not in chat_format.escape(text)


def test_license_scan(spark, docs, none):
    found = license_scan.scan(docs).collect()
    assert [(r.doc_id, r.template) for r in found] == [(13, "MIT notice")]
    mit = license_scan.TEMPLATES["MIT"]
    wrapped = "\n".join(mit[i:i + 70] for i in range(0, len(mit), 70))
    whole = [(1, f"some prose\n\n{wrapped}\n\nmore prose"), (2, mit.upper()), (3, mit[:200]), (4, "word " * 9_000), (4, mit), (4, mit)]
    frame = spark.createDataFrame(whole, "doc_id long, text string")
    assert sorted((r.doc_id, r.template) for r in license_scan.scan(frame).collect()) == [(1, "MIT"), (2, "MIT"), (4, "MIT"), (4, "MIT")]
    assert license_scan.scan(none).count() == 0


def test_native_operators_stay_in_the_jvm(docs):
    for found in (license_scan.scan(docs), exact_dedup.report(docs), exact_dedup.copies(docs), exact_dedup.kept(docs), quality_rules.judge(docs)):
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert not any(word in plan for word in ("Python", "Arrow", "Pandas", "CartesianProduct", "NestedLoop"))


def test_strange_words_never_hide_a_match(spark):
    """Matches of parts that are changed as far as they may be."""
    template = " ".join(f"t{i}" for i in range(40))
    rows = [(k, " ".join(w if i >= k else f"new{i}" for i, w in enumerate(template.split()))) for k in range(20)]
    rows += [(100 + k, template + " " + " ".join(f"more{i}" for i in range(k))) for k in range(25)]
    found = {r.doc_id for r in license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string"), {"T": template}).collect()}

    def dice(text):
        a, b = (license_scan.template_bigrams(t) for t in (text, template))
        return 200 * len(a & b) >= 80 * (len(a) + len(b))
    assert found == {i for i, t in rows if dice(t)} and 5 < len(found) < len(rows)


def test_sizes_admit_every_match():
    for n in (1, 4, 37, 150):
        want = [a for a in range(1, 4 * n + 5) if 100 * 2 * min(a, n) >= 80 * (a + n)]
        assert [a for a in license_scan.sizes(n) if a > 0] == want


def test_jaccard_join(docs, none):
    labels, links = brute.links([t for _, t in TEXTS])
    named = {}
    for (d, _), x in zip(TEXTS, labels, strict=True):
        named[x] = min((i for i in (named.get(x), d) if i is not None), default=None)
    found = jaccard_join.join(docs).collect()
    assert order((r.doc_id, r.class_id, r.n_links) for r in found) == order(
        (d, named[x], n) for (d, _), x, n in zip(TEXTS, labels, links, strict=True))
    kept = jaccard_join.kept(docs)
    assert kept.columns == docs.columns
    stay = [r.doc_id for r in kept.collect() if r.doc_id is not None]
    assert set(stay) == {x for x in named.values() if x is not None} and len(stay) == sum(x is not None for x in named.values())
    assert jaccard_join.join(none).count() == jaccard_join.kept(none).count() == 0


def test_texts_that_share_an_id_are_not_lost(spark):
    """Unrelated texts under one id stay; a near copy under an id that stays goes."""
    a, b, c = (" ".join(f"{x}{i % 41} of {i}" for i in range(80)) for x in ("red", "green", "blue"))
    rows = [(1, a), (1, b), (2, c), (1, a + " more"), (3, b + " end"), (1, a)]
    kept = jaccard_join.kept(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(r.doc_id for r in kept) == [1, 1, 2] and {r.text[:3] for r in kept} == {"red", "gre", "blu"}


def test_large_group_of_near_copies_in_blocks(spark, monkeypatch):
    """A group of many different texts: links counted whole across blocks."""
    rng = np.random.default_rng(2)
    base = [f"w{i}" for i in range(120)]
    texts = []
    for k in range(150):
        words = list(base)
        for at in rng.integers(0, 120, k % 4):
            words[at] = f"edit{k}_{at}"
        texts.append(" ".join(words))
    labels, links = brute.links(texts)
    blocks = _small_blocks(spark, monkeypatch, texts)
    first = {x: labels.index(x) for x in labels}
    assert blocks == [(i, first[x], n) for i, (x, n) in enumerate(zip(labels, links, strict=True))]


def _small_blocks(spark, monkeypatch, texts):
    monkeypatch.setattr(jaccard_join, "BLOCK", 16)
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return sorted((r.doc_id, r.class_id, r.n_links) for r in jaccard_join.join(frame).collect())


def test_pruning_keeps_what_may_be_similar():
    least = jaccard_join.least_matches()
    assert all(a <= b for a, b in zip(least, least[1:], strict=False)) and least[-1] > 75
    rng = np.random.default_rng(0)
    same = rng.random((20_000, jaccard_join.HASHES)) < 0.8
    signatures = np.concatenate([np.zeros_like(same), ~same]).astype(np.uint16)
    i, _ = jaccard_join.pruned(signatures, np.arange(20_000), np.arange(20_000, 40_000))
    assert len(i) >= 19_995
    far = np.concatenate([np.zeros_like(same), rng.random(same.shape) > 0.4]).astype(np.uint16)
    assert len(jaccard_join.pruned(far, np.arange(20_000), np.arange(20_000, 40_000))[0]) == 0


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(1, 80)] + [(5000, 5001), (7, 7)]
    found = components.components(spark.createDataFrame(edges, "a long, b long")).collect()
    by = {}
    for r in found:
        by.setdefault(r.label, set()).add(r.v)
    assert sorted(map(sorted, by.values())) == [list(range(61)), list(range(1000, 1080)), [5000, 5001]]
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0
