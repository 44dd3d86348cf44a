"""Merkle manifest against a plain restatement, over many runs, hot and tiny sources, nulls and repeats."""

import os
import sys
import zlib

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
import brute  # noqa: E402

from seqtide.llm import merkle  # noqa: E402

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, leaf string, run int, idx int, name string, tree int"


def leaf(row):
    return brute.sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([brute.sha("".join(out[-1][i:i + 3])) for i in range(0, len(out[-1]), 3)])
    return out


def siblings(tree, at):
    for nodes in tree[:-1]:
        low = at - at % 3
        yield "".join(nodes[low:at]), "".join(nodes[at + 1:low + 3])
        at //= 3


def manifest(rows):
    """(doc_id, leaf, subroot, root, digest of the proof, folded root) per row."""
    by_source = {}
    for r in rows:
        by_source.setdefault(r[1], []).append((r[0] is not None, r[0] or 0, leaf(r), r))
    names = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = [levels([x[2] for x in sorted(by_source[s], key=lambda x: x[:3])]) for s in names]
    top = levels([t[-1][0] for t in trees])
    for number, (s, tree) in enumerate(zip(names, trees, strict=True)):
        for at, (_, _, h, r) in enumerate(sorted(by_source[s], key=lambda x: x[:3])):
            text = r[4]
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 and text is not None:
                text = text.replace("\n", "")
            proof, folded = "", leaf((*r[:4], text))
            for left, right in [*siblings(tree, at), *siblings(top, number)]:
                proof += left + right
                folded = brute.sha(left + folded + right)
            yield r[0], h, tree[-1][0], top[-1][0], brute.sha(proof), folded


def table(n):
    rows = [(i * 7 % 1009, "hot", "en", i, f"text {i}\nline" if i % 3 else f"one line {i}") for i in range(n)]
    rows += [(i, f"s{i}", None, None, f"a\nb{i}") for i in range(40)]
    rows += [(None, "hot", None, 3, "a\n"), (None, None, "de", None, None), (5, None, "de", 0, ""), (5, None, "de", 0, ""),
             (-8, "", "fr", 1, "é\n日本\n"), (5, "hot", "en", 5, "other text of document 5"), (6, "é", "x:y", 2, "\n" * 50), (7, "Z", "", 4, "a" * 30_000)]
    return rows + [(9, "twice", "en", 1, "same\n")] * 11


@pytest.mark.parametrize("run,span,n", [(4, 2, 150), (4096, 128, 60)])
def test_manifest(spark, monkeypatch, run, span, n):
    monkeypatch.setattr(merkle, "RUN", run)
    monkeypatch.setattr(merkle, "SPAN", span)
    rows = table(n)
    docs = spark.createDataFrame([(*r, "f", 1, 2, "n", 3) for r in rows], SCHEMA).repartition(5)
    found = merkle.prove(docs, presented=merkle.tampered(docs)).collect()
    got = sorted((r.doc_id is not None, r.doc_id or 0, r.leaf, r.subroot, r.root, brute.sha(r.proof), r.folded_root) for r in found)
    want = sorted((d is not None, d or 0, *x) for d, *x in manifest(rows))
    assert got == want and all(r.verified == (r.folded_root == r.root) for r in found)
    assert 0 < sum(not r.verified for r in found) < len(rows)
    assert all(r.verified for r in merkle.prove(docs).collect())


@pytest.mark.parametrize("n", [1, 4, 10])
def test_small_tables(spark, monkeypatch, n):
    monkeypatch.setattr(merkle, "RUN", 3)
    monkeypatch.setattr(merkle, "SPAN", 2)
    rows = [(i, "s", "en", i, f"t{i}\n") for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    found = merkle.prove(docs).collect()
    assert sorted((r.doc_id, r.leaf, r.subroot, r.root, brute.sha(r.proof)) for r in found) == sorted(x[:5] for x in manifest(rows))


def test_no_rows(spark):
    docs = spark.createDataFrame([], SCHEMA)
    found = merkle.prove(docs)
    assert found.count() == 0 and found.columns[-1] == "verified"


def test_missing_nodes_are_the_smallest_set():
    """What is asked for is what no leaf of the run leads to, and never more than four nodes a level."""
    for total, lo, hi in [(1, 0, 1), (10, 9, 10), (28, 3, 20), (1000, 0, 1000), (100_000, 4_096, 8_192)]:
        asked = merkle.missing(total, lo, hi)
        assert len(set(asked)) == len(asked) <= 4 * 12
        for level, k in asked:
            assert not set(range(k * 3 ** level, (k + 1) * 3 ** level)) & set(range(lo, hi))
    assert merkle.missing(1000, 0, 1000) == []
