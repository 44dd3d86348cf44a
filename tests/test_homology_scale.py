"""Pairs are ruled out by the ends of their overlaps; sequences of the views are made of whole batches."""

import random

import numpy as np
from pyspark.sql import functions as F

from seqtide.functions import kmers
from seqtide.operators import homology
from seqtide.plans import views


def _changed(s, at):
    return "".join({"A": "C", "C": "G", "G": "T", "T": "A"}[c] if i in at else c for i, c in enumerate(s))


def test_unrelated_pairs_are_ruled_out_before_whole_sequences_meet(spark):
    rng = random.Random(5)
    a = "".join(rng.choices("ACGT", k=1000))
    near, far = _changed(a, set(range(0, 1000, 25))), a[:100] + "".join(rng.choices("ACGT", k=900))
    edge = _changed(a, set(range(950, 1000)))  # 95 % and no less, all of it at the end
    shifted = a[37:]
    text = spark.createDataFrame([("a", a), ("near", near), ("far", far), ("edge", edge), ("shifted", shifted), ("two", far), ("two", a)],
                                 "accession string, sequence string")
    rows = [("a", "near", 0, 1000, 1000), ("a", "far", 0, 1000, 1000), ("a", "edge", 0, 1000, 1000), ("a", "shifted", 37, 1000, 963),
            ("a", "shifted", 0, 1000, 963), ("a", "two", 0, 1000, 1000)]
    pairs = spark.createDataFrame(rows, "centre string, member string, diagonal int, centre_length int, member_length int")
    close = pairs.withColumn("overlap", homology.overlap())
    weights = close.groupBy("centre").agg(F.count("*").alias("n"))
    left = {(r.member, r.diagonal) for r in homology.probed(close, text, weights, 0.95).collect()}
    assert left == {("near", 0), ("edge", 0), ("shifted", 37), ("two", 0)}
    found = {r.member: r.identity for r in homology.aligned_pairs(pairs, text, 0.95, 0.8).collect()}
    assert found == {"near": 0.96, "edge": 0.95, "shifted": 1.0, "two": 1.0}


def test_sequences_and_changed_copies_are_made_of_batches(spark, tmp_path):
    text = {0: "Straße, ÀÉÿ÷ø 12\nabc" * 40, 1: "", 2: None, 5: "xyzK\U0001f600 Ω ñandú " * 30, 6: "0123", 11: "The quick brown fox " * 50}
    docs = spark.createDataFrame([(i, "s", "en", t) for i, t in text.items()], "doc_id long, source string, lang string, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    plan = views.strains(spark, str(tmp_path))
    assert "split(" not in plan._jdf.queryExecution().toString() and "regexp_replace" not in plan._jdf.queryExecution().toString()
    letters = "abcdefghijklmnopqrstuvwxyzßàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿ"
    want = {}
    for i, t in text.items():
        s = None if t is None else "".join("ACGT"[letters.index(c) % 4] for c in t.lower() if c in letters)
        want[f"DOC{i:08d}.1"] = s
        if i % 5 < 2 and s:
            want[f"DOC{i:08d}.1M"] = _changed(s, {j for j in range(len(s)) if (j % 33 == 0 if i % 5 == 0 else j % 100 >= 60 and j % 5 == 0)})
    assert {r.accession: r.sequence for r in plan.collect()} == want


def test_hashes_need_no_division():
    codes = np.concatenate([np.random.default_rng(1).integers(0, 1 << 60, 1000), [0, kmers.PRIME - 1, kmers.PRIME, (1 << 62) - 1]])
    assert kmers.kmer_hash(codes).tolist() == [(int(c) * kmers.FACTOR + kmers.SHIFT) % kmers.PRIME for c in codes]
    x = np.array([kmers.PRIME, kmers.PRIME + 1, (1 << 64) - 1], np.uint64)
    assert kmers._modulo(x).tolist() == [int(v) % kmers.PRIME for v in x]
