"""Sets of candidates are intersected where each of them arrives once."""

import numpy as np
from pyspark.sql import functions as F

from seqtide.operators import containment


def test_sets_travel_by_group_and_not_by_pair(spark, monkeypatch):
    """A long sequence that is in a pair with all others: its set is not in the plan of the pairs, and grids of any size agree."""
    rng = np.random.default_rng(4)
    whole = "".join(rng.choice(list("ACGT"), 9000))
    rows = [("W", whole)] + [(f"P{i}", whole[i * 150:i * 150 + 1500]) for i in range(50)] + [
        (f"R{i}", "".join(rng.choice(list("ACGT"), 700))) for i in range(20)]
    records = spark.createDataFrame(rows, "accession string, sequence string")
    found = sorted(map(tuple, containment.similar_pairs(records).collect()))
    sets = {r.accession: set(r.hashes) for r in containment.scaled_sets(records).collect()}
    assert {(a, b) for a, b, *_ in found if a == "W"} == {("W", f"P{i}") for i in range(50) if f"P{i}" in sets}
    for a, b, shared, jaccard, share in found:
        assert shared == len(sets[a] & sets[b]) and jaccard == shared / len(sets[a] | sets[b])
        assert share == shared / min(len(sets[a]), len(sets[b])) >= containment.MIN_CONTAINMENT
    monkeypatch.setattr(containment, "SIDE_BYTES", 4096)
    monkeypatch.setattr(containment, "LOOKED_UP", 100)
    assert sorted(map(tuple, containment.similar_pairs(records).collect())) == found


def test_a_pair_costs_two_numbers(spark):
    sets = spark.createDataFrame([(i, [1, 2, 3 + i]) for i in range(6)], "number long, hashes array<long>")
    pairs = containment.bucket_pairs(sets)
    assert dict(pairs.dtypes) == {"longer": "bigint", "shorter": "bigint"}
    got = containment.counted_pairs(pairs, sets).select("longer", "shorter", "shared")
    assert sorted(map(tuple, got.collect())) == sorted((i, j, 2) for i in range(6) for j in range(i + 1, 6) if i == 0 or j - i <= 2)
    assert got.agg(F.count("*")).first()[0] == pairs.count()


def test_rows_that_share_an_accession_are_in_its_pairs_each(spark):
    rng = np.random.default_rng(6)
    whole = "".join(rng.choice(list("ACGT"), 3000))
    rows = [("A", whole), ("A", whole), ("B", whole[500:2500])]
    found = [tuple(r)[:2] for r in containment.similar_pairs(spark.createDataFrame(rows, "accession string, sequence string")).collect()]
    assert sorted(found) == [("A", "A")] * 4 + [("A", "B")] * 2
