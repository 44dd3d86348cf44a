"""Every pair that shares a kept hash is compared, however many hold it."""

from itertools import combinations

import numpy as np

from seqtide.functions.kmers import from_varint, varint
from seqtide.operators import containment, set_blocks


def brute(sets, least):
    """longer, shorter -> common members, of (name, length, members)."""
    order = sorted(sets, key=lambda s: (-s[1], s[0]))
    return {(a[0], b[0]): len(a[2] & b[2]) for a, b in combinations(order, 2)
            if a[2] & b[2] and len(a[2] & b[2]) / min(len(a[2]), len(b[2])) >= least}


def test_holders_beyond_the_next_two_are_pairs(spark, monkeypatch):
    """Forty changed copies of one text: each is in a pair with each, far more than the longest and the next two by length."""
    rng = np.random.default_rng(8)
    letters = np.array(list("ACGT"))
    whole, rows = rng.choice(letters, 3000), []
    for i in range(40):
        copy = whole.copy()
        copy[rng.random(3000) < 0.01] = "A"
        rows.append((f"C{i:02}", "".join(copy[:2000 + 20 * (i % 7)])))
    rows += [(f"R{i:02}", "".join(rng.choice(letters, 40 + 30 * i))) for i in range(30)] + [("empty", ""), ("short", "ACGT"), ("none", None)]
    records = spark.createDataFrame(rows, "accession string, sequence string")
    sets = [(r.accession, len(dict(rows)[r.accession]), set(r.hashes)) for r in containment.scaled_sets(records).collect()]
    want = brute(sets, containment.MIN_CONTAINMENT)
    assert sum(a[0] == b[0] == "C" for a, b in want) == 40 * 39 // 2
    got = containment.similar_pairs(records).collect()
    assert len(got) == len(want) and {(r.longer, r.shorter): r.shared for r in got} == want
    size = {name: len(members) for name, _, members in sets}
    for r in got:
        assert r.containment == r.shared / min(size[r.longer], size[r.shorter])
        assert r.jaccard == r.shared / (size[r.longer] + size[r.shorter] - r.shared)
    monkeypatch.setattr(containment, "SIDE_BYTES", 4096)  # many blocks
    again = containment.similar_pairs(records).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, got))
    named = spark.createDataFrame([(f"C{i:02}",) for i in range(0, 40, 2)], "accession string")
    some = containment.similar_pairs(records, among=named).collect()
    assert {(r.longer, r.shorter): r.shared for r in some} == {k: v for k, v in want.items() if not any(int(x[1:]) % 2 or x[0] == "R" for x in k)}


def test_members_are_counted_as_by_brute_force(monkeypatch):
    """Sets of all sizes with frequent and rare members, in runs of any size."""
    rng = np.random.default_rng(3)
    for share in (0.0, 0.1, 0.4, 1.0):
        sets = [np.unique(rng.zipf(1.3, rng.integers(1, 120)) % 4000) for _ in range(150)]
        sets += [x[:max(1, len(x) // 2)] for x in sets[:40]]
        blocks = []
        for a, z in ((0, 70), (70, 190)):
            number = np.array(sorted(range(a, z), key=lambda i: (len(sets[i]), i)))
            block = set_blocks.block_of(number, set_blocks.pa.array(number.astype(str)), np.zeros(z - a, bool),
                                        np.array([len(sets[i]) for i in number]), np.concatenate([sets[i] for i in number]).astype(np.int64))
            blocks.append(set_blocks.Block.unpack(block.pack()))
        for most in (set_blocks.LOOKED_UP, 50):
            monkeypatch.setattr(set_blocks, "LOOKED_UP", most)
            got = {}
            for one, other in ((blocks[0], blocks[0]), (blocks[1], blocks[1]), (blocks[0], blocks[1]), (blocks[1], blocks[0])):
                for i, j, shared in set_blocks.found(one, other, set_blocks.common(one, other), share, None):
                    for a, b, n in zip(one.number[i].tolist(), other.number[j].tolist(), shared.tolist(), strict=True):
                        assert (min(a, b), max(a, b)) not in got and len(sets[a]) <= len(sets[b])
                        got[min(a, b), max(a, b)] = n
            common = {(a, b): len(np.intersect1d(sets[a], sets[b])) for a, b in combinations(range(len(sets)), 2)}
            assert got == {p: n for p, n in common.items() if n and n / min(len(sets[p[0]]), len(sets[p[1]])) >= share}


def test_numbers_come_back_from_their_bytes():
    numbers = np.concatenate([[0, 127, 128, 16383, 16384], 2 ** np.arange(62), np.arange(500)]).astype(np.int64)
    data, ends = varint(numbers)
    assert (from_varint(data) == numbers).all() and ends[-1] == len(data)
    assert len(from_varint(varint(np.zeros(0, np.int64))[0])) == 0


def test_rows_of_one_accession_meet_in_either_order(spark):
    """Two texts of one accession, the one longer and the other shorter than a third text: pairs both ways, each row with each."""
    rng = np.random.default_rng(6)
    whole = "".join(rng.choice(list("ACGT"), 4000))
    rows = [("A", whole), ("A", whole[1000:2500]), ("B", whole[500:2500]), ("C", "".join(rng.choice(list("ACGT"), 2000))), ("D", whole[900:2400])]
    records = spark.createDataFrame(rows, "accession string, sequence string")
    found = sorted(tuple(r)[:2] for r in containment.similar_pairs(records).collect())
    assert found == [("A", "A")] * 4 + [("A", "B")] * 2 + [("A", "D")] * 2 + [("B", "A")] * 2 + [("B", "D")]
    assert found == sorted(tuple(r)[:2] for r in containment.similar_pairs(records, near=5).collect())
    twice = spark.createDataFrame(rows[:1] * 2 + rows[3:4], "accession string, sequence string")
    assert containment.similar_pairs(twice).count() == 0


def test_blocks_meet_without_a_shuffle(spark):
    """A set is stored in one block, some bytes a member; the pairs come from that table alone."""
    rng = np.random.default_rng(2)
    rows = [(f"S{i:02}", "".join(rng.choice(list("ACGT"), 3000))) for i in range(60)]
    found = containment.similar_pairs(spark.createDataFrame(rows, "accession string, sequence string"))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "Exchange rangepartitioning" not in plan
    sets = containment.scaled_sets(spark.createDataFrame(rows, "accession string, sequence string")).collect()
    number, size = np.arange(len(sets)), np.array([len(r.hashes) for r in sets])
    order = np.lexsort((number, size))
    codes = np.concatenate([np.sort(np.array(sets[i].hashes) % (1 << 26)) for i in order])
    block = set_blocks.block_of(number[order], set_blocks.pa.array([sets[i].accession for i in order]), np.zeros(len(order), bool), size[order], codes)
    assert len(block.pack()) < 8 * len(codes)


def test_near_holders_are_found_in_blocks_as_in_buckets(spark, monkeypatch):
    """The capped pairs, which containment_recall asks for: of one block, of many, and by the buckets are the same."""
    rng = np.random.default_rng(9)
    letters = np.array(list("ACGT"))
    whole, rows = rng.choice(letters, 4000), []
    for i in range(60):
        copy = whole.copy()
        copy[rng.random(4000) < 0.004 * (i % 5)] = "A"
        a = int(rng.integers(0, 2000))
        rows.append((f"C{i:02}", "".join(copy[a:a + int(rng.integers(60, 2000))])))
    records = spark.createDataFrame(rows, "accession string, sequence string")
    for near in (1, 2, 3):
        want = sorted(map(tuple, containment._near_pairs(records, containment.K, containment.SCALE, containment.MIN_CONTAINMENT, near).collect()))
        assert sorted(map(tuple, containment.similar_pairs(records, near=near).collect())) == want
        monkeypatch.setattr(containment, "SIDE_BYTES", 32 * 300)
        assert sorted(map(tuple, containment.similar_pairs(records, near=near).collect())) == want
        monkeypatch.undo()
    assert len(want) < containment.similar_pairs(records).count()
