"""All pairs of sets of which the smaller one lies in the other to a given share, exactly.

The sets are packed into blocks of bounded size, each an inverted index, which are stored once; every two blocks meet in
a task that reads both from that table, so no set is shuffled per pair and nothing but the result grows with the pairs.

Of a set of n members that shares at least t with another one, any n - t + l members share at least l. The l need not be
the same for all sets: a few members that most sets lack decide which partners are counted in full.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqtide.functions.kmers import from_varint, give_back, varint
from seqtide.session import scratch_path

#: Holders that are looked up at a time, and pairs that are sent on together.
LOOKED_UP, SENT = 1 << 20, 1 << 16
#: Files of blocks, about: while there are fewer blocks each is a file, so that a task holds few of them.
FILES = 64
#: One in so many members has to be shared already among those that are looked up first.
FIRST = 10


def spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of every run, one run after another."""
    ends = np.cumsum(sizes)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


def bounded(work: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of neighbours with about ``most`` work, one row at least."""
    done = np.cumsum(work)
    a = 0
    while a < len(work):
        z = max(a + 1, int(np.searchsorted(done, (done[a - 1] if a else 0) + most, "right")))
        yield a, z
        a = z


@dataclass
class Block:
    """Sets in order of (size, number); ``rows`` has the places of the holders of each code, ascending."""

    number: np.ndarray
    name: pa.Array
    several: np.ndarray
    size: np.ndarray
    code: np.ndarray
    held: np.ndarray
    rows: np.ndarray

    def __post_init__(self) -> None:
        self.starts = np.cumsum(self.held) - self.held

    def members(self, bits: int) -> np.ndarray:
        """(place of the code, row) of every member as one ascending number."""
        out = np.repeat(np.arange(len(self.code)) << bits, self.held)
        out |= self.rows
        return out

    def pack(self) -> bytes:
        """As one row of lists under zstd."""
        rows = self.rows.astype(np.uint16 if len(self.number) <= 1 << 16 else np.uint32)
        columns = {"number": self.number, "name": self.name, "several": self.several, "size": self.size,
                   "code": varint(np.diff(self.code, prepend=0))[0], "held": varint(self.held)[0], "rows": rows}
        lists = {k: pa.LargeListArray.from_arrays(pa.array([0, len(v)], pa.int64()), pa.array(v)) for k, v in columns.items()}
        sink = pa.BufferOutputStream()
        batch = pa.RecordBatch.from_pydict(lists)
        with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
            writer.write_batch(batch)
        return sink.getvalue().to_pybytes()

    @staticmethod
    def unpack(data: bytes) -> Block:
        batch = pa.ipc.open_stream(data).read_next_batch()
        x = {k: batch.column(k).flatten() for k in batch.schema.names}
        n = {k: x[k].to_numpy(zero_copy_only=False) for k in x if k != "name"}
        return Block(n["number"], x["name"], n["several"], n["size"], np.cumsum(from_varint(n["code"])), from_varint(n["held"]),
                     n["rows"].astype(np.int32))


def block_of(number: np.ndarray, name: pa.Array, several: np.ndarray, size: np.ndarray, codes: np.ndarray) -> Block:
    """The block of sets in order of (size, number) whose ``codes`` lie one after another."""
    by = np.argsort(codes, kind="stable")
    rows = np.repeat(np.arange(len(size), dtype=np.int32), size)[by]
    codes = codes[by]
    del by
    first = np.flatnonzero(np.diff(codes, prepend=-1))
    return Block(number, name, several, size, codes[first], np.diff(first, append=len(codes)), rows)


def unpacked(data: pa.ChunkedArray, size: np.ndarray) -> np.ndarray:
    """The members of all sets, whose steps ``data`` has, one set after another."""
    out, done = np.empty(int(size.sum()), np.int64), np.cumsum(size)
    for a, z in bounded(size, LOOKED_UP >> 2):
        steps = from_varint(np.frombuffer(b"".join(data[a:z].to_pylist()), np.uint8))
        sums, begin = np.cumsum(steps), np.cumsum(size[a:z]) - size[a:z]
        out[done[z - 1] - len(sums):done[z - 1]] = sums - np.repeat(sums[begin] - steps[begin], size[a:z])
    return out


def needed(size: np.ndarray, share: float) -> np.ndarray:
    """The least number of common members, one at least, whose share of ``size`` is at least ``share``."""
    t = np.maximum(np.ceil(size * share).astype(np.int64), 1)
    t -= (t > 1) & ((t - 1) / size >= share)
    return t + (t / size < share)


def later(one: Block, other: Block) -> np.ndarray:
    """For each set of ``one``, how many of ``other`` are not after it in order of (size, number)."""
    n = len(one.number)
    order = np.lexsort((np.concatenate([one.number, other.number]), np.concatenate([one.size, other.size])))
    mine = order < n
    out = np.empty(n, np.int64)
    out[order[mine]] = np.cumsum(~mine)[mine]
    return out


def common(one: Block, other: Block) -> tuple[np.ndarray, np.ndarray]:
    """Places in ``one`` and in ``other`` of the codes that both have."""
    if one is other:
        return (at := np.arange(len(one.code))), at
    both = np.concatenate([one.code, other.code])
    order = np.argsort(both, kind="stable")  # two runs that are merged
    both = both[order]
    twice = np.flatnonzero(both[1:] == both[:-1])
    return order[twice], order[twice + 1] - len(one.code)


def found(one: Block, other: Block, at: tuple[np.ndarray, np.ndarray], share: float, several: bool | None
          ) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Places in ``one``, places in ``other``, common members of the pairs whose set in ``one`` is the earlier one by (size, number).

    ``at``: places of the codes that both have.
    """
    own, at = at
    by = np.argsort(other.held[at], kind="stable")  # codes with few holders first
    label = np.empty(len(by), np.int32)
    label[by] = np.arange(len(by))
    at = at[by]
    holders = other.held[at]
    need, after = needed(one.size, share), np.arange(1, len(one.number) + 1) if one is other else later(one, other)
    known = np.zeros(len(one.code), bool)
    known[own] = True
    row = one.rows[np.repeat(known, one.held)]
    met = np.bincount(row, minlength=len(one.number))
    wanted = (met >= need) & (after < len(other.number))
    some = wanted[row]
    bits = len(at).bit_length()
    key = row[some].astype(np.int64)
    del row
    key <<= bits
    key |= np.repeat(label, one.held[own])[some]
    key.sort()
    token = np.bitwise_and(key, (1 << bits) - 1, out=key).astype(np.int32)
    del key, some, known, label
    met = np.where(wanted, met, 0)
    least = np.minimum(need, np.maximum(1, one.size // FIRST))
    starts, first = np.cumsum(met) - met, np.where(wanted, met - need + least, 0)
    places = np.flatnonzero(wanted)
    heads = token[spread(starts[places], first[places])]
    begins = np.concatenate([[0], np.cumsum(first[places])])
    work = np.diff(np.concatenate([[0], np.cumsum(holders[heads])])[begins])
    members, bits = None, len(other.number).bit_length()
    for a, z in bounded(work, LOOKED_UP):
        head = heads[begins[a]:begins[z]]
        partner = other.rows[spread(other.starts[at[head]], holders[head])]
        some = partner >= np.repeat(after[places[a:z]].astype(np.int32), work[a:z])
        i = np.repeat(places[a:z], work[a:z])
        if several is not None:
            some &= (one.several[i] | other.several[partner]) == several
        key = (i[some] << bits) | partner[some]
        del i, partner, some
        key.sort()
        new = np.flatnonzero(np.diff(key, prepend=-1))
        seen, key = np.diff(new, append=len(key)), key[new]
        i = key >> bits
        some = seen >= least[i]
        i, j, seen = i[some], key[some] & ((1 << bits) - 1), seen[some]
        rest = need[i] - least[i]  # members that have not been looked up
        if members is None and rest.any():
            members = other.members(bits)
        for b, y in bounded(rest, LOOKED_UP):
            n = rest[b:y]
            sought = (at[token[spread(starts[i[b:y]] + first[i[b:y]], n)]] << bits) | np.repeat(j[b:y], n)
            if len(sought):
                hit = np.searchsorted(members, sought)
                hit[hit == len(members)] = 0
                sums = np.concatenate([[0], np.cumsum(members[hit] == sought)])
                seen[b:y] += sums[np.cumsum(n)] - sums[np.cumsum(n) - n]
        some = seen >= need[i]
        yield i[some], j[some], seen[some]


NAMED = "longer string, shorter string, shared int, jaccard double, containment double"
NUMBERED = "longer long, shorter long"


def _named(x: Block, y: Block, i: np.ndarray, j: np.ndarray, shared: np.ndarray) -> Iterator[pa.RecordBatch]:
    names, n = pa.concat_arrays([x.name, y.name]), len(x.name)
    for a in range(0, len(i), SENT):
        p, q, s = i[a:a + SENT], j[a:a + SENT], shared[a:a + SENT]
        swap = x.number[p] > y.number[q]
        yield pa.RecordBatch.from_pydict({
            "longer": names.take(pa.array(np.where(swap, q + n, p))), "shorter": names.take(pa.array(np.where(swap, p, q + n))),
            "shared": s.astype(np.int32), "jaccard": s / (x.size[p] + y.size[q] - s), "containment": s / np.minimum(x.size[p], y.size[q])})


def _pairs(one: Block, other: Block, share: float, several: bool | None, named: bool) -> Iterator[pa.RecordBatch]:
    own, at = common(one, other)
    for x, y, both in ((one, other, (own, at)), (other, one, (at, own)))[:1 if one is other else 2]:
        for i, j, shared in found(x, y, both, share, several):
            if named:
                yield from _named(x, y, i, j, shared)
            else:
                yield pa.RecordBatch.from_pydict({"longer": np.minimum(x.number[i], y.number[j]), "shorter": np.maximum(x.number[i], y.number[j])})


def compared(share: float, several: bool | None, named: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For ``mapInArrow``: packed pairs of blocks -> their pairs of sets."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, one = None, None
        for batch in batches:
            for k in range(len(batch)):
                if known != batch["i"][k].as_py():
                    known, one = batch["i"][k].as_py(), Block.unpack(batch["one"][k].as_buffer())
                same = known == batch["j"][k].as_py()
                yield from _pairs(one, one if same else Block.unpack(batch["other"][k].as_buffer()), share, several, named)
                give_back()
    return run


def packed(most: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """For a cogroup: sets (id, n, codes) and kept ones (id, number, accession, several) -> block (its least number), sets."""
    def run(sets: pa.Table, kept: pa.Table) -> pa.Table:
        blocks: list[tuple[int, bytes]] = []
        if len(sets) and len(kept):
            kept = kept.sort_by("id").combine_chunks()
            ids = kept["id"].to_numpy()
            own = sets["id"].to_numpy()
            place = np.searchsorted(ids, own)
            place[place == len(ids)] = 0
            there = np.flatnonzero(ids[place] == own)
            sets, kept = sets.take(pa.array(there)), kept.take(pa.array(place[there]))
            for a, z in bounded(sets["n"].to_numpy().astype(np.int64), most):
                part, size = kept.slice(a, z - a), sets["n"][a:z].to_numpy().astype(np.int64)
                order = np.lexsort((part["number"].to_numpy(), size))
                part, size = part.take(pa.array(order)), size[order]
                codes = unpacked(sets["codes"][a:z].take(pa.array(order)), size)
                block = block_of(part["number"].to_numpy(), part["accession"].combine_chunks(), part["several"].to_numpy(), size, codes)
                blocks.append((int(block.number.min()), block.pack()))
                del block, codes
            give_back()
        return pa.table({"block": pa.array([b for b, _ in blocks], pa.int64()), "sets": pa.array([s for _, s in blocks], pa.binary())})
    return run


def stored_blocks(sets: DataFrame, kept: DataFrame, most: int) -> DataFrame:
    """block, sets: the stored ``sets`` (id, n, codes) that ``kept`` (id, number, accession, several) names, in blocks of about ``most`` members."""
    total = sets.agg(F.sum("n")).first()[0] or 0
    place = F.pmod(F.xxhash64("id"), F.lit(max(1, -(-total // most)))).cast("int")
    met = sets.select(place.alias("place"), "id", "n", "codes").groupBy("place").cogroup(kept.withColumn("place", place).groupBy("place"))
    return _stored(met.applyInArrow(packed(most), "block long, sets binary"), max(1, total // most // FILES), "set-blocks")


def _stored(blocks: DataFrame, rows: int, label: str) -> DataFrame:
    path = scratch_path(blocks.sparkSession, label)
    blocks.write.option("maxRecordsPerFile", rows).option("compression", "none").parquet(path)
    return blocks.sparkSession.read.schema(blocks.schema).parquet(path)


def block_pairs(blocks: DataFrame, share: float, several: bool | None = None, named: bool = True) -> DataFrame:
    """Names and figures, or the numbers, of all pairs of the sets in stored ``blocks`` with that ``share`` of the smaller one in the other.

    ``several``: only pairs with (or without) a set that is marked so.
    """
    one = blocks.select(F.col("block").alias("i"), F.col("sets").alias("one"))
    other = blocks.select(F.col("block").alias("j"), F.col("sets").alias("other"))
    return one.join(other, F.col("i") <= F.col("j")).mapInArrow(compared(share, several, named), NAMED if named else NUMBERED)


# ---- pairs that meet as near holders of a code, in the order of their numbers


def shard_of(code: np.ndarray, shards: int) -> np.ndarray:
    return ((code.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)).astype(np.int64) % shards


def dealt(shards: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For ``mapInArrow``: blocks -> shard, block, and of the shard's codes the steps, holders and their numbers."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(len(batch)):
                block, shard = Block.unpack(batch["sets"][k].as_buffer()), None
                shard = shard_of(block.code, shards)
                of = np.repeat(shard, block.held)
                for s in range(shards):
                    mine = shard == s
                    if mine.any():
                        numbers = block.number[block.rows[of == s]]
                        yield pa.RecordBatch.from_pydict({"shard": pa.array([s], pa.int32()), "block": batch["block"].slice(k, 1),
                                                          "codes": pa.array([varint(np.diff(block.code[mine], prepend=0))[0].tobytes()]),
                                                          "held": pa.array([varint(block.held[mine])[0].tobytes()]),
                                                          "numbers": pa.array([varint(numbers)[0].tobytes()])})
    return run


def _numbers(data: pa.Scalar) -> np.ndarray:
    return from_varint(np.frombuffer(data.as_buffer(), np.uint8))


def ranked(rows: pa.Table) -> pa.Table:
    """The blocks' rows of one shard -> shard, block, ranks (from 1) of the holders of each code by number, as they came."""
    code, number, sizes = [], [], []
    for k in range(len(rows)):
        held = _numbers(rows["held"][k])
        code.append(np.repeat(np.cumsum(_numbers(rows["codes"][k])), held))
        number.append(_numbers(rows["numbers"][k]))
        sizes.append(len(number[-1]))
    code, number = np.concatenate(code), np.concatenate(number)
    order = np.lexsort((number, code))
    code = code[order]
    begins = np.flatnonzero(np.diff(code, prepend=-1))
    rank = np.empty(len(code), np.int64)
    rank[order] = np.arange(1, len(code) + 1) - np.repeat(begins, np.diff(begins, append=len(code)))
    ends = np.cumsum(sizes)
    return pa.table({"shard": rows["shard"], "block": rows["block"],
                     "ranks": pa.array([varint(rank[z - n:z])[0].tobytes() for n, z in zip(sizes, ends, strict=True)], pa.binary())})


def with_ranks(shards: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """For a cogroup: one block and its rows of ``ranked`` -> block, sets, ranks in the order of its holders."""
    def run(blocks: pa.Table, ranks: pa.Table) -> pa.Table:
        block = Block.unpack(blocks["sets"][0].as_buffer())
        of = np.repeat(shard_of(block.code, shards), block.held)
        out = np.zeros(len(of), np.int64)
        for s, data in zip(ranks["shard"].to_pylist(), ranks["ranks"].combine_chunks(), strict=True):
            out[of == s] = _numbers(data)
        give_back()
        return pa.table({"block": blocks["block"], "sets": blocks["sets"], "ranks": pa.array([varint(out)[0].tobytes()], pa.binary())})
    return run


def near_found(one: Block, other: Block, at: tuple[np.ndarray, np.ndarray], ranks: tuple[np.ndarray, np.ndarray], share: float, near: int
               ) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """As ``found``, of the pairs of which one holds a code first of all, or both at ranks that differ by ``near`` at most; in any order."""
    same, codes = one is other, len(at[0])
    parts = []
    for block, own, rank in ((one, at[0], ranks[0]),) if same else zip((one, other), at, ranks, strict=True):
        known = np.zeros(len(block.code), bool)
        known[own] = True
        some = np.repeat(known, block.held)
        parts.append((np.repeat(np.arange(codes, dtype=np.int32), block.held[own]), rank[some], block.rows[some]))
        del some, known
    code, rank, row = (np.concatenate([p[k] for p in parts]) for k in range(3))
    side = np.repeat(np.arange(len(parts), dtype=np.int8), [len(p[0]) for p in parts])
    del parts
    bits = len(other.number).bit_length()
    key = code.astype(np.int64)
    key <<= 32
    key |= rank
    order = np.argsort(key)
    del key
    begins = np.flatnonzero(np.diff(code[order], prepend=-1))
    ends = np.append(begins[1:], len(order))
    led = rank[order[begins]] == 1
    begins, ends = begins[led], ends[led]
    pairs = [np.zeros(0, np.int64)]

    def meet(x: np.ndarray, y: np.ndarray) -> None:
        if same:
            i, j = np.minimum(row[x], row[y]), np.maximum(row[x], row[y])
        else:
            turned = side[x] == 1
            i, j = np.where(turned, row[y], row[x]), np.where(turned, row[x], row[y])
        pairs.append((i.astype(np.int64) << bits) | j)

    for a in range(0, len(order), LOOKED_UP):
        for d in range(1, near + 1):
            y = order[a + d:a + d + LOOKED_UP]
            x = order[a:a + len(y)]
            some = (code[x] == code[y]) & (rank[y] - rank[x] <= near) & (same | (side[x] != side[y]))
            meet(x[some], y[some])
    for a, z in bounded(ends - begins, LOOKED_UP):
        n = ends[a:z] - begins[a:z] - 1
        x, y = np.repeat(order[begins[a:z]], n), order[spread(begins[a:z] + 1, n)]
        some = same | (side[x] != side[y])
        meet(x[some], y[some])
    del order, rank, side, code, row
    near_keys = np.concatenate(pairs)
    del pairs
    near_keys.sort()
    for turned in (False,) if same else (False, True):
        for i, j, shared in found(other, one, at[::-1], share, None) if turned else found(one, other, at, share, None):
            i, j = (j, i) if turned else (i, j)
            key = (i << bits) | j
            place = np.searchsorted(near_keys, key)
            place[place == len(near_keys)] = 0
            some = near_keys[place] == key if len(near_keys) else np.zeros(len(key), bool)
            yield i[some], j[some], shared[some]


def near_compared(share: float, near: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For ``mapInArrow``: packed pairs of blocks with ranks -> their pairs of sets."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(len(batch)):
                one, same = Block.unpack(batch["one"][k].as_buffer()), batch["i"][k].as_py() == batch["j"][k].as_py()
                other = one if same else Block.unpack(batch["other"][k].as_buffer())
                ranks = _numbers(batch["one_ranks"][k]).astype(np.int32), _numbers(batch["other_ranks"][k]).astype(np.int32)
                at = common(one, other)
                if len(at[0]):
                    for i, j, shared in near_found(one, other, at, ranks, share, near):
                        yield from _named(one, other, i, j, shared)
                give_back()
    return run


def near_pairs(blocks: DataFrame, shards: int, share: float, near: int) -> DataFrame:
    """``block_pairs`` of the sets that meet as ``near`` holders of a code, or with its first holder, by number."""
    ranks = (blocks.mapInArrow(dealt(shards), "shard int, block long, codes binary, held binary, numbers binary")
             .groupBy("shard").applyInArrow(ranked, "shard int, block long, ranks binary"))
    found = blocks.groupBy("block").cogroup(ranks.groupBy("block")).applyInArrow(with_ranks(shards), "block long, sets binary, ranks binary")
    blocks = _stored(found, max(1, shards // FILES), "ranked-blocks")
    one = blocks.select(F.col("block").alias("i"), F.col("sets").alias("one"), F.col("ranks").alias("one_ranks"))
    other = blocks.select(F.col("block").alias("j"), F.col("sets").alias("other"), F.col("ranks").alias("other_ranks"))
    return one.join(other, F.col("i") <= F.col("j")).mapInArrow(near_compared(share, near), NAMED)
