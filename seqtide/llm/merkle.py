"""Merkle manifest of a table of documents, with one proof per document by multiproofs.

Every row is a leaf. Within a source the leaves ascend by doc_id; every three consecutive
nodes become their hash, level by level, until one is left, the subroot. Subroots in the
order of their sources give the root in the same way.

Leaves are sorted once over the whole table and cut into runs of ``RUN`` rows, whatever
sources they belong to, so a hot source is many runs and a thousand small ones are one. A run hashes all
nodes it can on its own; the few whose parents reach into other runs are combined in
rounds of ``SPAN`` runs. For the proofs a run computes the smallest set of node
coordinates that it lacks for all of its leaves together, from positions alone (an Octopus
multiproof), gets these in one join, derives the nodes its leaves share, and expands the proof
of each leaf on its own. What travels per run is a few dozen digests, not one proof per leaf.

A null source is a source of its own and comes first; a null doc_id comes first within its
source. Rows that share source and doc_id are leaves of their own, ordered by their digest;
equal rows have equal proofs' lengths but places of their own. Null columns enter the leaf as ``-``, an empty text as
``0:``. A table without rows has no root and gives no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqtide.operators.skew import dense_index, salted_join
from seqtide.session import materialise

#: Consecutive leaves that one group hashes and proves.
RUN = 4096
#: Neighbouring runs, or groups of runs, whose open nodes meet in the next round.
SPAN = 128
#: Children of a node.
ARITY = 3
#: The tree above the subroots; the trees of the sources count from 0.
TOP = -1

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_NODES = "run long, tree long, total long, level int, pos long, digest binary, fresh boolean, open boolean"
_WANTED = "run long, tree long, level int, pos long"
_PROOFS = "doc_id long, leaf string, subroot string, root string, proof string, folded_root string"


def leaf_digest(**changed: Column) -> Column:
    """SHA-256 of a row: each field as byte count, colon and value, ``-`` if null. Keywords replace fields."""
    def part(name: str) -> Column:
        value = changed.get(name, F.col(name)).cast("string")
        return F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value))
    return F.sha2(F.concat(*[part(name) for name in FIELDS]), 256)


def _hash(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def _above(n: int) -> int:
    return -(-n // ARITY)


def climb(total: int, known: dict[int, dict[int, str]]) -> list[tuple[int, int, str, bool]]:
    """All nodes (level, pos, digest, made) of a tree of ``total`` leaves that follow from those ``known``
    by level and position; ``known`` is left with the nodes whose parent cannot be made from it."""
    level, width, out, todo = 0, total, [], max(known, default=0)
    while level <= todo:
        nodes, above = known.get(level, {}), {}
        if width > 1:
            for p in sorted({k // ARITY for k in nodes}):
                kids = range(ARITY * p, min(ARITY * p + ARITY, width))
                if all(k in nodes for k in kids):
                    above[p] = _hash("".join([nodes[k] for k in kids]))
                    for k in kids:
                        del nodes[k]
        if above:
            known.setdefault(level + 1, {}).update(above)
            out += [(level + 1, p, h, True) for p, h in above.items()]
            todo = max(todo, level + 1)
        level, width = level + 1, _above(width)
    return out


def missing(total: int, lo: int, hi: int) -> list[tuple[int, int]]:
    """Coordinates (level, pos) that leaves ``lo`` to ``hi`` - 1 of a tree of ``total`` leaves lack to reach
    its top: the smallest set, as all shared nodes are derived."""
    level, width, out = 0, total, []
    while width > 1:
        up_lo, up_hi = lo // ARITY, (hi - 1) // ARITY + 1
        out += [(level, k) for k in range(ARITY * up_lo, lo)]
        out += [(level, k) for k in range(hi, min(ARITY * up_hi, width))]
        lo, hi, width, level = up_lo, up_hi, _above(width), level + 1
    return out


class Branch:
    """The part of a tree between consecutive leaves and its top."""

    def __init__(self, total: int, lo: int, leaves: list[str], fetched: dict[tuple[int, int], str]):
        self.steps: list[dict[int, tuple[str, str]]] = []
        nodes, width, level = dict(enumerate(leaves, lo)), total, 0
        while width > 1:
            step, above = {}, {}
            for p in sorted({k // ARITY for k in nodes}):
                kids = [nodes[k] if k in nodes else fetched[level, k] for k in range(ARITY * p, min(ARITY * p + ARITY, width))]
                for i in range(len(kids)):
                    if ARITY * p + i in nodes:
                        step[ARITY * p + i] = "".join(kids[:i]), "".join(kids[i + 1:])
                above[p] = _hash("".join(kids))
            self.steps.append(step)
            nodes, width, level = above, _above(width), level + 1
        (self.top,) = nodes.values()

    def path(self, pos: int) -> list[tuple[str, str]]:
        """What stands left and right of the node on each level, from the leaf up."""
        out = []
        for step in self.steps:
            out.append(step[pos])
            pos //= ARITY
        return out


def _column(table: pa.Table, name: str) -> list:
    return table.column(name).to_pylist()


def _node_table(rows: list[tuple]) -> pa.Table:
    names = [f.split()[0] for f in _NODES.split(", ")]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.bool_(), pa.bool_()]
    columns = list(zip(*rows, strict=True)) if rows else [[]] * len(names)
    return pa.table([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)


def _is_top(total: int, level: int) -> bool:
    for _ in range(level):
        total = _above(total)
    return total == 1


def _emit(run: int, tree: int, total: int, known: dict[int, dict[int, str]], made: list, whole: bool) -> list[tuple]:
    """Rows of the made nodes and of those that are left open; only open ones and the top unless ``whole``."""
    opened = {(level, k) for level, nodes in known.items() for k in nodes if not _is_top(total, level)}
    rows = [(run, tree, total, level, k, bytes.fromhex(h), True, (level, k) in opened) for level, k, h, _ in made
            if whole or (level, k) in opened or _is_top(total, level)]
    seen = {(level, k) for level, k, _, _ in made}
    return rows + [(run, tree, total, level, k, bytes.fromhex(h), False, True) for level, nodes in known.items()
                   for k, h in nodes.items() if (level, k) in opened and (level, k) not in seen]


def _first_round(rows: pa.Table, parts: pa.Table) -> pa.Table:
    """Nodes of one run of leaves; leaves that stay open, or are subroots, are nodes too."""
    leaves = [d.hex() for d in _column(rows.sort_by("idx"), "leaf")]
    out, at = [], 0
    for p in parts.sort_by("base").to_pylist():
        n = p["hi"] - p["lo"]
        known = {0: dict(enumerate(leaves[at:at + n], p["lo"]))}
        made = climb(p["total"], known)
        for row in _emit(p["run"], p["tree"], p["total"], known, made, False):
            out.append((*row[:6], True, row[7]))
        if p["total"] == 1:
            out.append((p["run"], p["tree"], 1, 0, 0, bytes.fromhex(leaves[at]), True, False))
        at += n
    return _node_table(out)


def _next_round(rows: pa.Table) -> pa.Table:
    """Nodes that follow from the open nodes of neighbouring runs."""
    trees: dict[tuple[int, int], dict[int, dict[int, str]]] = {}
    for r in rows.to_pylist():
        trees.setdefault((r["tree"], r["total"]), {}).setdefault(r["level"], {})[r["pos"]] = r["digest"].hex()
    (run,) = set(_column(rows, "run"))
    return _node_table([row for (tree, total), known in trees.items()
                        for row in _emit(run, tree, total, known, climb(total, known), True)])


def _finish(state: DataFrame, kept: list[DataFrame]) -> DataFrame:
    """Rounds over the open nodes until every tree has its top; all nodes made or opened on the way."""
    while not state.where("open").isEmpty():
        wider = state.where("open").withColumn("run", F.floor(F.col("run") / SPAN).cast("long"))
        state = materialise(wider.groupBy("run").applyInArrow(_next_round, _NODES), "nodes")
        kept.append(state.where("fresh"))
    return reduce(DataFrame.unionByName, kept)


def _wanted(count: int):
    def run(parts: pa.Table) -> pa.Table:
        rows = parts.to_pylist()
        number, out = rows[0]["run"], []
        for p in rows:
            out += [(number, p["tree"], level, k) for level, k in missing(p["total"], p["lo"], p["hi"])]
        ranks = [p["tree"] for p in rows]
        out += [(number, TOP, level, k) for level, k in missing(count, min(ranks), max(ranks) + 1)]
        columns = list(zip(*out, strict=True)) if out else [[]] * 4
        return pa.table([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int32(), pa.int64()), strict=True)],
                        names=["run", "tree", "level", "pos"])
    return run


def _fold(digest: str, path: list[tuple[str, str]]) -> str:
    for left, right in path:
        digest = _hash(left + digest + right)
    return digest


def _expand(count: int):
    def run(rows: pa.Table, side: pa.Table) -> pa.Table:
        rows = rows.sort_by("idx")
        leaves = [d.hex() for d in _column(rows, "leaf")]
        shown = [d.hex() if d is not None else h for d, h in zip(_column(rows, "presented"), leaves, strict=True)]
        parts, fetched = [], {}
        for s in side.to_pylist():
            if s["base"] is None:
                fetched.setdefault(s["tree"], {})[s["level"], s["pos"]] = s["digest"].hex()
            else:
                parts.append(s)
        parts.sort(key=lambda s: s["base"])
        branches, at = [], 0
        for p in parts:
            n = p["hi"] - p["lo"]
            branches.append(Branch(p["total"], p["lo"], leaves[at:at + n], fetched.get(p["tree"], {})))
            at += n
        top = Branch(count, parts[0]["tree"], [b.top for b in branches], fetched.get(TOP, {}))
        subroots, proofs, folded, at = [], [], [], 0
        for p, branch in zip(parts, branches, strict=True):
            high = top.path(p["tree"])
            tail = "".join([left + right for left, right in high])
            for pos in range(p["lo"], p["hi"]):
                path = branch.path(pos)
                proofs.append("".join([left + right for left, right in path]) + tail)
                folded.append(_fold(_fold(shown[at], path), high))
                at += 1
            subroots += [branch.top] * (p["hi"] - p["lo"])
        return pa.table([rows.column("doc_id"), pa.array(leaves), pa.array(subroots), pa.array([top.top] * len(leaves)),
                         pa.array(proofs), pa.array(folded)], names=[f.split()[0] for f in _PROOFS.split(", ")])
    return run


def prove(docs: DataFrame, presented: Column | None = None) -> DataFrame:
    """doc_id, leaf, subroot, root, proof, folded_root, verified of every row, digests in lowercase hex.

    ``proof`` holds the siblings of the leaf and of the nodes above it, level by level and
    from left to right. ``presented`` is the leaf digest (hex) that a holder of the document
    shows, null for the leaf itself: ``folded_root`` is what it and the proof lead to, and
    ``verified`` says whether that is the root.
    """
    spark = docs.sparkSession
    shown = F.lit(None).cast("string") if presented is None else presented
    # null sources sort before the empty name
    hashed = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("name"),
        F.unhex(leaf_digest()).alias("leaf"), F.unhex(shown).alias("presented"),
        # equal rows may stand in any order; the salt lets them part
        F.xxhash64(F.monotonically_increasing_id()).alias("salt"))
    hashed = materialise(hashed, "leaves")
    rows = dense_index(hashed, ["name", "doc_id", "leaf", "salt"], "idx").select(
        F.floor(F.col("idx") / RUN).cast("long").alias("run"), "idx", "name", "doc_id", "leaf", "presented")
    rows = materialise(rows, "runs")
    cut = materialise(rows.groupBy("run", "name").agg(F.min("idx").alias("base"), F.count("*").alias("n")), "cuts")
    sources = cut.groupBy("name").agg(F.min("base").alias("first"), F.sum("n").alias("total"), F.count("*").alias("cuts"))
    sources = materialise(dense_index(sources, ["first"], "tree").withColumn("tree", F.col("tree").cast("long")), "sources")
    count = sources.count()
    if not count:
        return spark.createDataFrame([], _PROOFS + ", verified boolean")
    named = salted_join(cut, sources.drop("cuts"), "name", weights=sources.select("name", F.col("cuts").alias("n")))
    parts = materialise(named.select("run", "tree", "total", "base", (F.col("base") - F.col("first")).alias("lo"),
                                     (F.col("base") - F.col("first") + F.col("n")).alias("hi")), "parts")
    leaves = rows.select("run", "idx", "leaf")
    state = materialise(leaves.groupBy("run").cogroup(parts.groupBy("run")).applyInArrow(_first_round, _NODES), "nodes")
    nodes = _finish(state, [state])
    subroots = nodes.join(sources.select("tree", "total"), ["tree", "total"]).where(_top("total", "level"))
    lifted = materialise(subroots.select(
        F.floor(F.col("tree") / RUN).cast("long").alias("run"), F.lit(TOP).cast("long").alias("tree"), F.lit(count).cast("long").alias("total"),
        F.lit(0).alias("level"), F.col("tree").alias("pos"), "digest", F.lit(True).alias("fresh"), F.lit(count > 1).alias("open")), "subroots")
    # the tree of subroots is climbed in the same way, from runs of subroots on; all of its nodes are kept
    first = materialise(lifted.groupBy("run").applyInArrow(_next_round, _NODES), "tops")
    nodes = nodes.unionByName(lifted).unionByName(_finish(first, [first.where("fresh")]))
    wanted = parts.groupBy("run").applyInArrow(_wanted(count), _WANTED)
    fetched = salted_join(wanted, nodes.select("tree", "level", "pos", "digest"), ["tree", "level", "pos"])
    none = F.lit(None).cast("long")
    side = parts.select("run", "tree", "total", "base", "lo", "hi", F.lit(None).cast("int").alias("level"), none.alias("pos"),
                        F.lit(None).cast("binary").alias("digest")).unionByName(
        fetched.select("run", "tree", none.alias("total"), none.alias("base"), none.alias("lo"), none.alias("hi"), "level", "pos", "digest"))
    proofs = rows.drop("name").groupBy("run").cogroup(side.groupBy("run")).applyInArrow(_expand(count), _PROOFS)
    return proofs.withColumn("verified", F.col("folded_root") == F.col("root"))


def _top(total: str, level: str) -> Column:
    """Whether a node of that level is the last of its tree: ARITY ** level leaves hold ``total``."""
    reach = F.pow(F.lit(ARITY).cast("double"), F.col(level))
    return (reach >= F.col(total)) & ((F.col(level) == 0) | (F.pow(F.lit(ARITY).cast("double"), F.col(level) - 1) < F.col(total)))


def tampered(docs: DataFrame) -> Column:
    """The leaf digest of a row whose text lost its line ends, for every second doc_id by CRC-32; else null."""
    picked = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    return F.when(picked & F.contains("text", F.lit("\n")), leaf_digest(text=F.replace("text", F.lit("\n"), F.lit(""))))


#: CRC-32 of the decimal doc_id in DuckDB: bytes, then bits, by the reflected polynomial.
_CRC = """xor(4294967295::bigint, list_reduce(
    list_prepend(4294967295::bigint, list_transform(range(1, length(doc_id::varchar) + 1), lambda i: ord(substr(doc_id::varchar, i, 1))::bigint)),
    lambda c, b: list_reduce(list_prepend(xor(c, b), [0::bigint, 0, 0, 0, 0, 0, 0, 0]),
                             lambda a, z: xor(a >> 1, 3988292384::bigint * (a & 1)))))"""

#: DuckDB text of the query.
ORACLE = r"""
with recursive doc as (
    select doc_id, coalesce('=' || source, '') as name,
           coalesce(strlen(doc_id::varchar) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
           || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::varchar) || ':' || n_chars, '-') as head, text
    from documents),
leaf as (
    select doc_id, name, sha256(head || coalesce(strlen(text) || ':' || text, '-')) as h,
           sha256(head || coalesce(strlen(replace(text, chr(10), '')) || ':' || replace(text, chr(10), ''), '-')) as altered
    from doc),
place as (select *, (row_number() over (partition by name order by doc_id nulls first, h) - 1)::bigint as pos from leaf),
up as (
    select name, 0 as lev, pos, h from place
    union all
    select name, lev + 1, p, sha256(string_agg(h, '' order by pos))
    from (select *, pos // 3 as p, count(*) over (partition by name) as n from up) x where n > 1 group by name, lev, p),
height as (select name, max(lev) as top from up group by name),
subroot as (
    select name, h, (row_number() over (order by encode(name)) - 1)::bigint as pos
    from up join height using (name) where lev = top),
high as (
    select 0 as lev, pos, h from subroot
    union all
    select lev + 1, p, sha256(string_agg(h, '' order by pos))
    from (select *, pos // 3 as p, count(*) over () as n from high) x where n > 1 group by lev, p),
steps as (
    select doc_id, place.pos as leaf_pos, name, up.lev as step, up.pos, up.h, place.pos // (3 ** up.lev)::bigint as own
    from place join height using (name) join up using (name)
    where up.lev < top and up.pos // 3 = place.pos // (3 ** (up.lev + 1))::bigint
    union all
    select doc_id, place.pos, place.name, top + high.lev, high.pos, high.h, subroot.pos // (3 ** high.lev)::bigint
    from place join height using (name) join subroot using (name)
    join high on high.pos // 3 = subroot.pos // (3 ** (high.lev + 1))::bigint
    where high.lev < (select max(lev) from high)),
sides as (
    select doc_id, leaf_pos, name, step, coalesce(string_agg(h, '' order by pos) filter (pos < own), '') as l,
           coalesce(string_agg(h, '' order by pos) filter (pos > own), '') as r
    from steps group by doc_id, leaf_pos, name, step),
proof as (select leaf_pos, name, string_agg(l || r, '' order by step) as p from sides group by leaf_pos, name),
start as (
    select doc_id, name, pos, h,
           case when crc is not null and crc % 2 = 0 then altered else h end as shown
    from (select *, __CRC__ as crc from place) y),
fold as (
    select name, pos, 0 as step, shown as h from start
    union all
    select f.name, f.pos, f.step + 1, sha256(l || f.h || r)
    from fold f join sides s on s.name = f.name and s.leaf_pos = f.pos and s.step = f.step),
last as (select name, pos, arg_max(h, step) as h from fold group by name, pos)
select start.doc_id, start.h as leaf, subroot.h as subroot, top.h as root, sha256(coalesce(p, '')) as proof_sha256,
       last.h as folded_root, last.h = top.h as verified
from start join subroot using (name) join last on last.name = start.name and last.pos = start.pos
left join proof on proof.name = start.name and proof.leaf_pos = start.pos,
(select h from high order by lev desc limit 1) top""".replace("__CRC__", _CRC)
