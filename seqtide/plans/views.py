"""Sequences, metadata, taxonomy and vectors derived from the given tables.

Each view exists twice: as a DataFrame and as DuckDB text for the check.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seqtide.functions.kmers import letters, runs


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def spread_table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A table whose rows are costly to process: rows of too few splits go to all cores.

    Only a small file has fewer splits than there are cores; large tables stay as they are.
    """
    df = table(spark, sf, name)
    cores = spark.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


_SEQS = """
select doc_id, accession, taxid,
       concat(accession, case when doc_id % 5 = 0 then '' else concat(' |taxid|', taxid, '|') end,
              ' ', source, ' ', lang) as header, sequence
from (select doc_id, source, lang,
             concat('DOC', lpad(cast(doc_id as {text}), 8, '0'), '.1') as accession,
             cast(doc_id % 97 + 1 as {text}) as taxid,
             {letters} as sequence
      from {documents}) d
"""
_LETTERS = """translate(regexp_replace(lower(text), '[^a-zß-öø-ÿ]', '', 'g'),
                       'abcdefghijklmnopqrstuvwxyzßàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿ',
                       'ACGTACGTACGTACGTACGTACGTACGTACGTACGTACGTACGTACGTACGTACGTAC')"""

# every second of five gets a changed copy: 3 % of the letters everywhere, or 8 % in places
_STRAINS = """
select accession, sequence from {seqs}
union all
select concat(accession, 'M'), {mutated} from {seqs} where doc_id % 5 < 2 and length(sequence) > 0
"""
_CHANGED = "case when doc_id % 5 = 0 then {i} % 33 = 0 else {i} % 100 >= 60 and {i} % 5 = 0 end"
_DUCK_MUTATED = ("array_to_string(list_transform(string_split(sequence, ''), lambda c, i: case when "
                 + _CHANGED.replace("{i}", "(i - 1)") + " then translate(c, 'ACGT', 'CGTA') else c end), '')")

# the strains, and of every fifth sequence the middle third on its own
_FRAGMENTS = """
select accession, sequence from {strains}
union all
select concat(accession, 'F'), substr(sequence, 1 + cast(floor(length(sequence) / 3) as int), cast(floor(length(sequence) / 3) as int))
from {seqs} where doc_id % 5 = 3 and length(sequence) >= 3
"""

_META = """
select accession,
       case when doc_id % 7 = 0 then null when doc_id % 11 = 0 then doc_id % 97 + 2
            else doc_id % 97 + 1 end as taxId
from {seqs} where doc_id % 3 <> 0
"""

_TREE = """
with seg as (select c_mktsegment, row_number() over (order by c_mktsegment) as sid
             from (select distinct c_mktsegment from {customer}) x)
select 1 as tax_id, 1 as parent_id, 'no rank' as rank, 'root' as name
union all select 10 + r_regionkey, 1, 'superkingdom', r_name from {region}
union all select 100 + n_nationkey, 10 + n_regionkey, 'phylum', n_name from {nation}
union all select 1000 + n_nationkey * 10 + sid, 100 + n_nationkey, 'class',
                 concat(n_name, '_', c_mktsegment) from {nation}, seg
union all select 100000 + c_custkey, 1000 + c_nationkey * 10 + sid, 'species', c_name
          from {customer} join seg using (c_mktsegment)
"""

_RANKS = """
select vec_id, concat('VEC', lpad(cast(vec_id as {text}), 6, '0')) as accession,
       cast(label + 1 as {text}) as taxid,
       concat('K', cast(floor(label / 5) as int)) as superkingdom,
       concat('P', cast(floor(label / 4) as int)) as phylum,
       concat('C', cast(floor(label / 3) as int)) as {class_},
       concat('O', cast(floor(label / 2) as int)) as {order_},
       concat('F', label) as family,
       case when label = 7 then '' else concat('G', label, '_', vec_id % 3) end as genus,
       case when label % 3 = 2 then '' else concat('S', label, '_', vec_id % 4) end as species
from {embeddings}
"""


def _bases(text: str) -> np.ndarray:
    """Last byte of each letter in UTF-8 -> the base it stands for."""
    table = np.zeros(256, np.uint8)
    for letter in text:
        table[letter.encode()[-1]] = ord("ACGT"[_ALPHABET.index(letter) % 4])
    return table


_ALPHABET = "abcdefghijklmnopqrstuvwxyzßàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿ"
# letters of one byte, and those of two, which all begin with the same one
_PLAIN, _ACCENTED, _FIRST = _bases(_ALPHABET[:26]), _bases(_ALPHABET[26:]), "ß".encode()[0]
_SWAP = np.arange(256, dtype=np.uint8)
_SWAP[list(b"ACGT")] = list(b"CGTA")


def _strings(raw: np.ndarray, sizes: np.ndarray, like: pa.Array) -> pa.Array:
    """Strings of these sizes, null where ``like`` is."""
    ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    known = np.packbits(like.is_valid().to_numpy(zero_copy_only=False), bitorder="little")
    return pa.Array.from_buffers(pa.string(), len(like), [pa.py_buffer(known), pa.py_buffer(ends), pa.py_buffer(raw)])


def bases_udf():
    """Lower-case text -> its letters as bases, in runs of bounded size; as ``_LETTERS`` after ``lower``."""
    @F.arrow_udf("string")
    def bases(texts: pa.Array) -> pa.Array:
        flat = texts.fill_null("")
        offsets = np.frombuffer(flat.buffers()[1], np.int32, len(flat) + 1, 4 * flat.offset).astype(np.int64)
        data = flat.buffers()[2]
        raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
        out, sizes = [np.zeros(0, np.uint8)], [np.zeros(0, np.int64)]
        for a, b in runs(offsets - offsets[0]):
            part = raw[offsets[a]:offsets[b]]
            base = _PLAIN[part]
            second = np.flatnonzero(part[:-1] == _FIRST) + 1
            base[second] = _ACCENTED[part[second]]
            before = np.concatenate([[0], np.cumsum(base != 0)])
            out.append(base[base != 0])
            sizes.append(np.diff(before[offsets[a:b + 1] - offsets[a]]))
        return _strings(np.concatenate(out), np.concatenate(sizes), texts)
    return bases


def changed_udf():
    """Bases, and whether they change everywhere -> the changed copy, as ``_DUCK_MUTATED``."""
    @F.arrow_udf("string")
    def changed(sequences: pa.Array, everywhere: pa.Array) -> pa.Array:
        raw, offsets = letters(sequences)
        out, all_over = raw.copy(), everywhere.fill_null(False).to_numpy(zero_copy_only=False)
        for a, b in runs(offsets):
            sizes = np.diff(offsets[a:b + 1])
            i = np.arange(offsets[a], offsets[b]) - np.repeat(offsets[a:b], sizes)
            hit = offsets[a] + np.flatnonzero(np.where(np.repeat(all_over[a:b], sizes), i % 33 == 0, (i % 100 >= 60) & (i % 5 == 0)))
            out[hit] = _SWAP[raw[hit]]
        return _strings(out, np.diff(offsets), sequences)
    return changed


def seqs(spark: SparkSession, sf: str) -> DataFrame:
    """Sequences with accession and header; every fifth header has no taxid."""
    documents = spread_table(spark, sf, "documents").withColumn("_letters", bases_udf()(F.lower("text")))
    return spark.sql(_SEQS.replace("{letters}", "_letters").replace("{text}", "string"), documents=documents)


def strains(spark: SparkSession, sf: str) -> DataFrame:
    """Sequences and changed copies of some of them."""
    found = seqs(spark, sf).withColumn("_changed", changed_udf()("sequence", F.col("doc_id") % 5 == 0))
    return spark.sql(_STRAINS.replace("{mutated}", "_changed"), seqs=found)


def fragments(spark: SparkSession, sf: str) -> DataFrame:
    """Sequences, changed copies and parts of some of them."""
    return spark.sql(_FRAGMENTS, strains=strains(spark, sf), seqs=seqs(spark, sf))


def meta(spark: SparkSession, sf: str) -> DataFrame:
    """Partial metadata with missing taxids and some that differ from the header."""
    return spark.sql(_META, seqs=seqs(spark, sf))


def tree(spark: SparkSession, sf: str) -> DataFrame:
    """Taxonomy nodes; order, family and genus are absent."""
    return spark.sql(_TREE, **{n: table(spark, sf, n) for n in ("customer", "region", "nation")})


def ranks(spark: SparkSession, sf: str) -> DataFrame:
    """Lineage of each vector, genus and species empty in places."""
    text = _RANKS.replace("{text}", "string").replace("{class_}", "`class`").replace("{order_}", "`order`")
    return spark.sql(text, embeddings=table(spark, sf, "embeddings"))


def planted(spark: SparkSession, sf: str) -> DataFrame:
    """Nine clear clusters (labels 0-8) and noise (label 9), unit length."""
    return spark.sql("""
        select vec_id, label,
               transform(array(sqrt(aggregate(e, 0D, (a, y) -> a + y * y))),
                         n -> transform(e, x -> x / n))[0] as embedding
        from (select vec_id, label, transform(embedding, (x, i) -> cast(x as double)
                + case when i = label and label <> 9 then 3D else 0D end) as e from {v}) t
    """, v=table(spark, sf, "embeddings"))


def _duck(text: str) -> str:
    for name in ("documents", "customer", "region", "nation", "embeddings", "seqs", "strains"):
        text = text.replace("{%s}" % name, name)
    return (text.replace("{letters}", _LETTERS).replace("{text}", "varchar")
            .replace("{class_}", '"class"').replace("{order_}", '"order"')).strip()


DUCK = {
    "seqs": _duck(_SEQS),
    "strains": _duck(_STRAINS.replace("{mutated}", _DUCK_MUTATED)),
    "fragments": _duck(_FRAGMENTS),
    "meta": _duck(_META),
    "tree": _duck(_TREE),
    "ranks": _duck(_RANKS),
    "planted": """
select vec_id, label,
       list_transform(e, lambda x: x / sqrt(list_sum(list_transform(e, lambda y: y * y)))) as embedding
from (select vec_id, label, list_transform(embedding, lambda x, i: x::double
        + case when i = label + 1 and label <> 9 then 3 else 0 end) as e from embeddings) t""",
}
_NEEDS = {"meta": ["seqs"], "strains": ["seqs"], "fragments": ["seqs", "strains"]}


def duck(body: str, *views: str, recursive: bool = False) -> str:
    """DuckDB text: the named views as CTEs in front of ``body`` (itself CTEs or a select)."""
    names: list[str] = []
    for v in views:
        names += [n for n in _NEEDS.get(v, []) + [v] if n not in names]
    parts = [f"{n} as ({DUCK[n]})" for n in names]
    body = body.strip()
    if body.lower().startswith("with "):
        body = body[5:].lstrip()
        if body.lower().startswith("recursive "):
            recursive, body = True, body[10:]
        parts.append("")
        head = ",\n".join(parts)
    else:
        head = ",\n".join(parts) + "\n"
    return ("with recursive " if recursive else "with ") + head + body
