"""Cases that once gave wrong or partial answers."""

from pyspark.sql import functions as F

from seqtide.config import RANKS
from seqtide.operators import lineage, vote
from seqtide.operators.skew import salted_join
from seqtide.plans.classify import from_neighbours
from seqtide.session import materialise
from seqtide.sources import fasta, metadata, vectors
from seqtide.streaming import arrivals


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_equal_keys_are_salted_however_small_they_are_stored(spark):
    facts = materialise(spark.range(0, 3_000_000, 1, 8).select(F.lit(7).cast("long").alias("k"), F.lit("x").alias("v")), "hot")
    dim = spark.createDataFrame([(7, "seven")], "k long, name string")
    got = salted_join(facts, dim, "k", stored=True)
    assert "_salt" in plan(got) and got.count() == 3_000_000
    exploded = spark.range(30).select(F.lit(7).cast("long").alias("k"), F.explode(F.sequence(F.lit(1), F.lit(100_000))).alias("v"))
    assert "_salt" in plan(salted_join(exploded, dim, "k"))


def test_null_keys_stay_in_left_joins(spark):
    facts = spark.createDataFrame([(None, i) for i in range(300)] + [(1, i) for i in range(500)], "k long, v long")
    dim = spark.createDataFrame([(1, "one"), (None, "none")], "k long, name string")
    got = salted_join(facts, dim, "k", "left", hot_rows=100)
    assert "_salt" in plan(got)
    assert got.where("k is null and name is null").count() == 300 and got.where("name = 'one'").count() == 500
    assert salted_join(facts, dim, "k", hot_rows=100).count() == 500


def test_headers_with_blanks_and_text_before_the_first(spark, tmp_path):
    (tmp_path / "a.fasta").write_text("; comment\n> B x\nACGT\n>\nTT\n>C\nGG\n")
    (tmp_path / "b.fasta").write_text(">D\nAA\n")
    got = {r["accession"]: r["sequence"] for r in fasta.read_fasta(spark, str(tmp_path)).collect()}
    assert got == {"B": "ACGT", "C": "GG", "D": "AA"}


def test_last_header_wins(spark, tmp_path):
    (tmp_path / "a.fasta").write_text(">A |taxid|9|\nAC\n>A |taxid|10|\nAC\n>B |taxid|10|\nAC\n>B |taxid|9|\nAC\n")
    records = fasta.read_fasta(spark, str(tmp_path), position=True)
    assert {r["accession"]: r["taxid"] for r in lineage.header_map(records).collect()} == {"A": "10", "B": "9"}


def test_keys_in_line_order(spark, tmp_path):
    (tmp_path / "ids.txt").write_text("zeta\nalpha\n\n mid \n")
    ids = metadata.read_keys(spark, str(tmp_path), position=True)
    vec = spark.createDataFrame([(i, [float(i)]) for i in range(3)], "i int, embedding array<double>")
    got = {r["accession"]: r["i"] for r in vectors.zip_by_position(ids, vec, ["position"], ["i"]).collect()}
    assert got == {"zeta": 0, "alpha": 1, "mid": 2}


def test_no_query_is_lost(spark):
    names = spark.createDataFrame([("n1", *["name"] * 7)], "accession string, " + ", ".join(f"`{r}` string" for r in RANKS))
    near = spark.createDataFrame([("q1", "n1", 1), ("q2", "gone", 1), ("q3", "n1", 1), ("q3", "gone", 2)],
                                 "query_id string, neighbour_id string, rn int")
    clusters = spark.createDataFrame([("q1", 4, 1.0), ("q2", 4, 1.0)], "query_id string, cluster_id int, cluster_probability double")
    queries = spark.createDataFrame([(q,) for q in ("q1", "q2", "q3", "q4")], "accession string")
    got = {r["accession"]: r for r in from_neighbours(near, names, clusters, queries=queries).collect()}
    assert {q: (r["n_reference_neighbours"], r["cluster_id"], r["taxonomy"]["family"]["name"]) for q, r in got.items()} == {
        "q1": (1, 4, "name"), "q2": (1, 4, "Unknown"), "q3": (2, -1, "name"), "q4": (0, -1, "Unknown")}


def test_lookup_knows_keys_without_stored_names(spark):
    schema = "accession string, " + ", ".join(f"`{r}` string" for r in RANKS)
    base, lookup = (spark.createDataFrame([(k, *[k] * 7)], schema) for k in ("a", "b"))
    assert {r["accession"]: r["genus"] for r in vote.resolved_lineages(base, lookup).collect()} == {"a": "a", "b": "b"}


def test_a_key_in_two_batches_is_stored_once(spark, tmp_path):
    source, schema = str(tmp_path / "in"), "accession string, n int"
    stored = spark.createDataFrame([("old",)], "accession string")
    for i, keys in enumerate((["a", "old", "a"], ["a", "b"], ["b", "c"])):
        spark.createDataFrame([(k, i) for k in keys], schema).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
        arrivals.append_new(stream, stored, str(tmp_path / "out"), str(tmp_path / "ckpt")).awaitTermination()
    got = arrivals.stored_batches(spark, str(tmp_path / "out")).collect()
    assert sorted(r["accession"] for r in got) == ["a", "b", "c"]


def test_intermediate_tables_of_a_scope_are_removed(spark):
    from pathlib import Path

    from seqtide.session import application_dir, scratch
    before = materialise(spark.range(3), "outer")
    root = Path(application_dir(spark).removeprefix("file:"))
    with scratch(spark):
        inner = materialise(spark.range(5), "inner")
        assert inner.count() == 5 and list(root.glob("scope-*/inner-*"))
    assert not list(root.glob("scope-*")) and before.count() == 3


def counting(folder):
    class Counting:
        """Notes every preparation in a folder all workers share."""

        dimension, window = 2, 5

        def __init__(self, folder):
            self.folder = folder

        def prepare(self):
            import os
            import uuid
            open(f"{self.folder}/{os.getpid()}-{uuid.uuid4().hex}", "w").close()

        def encode(self, sequences):
            import numpy as np
            lengths = [len(s) for s in sequences]
            assert lengths == sorted(lengths)  # similar lengths go together
            return np.array([[n, len(sequences)] for n in lengths], np.float32)
    return Counting(folder)


def test_encoder_is_prepared_once_per_worker(spark, tmp_path):
    import os

    from seqtide.operators import encode
    records = spark.range(600).selectExpr("cast(id as string) accession", "repeat('A', cast(id % 100 as int)) sequence").repartition(24)
    model = counting(str(tmp_path))
    for _ in range(2):
        got = encode.encode_sequences(records, model, batch=16).collect()
    assert len(got) == 600 and all(r.embedding[0] == int(r.accession) % 100 for r in got)
    workers = [f.split("-")[0] for f in os.listdir(tmp_path)]
    assert len(workers) == len(set(workers)) < 48
    cut = encode.context_window(records, model).selectExpr("max(length(sequence))").first()[0]
    whole = encode.context_window(records, encode.KmerEncoder()).selectExpr("max(length(sequence))").first()[0]
    assert (cut, whole) == (5, 99)


def test_stream_state_survives_a_restart_on_disk(spark, tmp_path):
    import glob
    source, out, ckpt = (str(tmp_path / n) for n in ("in", "out", "ckpt"))
    for part in ([1, 2, 3, 2], [3, 4, 1, 5], [5, 6]):
        spark.createDataFrame([(str(i),) for i in part], "accession string").coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema("accession string").parquet(source)
        arrivals.append_to(arrivals.first_arrivals(stream), out, ckpt).awaitTermination()
    assert sorted(r.accession for r in spark.read.parquet(out).collect()) == ["1", "2", "3", "4", "5", "6"]
    offsets = [open(f).read() for f in glob.glob(f"{ckpt}/offsets/[0-9]*")]
    assert offsets and all("RocksDBStateStoreProvider" in o for o in offsets)
    assert "RocksDB" not in spark.conf.get("spark.sql.streaming.stateStore.providerClass")
