from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from seqtide.config import DEMO, FULL, RANKS
from seqtide.operators import encode, vote
from seqtide.operators.ledger import Ledger
from seqtide.plans import surveillance, views
from seqtide.session import shared_dir
from seqtide.sinks import write_fasta


def ballots(spark, rows):
    """rows: query, rn, name used at every rank."""
    return spark.createDataFrame([(q, rn, *([name] * 7)) for q, rn, name in rows],
                                 "query_id string, rn int, " + ", ".join(f"`{r}` string" for r in RANKS))


def test_vote_edges(spark):
    rows = [("tie", 2, "b"), ("tie", 1, "a"), ("tie", 3, "b"), ("tie", 4, "a"), ("none", 1, ""), ("none", 2, None),
            ("one", 1, "z"), ("gap", 1, ""), ("gap", 2, "y"), ("gap", 3, "x"), ("gap", 4, "x")]
    got = {r["query_id"]: r for r in vote.vote(ballots(spark, rows)).collect()}
    assert tuple(got["tie"]["genus"]) == ("a", 0.5)
    assert tuple(got["none"]["genus"]) == ("Unknown", 0.0)
    assert tuple(got["one"]["genus"]) == ("z", 1.0)
    assert tuple(got["gap"]["genus"]) == ("x", 0.6667) and got["gap"]["n_neighbours"] == 4


def ruled(spark, family, genus, probability):
    row = [(1, ("F", family), ("G", genus), ("S", genus), probability)]
    one = "struct<name:string,confidence:double>"
    df = spark.createDataFrame(row, f"query_id int, family {one}, genus {one}, species {one}, cluster_probability double")
    r = vote.ambiguous_rule(vote.family_rule(df)).first()
    return tuple(r["genus"]), tuple(r["species"]), r["is_ambiguous_clade"]


@pytest.mark.parametrize("family,genus,probability,want", [
    (0.95, 0.49, 0.85, (("Unknown", 0.49), ("Unknown", 0.0), False)),
    (0.95, 0.5, 0.85, (("G", 0.5), ("S", 0.5), False)),
    (0.94, 0.2, 0.9, (("G", 0.2), ("S", 0.2), False)),
    (1.0, 0.2, 0.84, (("Unknown (ambiguous clade)", 0.0), ("Unknown (ambiguous clade)", 0.0), True))])
def test_rules(spark, family, genus, probability, want):
    assert ruled(spark, family, genus, probability) == want


def test_adjusted_rand_of_equal_labelings(spark):
    df = spark.range(100).selectExpr("id % 4 as a", "10 - id % 4 as b")
    assert vote.adjusted_rand(df, "a", "b").first()[0] == 1.0


def test_ledger_skips_finished_stages(spark, tmp_path):
    book, calls = Ledger(spark, str(tmp_path / "l")), []

    def build():
        calls.append(1)
        return spark.range(5)
    for _ in range(2):
        assert book.stage("s", str(tmp_path / "s"), build).count() == 5
    book.stage("s", str(tmp_path / "s"), build, force=True)
    assert len(calls) == 2
    book.stage("s", str(tmp_path / "s"), build, fingerprint="other")
    book.stage("s", str(tmp_path / "s"), build)  # the stored table is the other's
    assert len(calls) == 4


def test_encoder_is_pluggable(spark):
    class Length:
        dimension = 2

        def prepare(self):
            self.ready = 1.0

        def encode(self, sequences):
            assert len(sequences) <= 3
            return np.array([[len(s), self.ready] for s in sequences])
    df = spark.createDataFrame([(f"s{i}", "A" * i) for i in range(10)], "accession string, sequence string")
    got = {r["accession"]: r["embedding"] for r in encode.encode_sequences(df, Length(), batch=3).collect()}
    assert got["s7"] == [7.0, 1.0] and len(got) == 10


def test_profiles():
    assert FULL.cells == 8192 and DEMO.cells == 512 and DEMO.family_floor == FULL.family_floor


class Remote:
    """Stands for a session on a cluster."""

    class conf:
        @staticmethod
        def get(key, default=None):
            return Remote.folder if key == "spark.checkpoint.dir" else default

    class sparkContext:
        master = "spark://host:7077"

        @staticmethod
        def getCheckpointDir():
            return None


def test_shared_dir_follows_the_session(spark):
    Remote.folder = "hdfs:///shared/"
    assert shared_dir(Remote) == "hdfs:///shared"
    Remote.folder = None
    with pytest.raises(RuntimeError):
        shared_dir(Remote)


def test_whole_run(spark, tmp_path):
    sf = "/root/testdata/sf0.001"
    fasta, meta = str(tmp_path / "fasta"), str(tmp_path / "meta")
    seqs = views.seqs(spark, sf)
    write_fasta(seqs, fasta)
    seqs.select("accession", (F.col("doc_id") + 100001).alias("taxId")).write.json(meta)
    inputs = surveillance.Inputs(fasta, meta, views.tree(spark, sf), pattern="*.txt")
    profile = replace(DEMO, cells=12, min_cluster_size=5, probes=4, levels=8, layout_neighbours=8, layout_dims=3)
    out = str(tmp_path / "out")
    first = surveillance.run(spark, inputs, out, encode.KmerEncoder(32, 4), profile, epochs=1)
    n = first.count()
    assert n > 100 and first.where("taxonomy.superkingdom.name <> 'Unknown'").count() > 0
    again = surveillance.run(spark, inputs, out, encode.KmerEncoder(32, 4), profile, epochs=1)
    assert again.count() == n
    assert spark.read.json(f"{out}/assignments_json").count() == n
    rows = Ledger(spark, f"{out}/ledger").rows()
    stages = rows.where("metric = 'elapsed_s'")
    assert stages.count() == stages.select("stage").distinct().count()
    assert spark.read.parquet(f"{out}/vectors").count() == n == spark.read.parquet(f"{out}/viewer").count() + rows.where(
        "metric = 'n_unusable'").agg(F.max("value")).first()[0]
    # another encoder builds anew, the first table is not taken for its own
    other = surveillance.fingerprint(spark, inputs, encode.KmerEncoder(16, 4), profile, True, 1)
    assert other != surveillance.fingerprint(spark, inputs, encode.KmerEncoder(32, 4), profile, True, 1)
    assert not Ledger(spark, f"{out}/ledger").done("vectors", f"{out}/vectors", other)
