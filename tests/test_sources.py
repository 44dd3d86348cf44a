from pyspark.sql import functions as F

from seqtide import sinks
from seqtide.operators import quality
from seqtide.sources import fasta, lineages, manifest, metadata, vectors


def test_fasta_edges(spark, tmp_path):
    (tmp_path / "one.fasta").write_bytes(
        b"; junk line\nmore junk\n>A.1 first\r\nACGT\r\n\r\nAC>GT\r\n>\nTTTT\n>B.1\nGG  \nCC")
    (tmp_path / "deep").mkdir()
    (tmp_path / "deep" / "two.fna").write_bytes(b">C.1 |taxid|77| x > y\nAAAA\n")
    (tmp_path / "other.txt").write_text(">D.1\nAAAA\n")
    rows = {r["accession"]: r["sequence"] for r in fasta.read_fasta(spark, str(tmp_path)).collect()}
    assert rows == {"A.1": "ACGTAC>GT", "B.1": "GGCC", "C.1": "AAAA"}
    counts = fasta.rejected_records(spark, str(tmp_path / "one.fasta"), "*").collect()
    assert counts[0]["without_accession"] == 1


def test_fasta_split_over_tasks(spark, tmp_path):
    """A file read in many splits gives every record once."""
    body = "".join(f">R{i} x\n{'ACGT' * 30}\n{'GGTT' * 11}\n" for i in range(3000))
    (tmp_path / "big.fasta").write_text(body)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16384")
    try:
        records = fasta.read_fasta(spark, str(tmp_path))
        assert records.rdd.getNumPartitions() > 4
        assert records.agg(F.count("*"), F.countDistinct("accession"), F.sum(F.length("sequence"))).first() == (
            3000, 3000, 3000 * 164)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_metadata_edges(spark, tmp_path):
    (tmp_path / "m.jsonl").write_text(
        '{"accession": "A", "taxId": 1, "x": {"y": [1]}}\n\n{broken\n{"accession": "B", "taxId": null}\n'
        '{"taxId": 5}\n{"accession": "C", "taxId": 7}\n{"accession": "A", "taxId": 9}\n')
    meta = metadata.read_metadata(spark, str(tmp_path))
    got = {r["accession"]: r["taxid"] for r in metadata.taxid_map(meta).collect()}
    assert got == {"A": "9", "C": "7"}
    limited = metadata.taxid_map(meta, spark.createDataFrame([("C",)], "accession string"))
    assert [r["accession"] for r in limited.collect()] == ["C"]


def test_lineage_lines(spark):
    names = "\t".join(f" r{i} " for i in range(7))
    lines = [("1\ta\tb\tc\td\te\tf",), (f"2\t{names}",), (f"x3\t{names}",), (f"4\t{names}\tOK",), ("",)]
    got = lineages.parse_lineage_lines(spark.createDataFrame(lines, "value string")).collect()
    assert sorted(r["taxid"] for r in got) == ["2", "4"]
    assert got[0]["superkingdom"] == "r0" and got[0]["species"] == "r6"


def test_lineage_tsv_last_duplicate_wins(spark, tmp_path):
    rank = "\t".join("abcdefg")
    (tmp_path / "l.tsv").write_text(
        "accession\ttaxid\tsuperkingdom\tphylum\tclass\torder\tfamily\tgenus\tspecies\n"
        f"A\t1\t{rank}\nB\t2\t{rank}\nA\t3\t{rank[:-1]}\n")
    got = {r["accession"]: (r["taxid"], r["species"]) for r in lineages.read_lineage_tsv(spark, str(tmp_path)).collect()}
    assert got == {"A": ("3", ""), "B": ("2", "g")}


def test_manifest(spark, tmp_path):
    for n in "abc":
        (tmp_path / f"{n}.bin").write_text(n * 5)
    found = manifest.file_checksums(spark, str(tmp_path))
    listed = found.withColumn("md5", F.when(F.col("path").contains("b.bin"), "0").otherwise(F.col("md5"))).union(
        spark.createDataFrame([("gone", 0, "0")], found.schema))
    got = {r["path"].split("/")[-1]: r["status"] for r in manifest.audit(listed, found).collect()}
    assert got == {"a.bin": "ok", "b.bin": "corrupt", "c.bin": "ok", "gone": "missing"}


def test_vector_edges(spark):
    rows = [("a", [0.0, 0.0]), ("b", [float("nan"), 1.0]), ("c", [float("inf"), 1.0]), ("d", [1.0]), ("e", [3.0, 4.0]), ("f", None)]
    df = spark.createDataFrame(rows, "accession string, embedding array<double>")
    good, bad = vectors.split_usable(df, 2)
    assert sorted(r[0] for r in good.collect()) == ["a", "e"]
    assert sorted(r[0] for r in bad.collect()) == ["b", "c", "d", "f"]
    report = quality.embedding_report(df).first()
    assert (report["nan_values"], report["inf_values"], report["norm_max"]) == (1, 1, 5.0)


def test_zip_by_position(spark):
    ids = spark.createDataFrame([(f"k{i:03d}",) for i in range(200)], "accession string").repartition(7)
    vec = spark.createDataFrame([(i, [float(i)]) for i in range(200)], "i int, embedding array<double>").repartition(5)
    got = vectors.zip_by_position(ids, vec, ["accession"], ["i"]).collect()
    assert len(got) == 200 and all(r["accession"] == f"k{r['i']:03d}" for r in got)


def test_viewer_round_trip(spark, tmp_path):
    rows = [(f"A{i}", [float(i), i / 2, -1.0 * i] * 4, i % 3, i / 100) for i in range(100)]
    df = spark.createDataFrame(rows, "accession string, coords array<float>, cluster_label int, cluster_probability double")
    wide = sinks.viewer_table(df, 12)
    out = str(tmp_path / "v")
    sinks.write_viewer_table(wide.coalesce(1), out, 12, limit_bytes=sinks.row_bytes(12) * 30)
    assert len(list((tmp_path / "v").glob("*.parquet"))) == 4
    back = {r["accession"]: r["coords"] for r in sinks.from_viewer_table(spark.read.parquet(out)).collect()}
    assert back["A7"] == [7.0, 3.5, -7.0] * 4 and len(back) == 100
    assert wide.toArrow().num_rows == 100
