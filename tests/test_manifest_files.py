"""A file per key, written by many tasks."""

import re

from seqtide import sinks
from seqtide.sources import manifest


def test_files_of_many_keys_are_written_by_many_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sinks, "FILES_PER_TASK", 5)
    rows = spark.createDataFrame([(i, f"text {i}") for i in range(60)] + [(7, "again")], "k long, value string").coalesce(1)
    sinks.write_file_per_key(rows, "k", f"{tmp_path}/files")
    found = manifest.file_checksums(spark, f"{tmp_path}/files", "*.txt").collect()
    assert sorted(int(re.search(r"k=(\d+)/", r["path"])[1]) for r in found) == list(range(60))
    assert len({re.search(r"part-(\d+)-", r["path"])[1] for r in found}) > 4  # tasks, where one wrote all files
    assert {r["length"] for r in found if "k=7/" in r["path"]} == {len("text 7\nagain\n")}
