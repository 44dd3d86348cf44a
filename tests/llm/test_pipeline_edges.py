"""The pipeline over tables with nulls, repeats, extra columns and without rows."""

import corpus_pipeline

PROSE, OTHER, THIRD = (" ".join(f"{x}{i % 97} the of {i * n}" for i in range(90)) for n, x in enumerate(("word", "other", "third"), 1))
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key long, id string, mark long, ids binary, _0 string"


def run(spark, rows, folder):
    more = ("en", "s", 1, 2, "i", 3, None, "z")
    spark.createDataFrame([r + more for r in rows], SCHEMA).repartition(2).write.parquet(f"{folder}/documents.parquet")
    return corpus_pipeline.run(spark, str(folder))


def test_odd_rows(spark, tmp_path):
    rows = [(1, PROSE), (2, PROSE + " "), (2, PROSE + " "), (3, PROSE + " and one more end"), (4, OTHER), (4, OTHER), (5, None), (6, ""),
            (None, OTHER + " nameless"), (7, " "), (8, "x" * 20_000), (None, None), (4, THIRD)]
    found = run(spark, rows, tmp_path).collect()
    # of the copies of PROSE the longest text stays in exact dedup, and with its near copy the smallest id
    assert {r.doc_id for r in found} == {2, 4, None}
    starts = [(r.doc_id, r.doc_tokens) for r in found if r.start == 0]
    assert sorted(d for d, _ in starts if d is not None) == [2, 4, 4] and len(starts) == 4  # both texts of document 4, and the nameless one
    assert sum(r.length for r in found) == sum(n for _, n in starts)


def test_no_rows(spark, tmp_path):
    assert run(spark, [], tmp_path).count() == 0
