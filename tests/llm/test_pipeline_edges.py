"""The whole pipeline over odd tables."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P

TEXT = "the quick brown fox jumps over the lazy dog and writes to a.b@c.example.com again and again until it is done"


def tables(spark, at, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.withColumns({"size": F.lit("x"), "_id": F.lit(1), "root": F.lit("y")}).write.parquet(f"{at}/documents.parquet")
    return str(at)


ROWS = [
    (1, TEXT, "en", "a", 5), (1, TEXT, "en", "a", 5), (2, TEXT, None, None, None), (None, TEXT + " or not", "en", "b", 1), (None, None, None, None, None),
    (3, None, "en", "b", 0), (4, "", "en", "c", 0), (5, " \n\t ", "en", "c", 4), (6, "word " * 30_000, "en", "c", 150_000),
]


@pytest.mark.parametrize("rows", [ROWS, []], ids=["odd", "empty"])
@pytest.mark.parametrize("labelled", [True, False], ids=["labels", "no labels"])
def test_run(spark, tmp_path, rows, labelled):
    at = tables(spark, tmp_path, rows)
    labels = [(1, 1, 0), (6, 0, 0), (2, None, None), (None, 1, 1)] if labelled else []
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    out = P.run(spark, at)
    assert out.columns[:4] == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    got = out.collect()
    assert {r["doc_id"] for r in got} <= {r[0] for r in rows}
    assert bool(got) == bool(rows)
    if rows and not labelled:  # all pass the classifier; 1 and 2 are copies
        assert {1, 6} <= {r["doc_id"] for r in got} and 2 not in {r["doc_id"] for r in got}
