"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns, for every operator."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from rivulet.llm import chat, importance, lbl, mixing, pii, probminhash, quality_rules, spm, topk, toxicity
from rivulet.llm.queries import public_model

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"word{i % 977} a{i % 13}" for i in range(40_000))
CLASH = ["size", "u", "pref", "rank", "key", "root", "bucket", "words", "windows", "lines", "row", "target", "copies", "_spans", "_base", "_id", "_n", "label", "quality", "log_weight", "held_out", "kept"]


@pytest.fixture(scope="module")
def docs(spark):
    text = "the quick brown fox jumps over the lazy dog and writes to a.b@c.example.com again"
    rows = [
        (1, text, "en", "a", 5),
        (1, text, "en", "a", 5),
        (2, text, None, None, None),
        (None, text + " or not", "en", "b", 1),
        (None, None, None, None, None),
        (3, None, "en", "b", 0),
        (4, "", "en", "c", 0),
        (5, " \n\t ", "en", "c", 4),
        (6, LONG, "en", "c", len(LONG)),
        (7, "x" * 50_000, "en", "d", 50_000),
        (8, "\x00 é😀 ▁ \x85 z", "fr", "", 9),
    ]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (1, 0, 1), (2, 1, None), (3, None, 0), (None, 1, 1), (6, 1, 0), (7, 0, 1)], "doc_id long, quality int, toxic int")


def clashing(df):
    return df.withColumns({c: F.lit("x") for c in CLASH})


OPERATORS = {
    "mix": lambda d, l: mixing.mix(d),
    "pii": lambda d, l: pii.find(d),
    "toxicity": lambda d, l: toxicity.score(d, l),
    "rules": lambda d, l: quality_rules.judge(d),
    "importance": lambda d, l: importance.classify(d, l),
    "lbl": lambda d, l: lbl.score(d),
    "spm": lambda d, l: spm.digests(d, public_model()),
    "spm pieces": lambda d, l: spm.encode(d, public_model()),
    "near": lambda d, l: probminhash.classes(d),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_one_row_for_each_row(name, docs, labels):
    out = OPERATORS[name](clashing(docs), labels)
    rows = out.collect()
    key = lambda x: (x is not None, x or 0)
    assert sorted((r["doc_id"] for r in rows), key=key) == sorted((r["doc_id"] for r in docs.collect()), key=key)
    twice = [r for r in rows if r["doc_id"] == 1]
    assert twice[0] == twice[1]


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(name, docs, labels):
    assert OPERATORS[name](docs.limit(0), labels.limit(0)).count() == 0


@pytest.mark.parametrize("name", ["toxicity", "importance"])
def test_without_labels(name, docs, labels):
    assert OPERATORS[name](docs, labels.limit(0)).count() == docs.count()


def test_stages_keep_columns(docs, labels):
    for stage in (lambda d: importance.keep(d, labels), probminhash.keep_one, pii.redact, mixing.mixed):
        for df in (docs, docs.limit(0), clashing(docs)):
            out = stage(df)
            assert out.columns == df.columns
            assert {str(r) for r in out.drop("text", "n_chars").collect()} <= {str(r) for r in df.drop("text", "n_chars").collect()}
    assert probminhash.keep_one(docs).where("doc_id in (1, 2)").count() == 1


def test_search_edges(spark):
    rows = [(0, [0.5, 0.5]), (0, [0.5, 0.5]), (100, [1.0, 0.0]), (1, None), (2, [1.0, None]), (3, [float("nan"), 1.0]), (4, [float("inf"), 1.0]), (None, [1.0, 1.0]), (5, []), (6, [1.0, 0.0]), (7, [1.0, 0.0]), (8, [1.0, 2.0, 3.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumns({"rank": F.lit(1), "v": F.lit(1), "score": F.lit(0)})
    out = [tuple(r) for r in topk.search(df, F.col("vec_id") % 100 == 0, k=3).orderBy("query_id", "rank").collect()]
    assert out == [(0, 1, 6, 524288), (0, 2, 7, 524288), (0, 3, 100, 524288), (100, 1, 6, 1048576), (100, 2, 7, 1048576), (100, 3, 0, 524288)]
    assert topk.search(df.limit(0), F.col("vec_id") % 100 == 0).count() == 0


def test_search_by_dimension(spark):
    rows = [(0, [1.0, 0.0]), (1, [2.0, 1.0]), (100, [1.0, 1.0, 1.0]), (2, [3.0, 0.0, 1.0]), (200, []), (3, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    out = {tuple(r) for r in topk.search(df, F.col("vec_id") % 100 == 0).collect()}
    assert out == {(0, 1, 1, 2 * 2**20), (100, 1, 2, 4 * 2**20), (200, 1, 3, 0)}


def test_search_beyond_doubles(spark, monkeypatch):
    monkeypatch.setattr(topk, "CHUNK", 50)
    rng = np.random.default_rng(4)
    v = rng.integers(-(2**30), 2**30, (300, 6)) + rng.integers(-3, 4, (300, 6))
    df = spark.createDataFrame([(i, (x / 1024).tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<double>")
    got = {}
    for r in topk.search(df, F.col("vec_id") % 100 == 0).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    whole = [[int(y) for y in x] for x in v]
    for q in range(0, 300, 100):
        scores = sorted((-sum(a * b for a, b in zip(whole[q], whole[i])), i) for i in range(300) if i != q)[:10]
        assert got[q] == [(i, -s) for s, i in scores]


def test_search_overflow(spark):
    df = spark.createDataFrame([(0, [1e9]), (1, [1e9])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="does not fit 64 bits"):
        topk.search(df, F.col("vec_id") % 100 == 0).count()


def test_chat_edges(spark):
    rows = [(1, 1, "assistant", "b"), (1, 1, "assistant", "b"), (1, None, None, None), (None, 0, "user", "x"), (1, 0, "user", "a\nb")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns({"body": F.lit(1), "messages": F.lit(2), "formatted": F.lit(3)})
    made = chat.format_conversations(df.withColumn("content", chat.text_part(F.col("text"))))
    turns = {r["conv_id"]: [tuple(t) for t in r["t"]] for r in made.select("conv_id", chat.read_turns(F.col("formatted")).alias("t")).collect()}
    assert turns == {1: [("", ""), ("user", "a\nb"), ("assistant", "b"), ("assistant", "b")], None: [("user", "x")]}
    assert chat.digest(chat.format_conversations(df.limit(0).withColumn("content", chat.text_part(F.col("text"))))).count() == 0
