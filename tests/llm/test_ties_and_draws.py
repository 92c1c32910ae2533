"""Spans of one text by the thousand, rows that share a rank at the cut, how often the Gumbel draw takes what, and searches over
many tiles."""

from __future__ import annotations

import itertools
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from rivulet.llm import importance, mixing, pii, topk
from rivulet.llm.common import uniform


def test_many_spans_of_one_text(spark):
    part = [f"é mail u{i}@x.example.com from 10.1.2.{i % 256}" for i in range(1500)]
    text = " ".join(part)
    got = pii.find(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    spans = [s.split(":") for s in got["spans"].split(",")]
    want = [("email", m.start(), m.end()) for m in re.finditer(r"u[0-9]+@x\.example\.com", text)] + [("ip", m.start(), m.end()) for m in re.finditer(r"10\.1\.2\.[0-9]+", text)]
    assert [(k, int(s), int(e)) for k, s, e in spans] == want and got["n_added"] == 0
    redacted = pii.redact(spark.createDataFrame([(text, 0)], "text string, n_chars long")).first()
    assert redacted["text"] == " ".join(["é mail [EMAIL] from [IP]"] * 1500) and redacted["n_chars"] == len(redacted["text"])


def test_running_values_over_chunk_edges(spark):
    for n in (0, 1, pii.CHUNK - 1, pii.CHUNK, pii.CHUNK + 1, 5 * pii.CHUNK, 5 * pii.CHUNK + 3):
        x = [(i * 7919) % 23 for i in range(n)]
        row = spark.createDataFrame([(x,)], "x array<int>").select(pii._running(F.col("x"), lambda a, b: a + b).alias("sum"), pii._running(F.col("x"), lambda a, b: F.greatest(a, b)).alias("top")).first()
        assert row["sum"] == list(itertools.accumulate(x)) and row["top"] == list(itertools.accumulate(x, max))


@pytest.mark.parametrize("parts", [1, 4])
def test_a_part_of_equal_rows_is_taken(spark, parts):
    rows = [(7, "w " * 10, "a")] * 10 + [(100 + i, "z " * 10, "b") for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(parts)
    got = {r["source"]: r for r in mixing.mix(docs).groupBy("source").agg(F.max("target").alias("target"), F.sum("taken").alias("taken"), F.count("*").alias("n")).collect()}
    assert got["a"]["n"] == 10 and got["b"]["n"] == 30
    assert all(abs(r["taken"] - r["target"]) <= 5 for r in got.values())
    whole = {r["source"]: r["count"] * 10 for r in mixing.mixed(docs).groupBy("source").count().collect()}
    assert whole == {s: r["taken"] for s, r in got.items()}


def test_draw_follows_weights(spark):
    weights, k, times = (8.0, 4.0, 2.0, 1.0, 1.0), 2, 4000
    total = sum(weights)
    first = [w / total for w in weights]
    want = [p + sum(q * w / (total - v) for j, (q, v) in enumerate(zip(first, weights)) if j != i) for i, (p, w) in enumerate(zip(first, weights))]
    items = F.posexplode(F.array(*(F.lit(w) for w in weights)))
    df = spark.range(times).select("id", items.alias("i", "w")).withColumn("u", uniform(6, F.col("id"), F.col("i"))).withColumn("log_weight", F.log("w"))
    place = F.row_number().over(Window.partitionBy("id").orderBy(importance.noisy("log_weight", "u").desc()))
    got = {r["i"]: r["count"] / times for r in df.where("true").withColumn("place", place).where(F.col("place") <= k).groupBy("i").count().collect()}
    assert all(abs(got.get(i, 0) - p) < 0.03 for i, p in enumerate(want))


def test_share_asked_for(spark):
    docs = spark.createDataFrame([(i, f"word{i} other text {i % 5}", None, None, None) for i in range(40)], "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int")
    assert importance.classify(docs, labels, share=0.25).where("kept").count() == 10
    assert importance.keep(docs, labels, share=0.25).count() == 10
    assert importance.tempered(10.0, importance.TEMPERED * 2) == 5.0 and importance.tempered(10.0, 3) == 10.0


def test_search_many_tiles(spark, monkeypatch):
    monkeypatch.setattr(topk, "CHUNK", 40)
    monkeypatch.setattr(topk, "BLOCK", 9)
    monkeypatch.setattr(topk, "FLOATS", 300)  # of 12 components, 25 vectors; of 400, one
    rng = np.random.default_rng(5)
    v = [(rng.normal(size=n) * rng.lognormal(0, 1.5)).tolist() for n in rng.choice([12, 3, 400], 700, p=[0.9, 0.09, 0.01])]
    for i in range(300, 520):
        v[i] = v[300]  # a third of the rows are one vector
    df = spark.createDataFrame(list(enumerate(v)), "vec_id long, embedding array<double>")
    got = defaultdict(list)
    for r in topk.search(df, F.col("vec_id") % 20 == 0, k=5).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    w = [np.floor(1024 * np.array(x)).astype(np.int64) for x in v]
    for q in range(0, 700, 20):
        scores = sorted((-int(w[q] @ w[i]), i) for i in range(700) if i != q and len(w[i]) == len(w[q]))[:5]
        assert got[q] == [(i, -s) for s, i in scores]


def test_search_prunes_tiles(spark, monkeypatch):
    """Queries that long candidates satisfy aren't sent to the short ones."""
    monkeypatch.setattr(topk, "CHUNK", 50)
    sent = []
    meet = topk._meet
    monkeypatch.setattr(topk, "_meet", lambda candidates, routed, k, exact: sent.append(routed.count()) or meet(candidates, routed, k, exact))
    rng = np.random.default_rng(6)
    v = np.abs(rng.normal(size=(1000, 8))) + 1
    v[60:] *= 0.01
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<double>")
    assert topk.search(df, F.col("vec_id") % 100 == 0).count() == 100
    assert sent[0] == 10 and sent[1] <= 2 * 10  # of 20 tiles or so


def test_scaled_component_overflows(spark):
    df = spark.createDataFrame([(0, [1e308]), (1, [1.0])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="does not fit a double"):
        topk.search(df, F.col("vec_id") % 100 == 0).count()


def test_many_sources(spark):
    """Sources numbered range by range, and a level that many rounds lead to."""
    rng = np.random.default_rng(7)
    sizes = {f"s{i:04d}": int(x) for i, x in enumerate(np.minimum(rng.pareto(0.5, 2000) * 3, 500).astype(int))} | {None: 40}
    docs = spark.createDataFrame([(i, "w " * n, s) for i, (s, n) in enumerate(sizes.items())], "doc_id long, text string, source string")
    order = sorted((s for s in sizes if s is not None)) + [None]
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    target, free, left = {s: 0.0 for s in order}, [s for s in order if sizes[s]], sum(sizes.values())
    while True:
        level = left / sum(weight[s] for s in free)
        over = [s for s in free if level * weight[s] > 3 * sizes[s]]
        if not over:
            break
        for s in over:
            target[s] = 3.0 * sizes[s]
            left -= 3 * sizes[s]
        free = [s for s in free if s not in set(over)]
    target |= {s: level * weight[s] for s in free}
    got = {r["source"]: r["target"] for r in mixing.mix(docs).collect()}
    assert got == pytest.approx(target)


def test_level_of_nothing(spark):
    df = spark.createDataFrame([(1.0, 0, 0), (2.0, 0, 0)], "w double, c long, s long")
    assert mixing.water_level(df, "w", "c", "s") == 0 == mixing.water_level(df.limit(0), "w", "c", "s")
