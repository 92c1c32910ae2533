"""Methods whose results SQL can't give, against plain versions of themselves."""

from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from rivulet.llm import importance, pii, toxicity
from rivulet.llm.probminhash import id_of, label, md5_of


def test_trees_as_expressions(spark):
    """The CASE expression gives what the fitted trees give."""
    models = pii.ensembles(spark)
    rng = np.random.default_rng(1)
    x = rng.integers(0, 20, (200, len(pii.FEATURES)))
    df = spark.createDataFrame([(i, tuple(map(int, r))) for i, r in enumerate(x)], f"i long, f struct<{','.join(f'{n}:int' for n in pii.FEATURES)}>")
    out = df.select("i", *(m.column(F.col("f")).alias(k) for k, m in models.items())).orderBy("i").collect()
    for k, m in models.items():
        want = 1 / (1 + np.exp(-(m.raw(x.astype(float)) * m.slope + m.offset)))
        assert [r[k] for r in out] == pytest.approx(want.tolist(), rel=1e-9)


def test_importance_weights(spark):
    rnd = random.Random(3)
    vocabulary = ["alpha", "Beta", "gamma", "delta", "eps"]
    texts = {i: " ".join(rnd.choices(vocabulary, k=rnd.randrange(0, 30))) for i in range(60)}
    quality = {i: i % 2 for i in range(0, 40)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame(list(quality.items()), "doc_id long, quality int")
    raw, target = Counter(), Counter()
    own = {i: Counter(importance.features(t.encode()).tolist()) for i, t in texts.items()}
    for i, c in own.items():
        raw.update(c)
        if quality.get(i) == 1:
            target.update(c)
    n, m, buckets = sum(raw.values()), sum(target.values()), importance.BUCKETS
    for r in importance.classify(docs, labels).collect():
        want = 0.0
        for f, k in own[r["doc_id"]].items():
            share = (raw[f] + 1e-9) / (n + buckets * 1e-9)
            want += k * math.log(((1 - importance.MIXED) * target[f] / m + importance.MIXED * share) / share)
        assert r["log_weight"] == pytest.approx(want, rel=1e-9, abs=1e-9)


def paths(word):
    """Every path of a word's lattice: (text, channel cost)."""
    if not word:
        return [("", 0.0)]
    c = word[0]
    run = len(word) - len(word.lstrip(c))
    letters = c if c in toxicity._CODE else toxicity.LOOKS.get(c, "")
    base = 0.0 if c in toxicity._CODE else toxicity.LOOK
    arcs = [(x * n, base * run + toxicity.REPEAT * (run - n)) for x in letters for n in {1, min(2, run), run}]
    if c not in toxicity._CODE:
        arcs.append(("", (toxicity.DROP if c in toxicity.LOOKS else toxicity.MARK) * run))
    return [(x + rest, cost + more) for x, cost in arcs for rest, more in paths(word[run:])]


def test_best_path():
    rng = np.random.default_rng(2)
    model = toxicity.CharModel(rng.integers(0, 9, toxicity._N**3).astype(float) ** 3)
    rnd = random.Random(5)
    for _ in range(150):
        word = "".join(rnd.choices("abios1@$0.-!", k=rnd.randrange(1, 8)))

        def cost(path):
            a = b = 0
            total = path[1]
            for y in [*(toxicity._CODE[c] for c in path[0]), 0]:
                total += model.cost[a][b][y]
                a, b = b, y
            return total

        found = model.decode(word)
        all_paths = paths(word)
        best = min(map(cost, all_paths))
        assert min(cost(p) for p in all_paths if p[0] == found) == pytest.approx(best)


def test_plain_words_the_short_way():
    model = toxicity.CharModel(np.random.default_rng(3).integers(0, 9, toxicity._N**3).astype(float) ** 3)
    rnd = random.Random(6)
    for _ in range(400):
        word = "".join(c * rnd.choice((1, 1, 1, 2, 3)) for c in rnd.choices("abeßü", k=rnd.randrange(1, 9)))
        short = model.spelled(word)
        assert short is None or short == model.decode(word)
    assert model.spelled("aabbccddee") is None


def test_scores_do_not_depend_on_partitions(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    a, b = (dict(map(tuple, toxicity.score(docs.repartition(n), labels).select("doc_id", "score").collect())) for n in (1, 7))
    assert a.keys() == b.keys() and all(a[k] == pytest.approx(b[k], abs=1e-9) for k in a)


def test_node_keys(spark):
    ids = [None, -(2**63), -5, -1, 0, 1, 255, 256, 2**63 - 1]
    df = spark.createDataFrame([(i, bytes([k]) * 16) for k, i in enumerate(ids)], "id long, md5 binary").withColumn("key", label(F.col("id"), F.col("md5")))
    rows = df.select("id", "md5", "key", id_of(F.col("key")).alias("id2"), md5_of(F.col("key")).alias("md52")).orderBy("key").collect()
    assert [r["id"] for r in rows] == [*ids[1:], None]
    assert all(r["id"] == r["id2"] and r["md5"] == r["md52"] for r in rows)
