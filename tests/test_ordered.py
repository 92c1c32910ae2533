"""Numbering, chunks, fills and as-of joins along an order, against plain versions."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from rivulet.catalog import Catalog
from rivulet.operators.asof import asof_join
from rivulet.operators.fill import fill_nulls
from rivulet.operators.ordered import chunk_bounds, fill_spread, numbered, order_statistics, ranged, with_chunk
from rivulet.plans import unified


def test_numbers_are_whole_and_follow_the_order(spark):
    rng = random.Random(1)
    rows = [(rng.choice([None, 1, 2, 3]), rng.randrange(10), "x") for _ in range(500)] + [(2, 5, "copy")] * 700
    df = spark.createDataFrame(rows, "a int, b int, c string").repartition(5)
    out = numbered(df, ["a", "b"], start=40, ranges=6).orderBy("rowid").collect()
    assert [r.rowid for r in out] == list(range(41, 41 + len(rows)))
    keys = [((r.a is not None, r.a or 0), r.b) for r in out]
    assert keys == sorted(keys)
    assert sorted(((r.a or 0), r.b, r.c) for r in out) == sorted(((a or 0), b, c) for a, b, c in rows)
    again = numbered(df.repartition(3), ["a", "b"], start=40, ranges=4).orderBy("rowid").collect()
    assert [tuple(r) for r in again] == [tuple(r) for r in out]
    assert numbered(df.limit(0), ["a"]).collect() == []


def test_copies_are_split_over_ranges(spark):
    df = spark.createDataFrame([(1, "same")] * 4000, "a int, b string").repartition(4)
    sizes = [r["count"] for r in ranged(df, ["a"], 8).groupBy(F.shiftright("_at", 33)).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 1000


def test_order_statistics(spark):
    rng = random.Random(2)
    for values in (
        [rng.randrange(-(10**15), 10**15) for _ in range(3000)],
        [rng.choice([5, 5, 5, 6, 10**12]) for _ in range(1000)],
        [7] * 50,
        [-(2**61), 0, 2**61],
    ):
        df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v long")
        places = [1, 2, 3, len(values) // 2, len(values) - 1, len(values), len(values) + 1, 0]
        want = sorted(values)
        assert order_statistics(df, "v", places) == [want[p - 1] if 1 <= p <= len(want) else None for p in places]
    assert order_statistics(df.limit(0), "v", [1]) == [None]


def test_chunks_keep_ties_together(spark):
    rng = random.Random(3)
    seconds = [rng.randrange(400) for _ in range(900)] + [77] * 350
    df = spark.createDataFrame([(s,) for s in seconds], "s long").withColumn("t", F.timestamp_seconds("s"))
    df = df.unionByName(spark.createDataFrame([(None,)], "s long").withColumn("t", F.lit(None).cast("timestamp")))
    for size in (1, 7, 100, 1250, 5000):
        bounds = chunk_bounds(df, "t", size)
        order = sorted(seconds)
        ends = [order[min(i + size, len(order)) - 1] for i in range(0, len(order), size)]
        assert bounds == [e * 1_000_000 for e in ends]
        for r in with_chunk(df, "t", bounds).distinct().collect():
            assert r.partition == (None if r.s is None else next(i for i, e in enumerate(ends, 1) if e >= r.s))
    late = with_chunk(spark.sql("SELECT timestamp_seconds(100000) AS t"), "t", bounds).first()
    assert late.partition == len(bounds) + 1
    assert chunk_bounds(df.limit(0), "t", 5) == [] and with_chunk(df.limit(3), "t", []).where("partition = 1").count() == 3


def test_fill_spread_as_a_window(spark):
    rng = random.Random(4)
    rows = [(rng.choice([None, "a", "b", "hot", "hot", "hot"]), i, rng.choice([None, None, None, i]), rng.choice([None, None, f"s{i}"])) for i in range(800)]
    rows += [("lone", i, None, None) for i in range(200)]
    df = spark.createDataFrame(rows, "g string, i int, x int, y string").repartition(4)
    for by in (["g"], []):
        for kind in ("locf", "nocb"):
            now, want = {}, {}
            for g, i, x, y in rows if kind == "locf" else reversed(rows):
                key = g if by else 0
                old = now.get(key, (None, None))
                now[key] = want[g, i] = (old[0] if x is None else x, old[1] if y is None else y)
            for ranges in (1, 3, 16):
                got = fill_spread(df, kind, ["x", "y"], by, ["i"] if by else [F.coalesce("g", F.lit("")) == "lone", "i"], ranges)
                assert got.columns == df.columns
                assert {(r.g, r.i): (r.x, r.y) for r in got.collect()} == want
    assert fill_spread(df.limit(0), "locf", ["x"], [], ["i"]).collect() == []


def test_no_single_partition(spark):
    df = spark.range(1000).select("id", F.when(F.col("id") % 7 == 0, F.col("id")).alias("x"))
    for out in (fill_nulls(df, "locf", ["x"], order_by=["id"]), numbered(df, ["id"])):
        assert "SinglePartition" not in out._jdf.queryExecution().executedPlan().toString()


def test_spread_asof_as_plain(spark):
    rng = random.Random(5)
    key = lambda: rng.choice([None, None, 1, 2])
    left = spark.createDataFrame([(key(), rng.randrange(300) if rng.random() > 0.02 else None, i) for i in range(400)], "k int, t long, i int").withColumn("t", F.timestamp_seconds("t"))
    right = spark.createDataFrame([(key(), rng.randrange(300), i) for i in range(300)], "k int, u long, v int").withColumn("u", F.timestamp_seconds("u"))
    for direction in ("backward", "forward", "nearest"):
        a, b = (sorted(map(str, asof_join(left, right, ["k"], "t", "u", ["v", "u"], direction, ["v"], spread=s).collect())) for s in (False, True))
        assert a == b


def test_rowid_and_partition_over_increments(spark, tmp_path):
    rows = spark.range(100).select((F.col("id") % 3).alias("group_customer_no"), F.timestamp_seconds(F.col("id") * 3600).alias("timestamp"), "id")
    c = Catalog(spark, f"file://{tmp_path}/c")
    for n in (30, 31, 70, 100):
        c.overwrite("s", rows.where(F.col("id") < n))
        out = unified.stream(c, ["s"], tie=["id"], chunk_size=9)
    got = out.orderBy("id").collect()
    assert [r.rowid for r in got] == list(range(1, 101))
    assert [r.partition for r in got] == [i // 9 + 1 for i in range(100)]


def test_frames_end_at_their_row(spark):
    """A frame from a row to the last is gone through anew for each row; turned round it grows by one."""
    df = spark.range(400).selectExpr("id", "id % 3 as k", "case when id % 7 = 0 then id end as v")
    want = [(i, next((j for j in range(i, 400, 3) if j % 7 == 0), None)) for i in range(400)]
    for order in (["id"], [F.col("id")]):
        for spread in (False, True):
            out = fill_nulls(df, "nocb", ["v"], ["k"], order, spread=spread)
            assert out.columns == df.columns and sorted((r.id, r.v) for r in out.collect()) == want
            assert "unboundedfollowing" not in out._jdf.queryExecution().executedPlan().toString()
    for spread in (False, True):
        out = asof_join(df.select("k", "id"), df.where("v is not null").select("k", "v"), ["k"], "id", "v", ["v"], "forward", spread=spread)
        assert sorted((r.id, r.v) for r in out.collect()) == want
        assert "unboundedfollowing" not in out._jdf.queryExecution().executedPlan().toString()


def test_chunks_are_searched_by_halves(spark):
    """No row is compared with the bounds one by one, nor with the ends of blocks of them."""
    bounds = [-5, 0, 7, 7_000_000]
    df = spark.createDataFrame([(-6,), (-5,), (0,), (1,), (8,), (7_000_001,), (None,)], "u long").select("u", F.timestamp_micros("u").alias("t"))
    out = with_chunk(df, "t", bounds)
    assert {r.u: r.partition for r in out.collect()} == {-6: 1, -5: 1, 0: 2, 1: 3, 8: 4, 7_000_001: 5, None: None}
    assert "filter(" not in out._jdf.queryExecution().optimizedPlan().toString()
