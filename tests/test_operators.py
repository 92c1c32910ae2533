"""Temporal operators against closed forms and small hand-written tables."""

from __future__ import annotations

from datetime import datetime, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from rivulet.catalog import Catalog
from rivulet.contracts import check_stream
from rivulet.functions import text as X
from rivulet.operators import asof, audit, debounce, dedup, fill, matching, memo, nested, running, upsert, windows

D0 = datetime(2023, 1, 1)


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=str)


def test_fill(spark):
    df = spark.createDataFrame([(1, 1, None, "a"), (1, 2, 5, None), (1, 3, None, None), (2, 1, None, "b"), (2, 2, 7, None)], "g int, t int, v int, s string")
    assert rows(fill.fill_nulls(df, "locf", ["v", "s"], ["g"], ["t"]), "g", "t", "v", "s") == rows(spark.createDataFrame([(1, 1, None, "a"), (1, 2, 5, "a"), (1, 3, 5, "a"), (2, 1, None, "b"), (2, 2, 7, "b")], df.schema), "g", "t", "v", "s")
    assert [r["v"] for r in fill.fill_nulls(df, "nocb", ["v"], ["g"], ["t"]).orderBy("g", "t").collect()] == [5, 5, None, 7, 7]
    assert [r["v"] for r in fill.fill_nulls(df, "const", [2], value=0).orderBy("g", "t").collect()] == [0, 5, 0, 0, 7]
    with pytest.warns(UserWarning):
        fill.fill_nulls(df, "const", ["v"], by=["g"], value=0)
    with pytest.warns(UserWarning):
        fill.fill_nulls(df, "locf", ["v"], ["g"], ["t"], value=1)
    for bad in (lambda: fill.fill_nulls([1], "const"), lambda: fill.fill_nulls(df, "x"), lambda: fill.fill_nulls(df, "const", ["zz"]), lambda: fill.fill_nulls(df, "locf", ["v"], ["zz"], ["t"])):
        with pytest.raises((TypeError, ValueError)):
            bad()


def test_fill_is_one_shuffle(spark):
    df = spark.range(10).select(F.col("id").alias("t"), (F.col("id") % 3).alias("g"), F.lit(None).cast("int").alias("a"), F.lit(None).cast("int").alias("b"))
    plan = windows.window_features(fill.fill_nulls(df.withColumn("t", F.timestamp_seconds("t")), "locf", ["a", "b"], ["g"], ["t"]), ["a", "b"], (1, 7), ["g"], "t")
    assert plan._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1


def test_debounce_and_state(spark):
    df = spark.createDataFrame([("a", D0, 1), ("a", D0, 2), ("b", D0, 3), ("a", D0 + timedelta(1), 4)], "k string, timestamp timestamp_ntz, v int")
    assert rows(debounce.debounce(df, ["k", "timestamp"], ["v"]), "k", "v") == [("a", 2), ("a", 4), ("b", 3)]
    state = debounce.last_state(df, ["k"], D0 + timedelta(hours=1), tie=["v"], patterns=["^v$"])
    assert state.columns == ["k", "timestamp", "v"] and rows(state, "k", "v") == [("a", 2), ("b", 3)]
    assert debounce.last_state(df, ["k"], "1999-01-01").count() == 0
    with pytest.raises(TypeError):
        check_stream(df.withColumn("timestamp", F.lit(1)), "k")


def test_asof(spark):
    left = spark.createDataFrame([(1, 10), (1, 15), (1, 5), (2, 10), (None, 10), (1, None)], "k int, t int").withColumn("t", F.timestamp_seconds("t"))
    right = spark.createDataFrame([(1, 10, "a"), (1, 10, "b"), (1, 20, "c"), (None, 9, "n"), (1, None, "x")], "k int, t int, v string").withColumn("t", F.timestamp_seconds("t"))
    got = lambda how: {(r["k"], r["t"].timestamp() if r["t"] else None): r["v"] for r in asof.asof_join(left, right, ["k"], "t", "t", ["v"], how, ["v"]).collect()}
    assert got("backward") == {(1, 10): "b", (1, 15): "b", (1, 5): None, (2, 10): None, (None, 10): "n", (1, None): None}
    assert got("forward") == {(1, 10): "a", (1, 15): "c", (1, 5): "a", (2, 10): None, (None, 10): None, (1, None): None}
    assert got("nearest") == {(1, 10): "b", (1, 15): "b", (1, 5): "a", (2, 10): None, (None, 10): "n", (1, None): None}
    with pytest.raises(ValueError):
        got("sideways")


def test_windows_linear(spark):
    df = spark.createDataFrame([(g, D0 + timedelta(i), i + 1) for g in (1, 2) for i in range(100)], "group_customer_no int, timestamp timestamp_ntz, feature int")
    out = windows.window_features(df, ["feature"], (30, 1, 90), tie=["feature"]).where("group_customer_no = 1").orderBy("timestamp").collect()
    assert [r["feature.-1"] for r in out] == [None] + [1] * 99
    assert [r["feature.-30"] for r in out] == [None] * 30 + [29] * 70
    assert [r["feature.-90"] for r in out] == [None] * 90 + [60] * 10
    late = windows.window_features(df, ["feature"], (1,), since="2023-01-03", tie=["feature"])
    assert late.count() == 196 and late.where("`feature.-1` is null").count() == 0


def test_running(spark):
    df = spark.createDataFrame([(1, D0, 1, "a b", 5.0, 1), (1, D0, 2, "c", 7.0, 1), (1, D0 + timedelta(400), 3, "c", 1.0, 2), (1, D0 + timedelta(500), 4, "c", 1.0, 3), (1, D0 + timedelta(501), 5, "c", 1.0, 2)], "g int, t timestamp_ntz, n int, s string, v double, m int")
    out = running.category_features(df, "s", ["a b", "c"], ["g"], "t").orderBy("n").collect()
    assert [(r["a_b_count"], r["c_count"]) for r in out] == [(1, 1), (1, 1), (1, 2), (1, 3), (1, 4)]
    tot = running.running_totals(df, ["g"], ["t", "n"], "v", "t", "p").orderBy("n").collect()
    assert [r["p_amt"] for r in tot] == [5, 12, 13, 14, 15] and tot[1]["p_timestamp_last"] is None and tot[2]["p_timestamp_last"] == D0
    kinds = running.repeat_kind(df, ["g", "s"], ["t", "n"], "t", "m", "k").orderBy("n").collect()
    assert [r["k"] for r in kinds] == ["New", "New", "Reinstate", "Renew", "Upgrade"]
    assert running.categories(df, "s") == ["a b", "c"]


def test_audit(spark):
    base = spark.createDataFrame([(1, 10, 100, D0, "m", D0 + timedelta(9), "n", "A", "B"), (2, 20, 200, D0, "m", D0 + timedelta(9), "n", "P", None)], "id int, group_customer_no int, customer_no int, create_dt timestamp_ntz, created_by string, last_update_dt timestamp_ntz, last_updated_by string, a string, b string")
    log = spark.createDataFrame([("1", 10, 100, D0 + timedelta(1), "u", "Updated", "a", "a0", "a1"), ("1", 10, 100, D0 + timedelta(2), "u", "Updated", "b", "b0", None), ("1", 10, 100, D0 + timedelta(3), "u", "Inserted", "d", "d0", "d1"), ("x", 1, 1, D0, "u", "Updated", "a", "q", "r"), ("7", 70, 700, D0 + timedelta(1), "u", "Updated", "a", "z0", "z1")], "alternate_key string, group_customer_no int, customer_no int, date timestamp_ntz, userid string, action string, column_updated string, old_value string, new_value string")
    out = {(r["id"], r["timestamp"]): r for r in audit.reconstruct(log, base, "id", {"a": "a", "b": "b"}, logged=["d"]).collect()}
    state = lambda i, n: tuple(out[i, D0 + timedelta(n)][c] for c in ("event_subtype", "a", "b", "d"))
    assert state(1, 0) == ("Creation", "a0", "b0", "d1")
    assert state(1, 1) == ("Change", "a1", "b0", "d1") and state(1, 2) == ("Change", "a1", "", "d1") and state(1, 9) == ("Current", "A", "B", "d1")
    assert state(2, 0) == ("Creation", "P", None, None) and out[7, D0 + timedelta(1)]["customer_no"] == 700
    reg = spark.createDataFrame([("x", "t_x", "id"), ("y", "t_y", "a"), ("y", "t_y", "b")], "short_name string, base_table string, primary_keys string")
    assert audit.primary_key(reg, "x") == audit.primary_key(reg, "t_x") == ("t_x", "id")
    for bad in ("y", "zz"):
        with pytest.raises(ValueError):
            audit.primary_key(reg, bad)


def test_dedup(spark):
    df = spark.createDataFrame([(i, chr(97 + i % 26)) for i in range(1, 79)] + [(99, None)], "customer_no int, f string")
    pairs = dedup.adjacent_pairs(df, "customer_no", ["f"])
    assert rows(pairs, "customer_no", "`i.customer_no`") == sorted(((i + 26, i) for i in range(1, 53)), key=str)
    homes = spark.createDataFrame([(i, i if i > 30 else 1) for i in range(1, 79)], "customer_no int, group_customer_no int")
    known = spark.createDataFrame([(60, 34), (35, 61)], "customer_no int, associated_customer_no int")
    left = dedup.drop_related(pairs, homes, known)
    assert (27, 1) not in rows(left, "*") and (60, 34) not in rows(left, "*") and (61, 35) in rows(left, "*")
    assert (61, 35) not in rows(dedup.drop_related(pairs, homes, known, both_ways=True), "*")
    facts = spark.createDataFrame([(27, 1, 5), (1, 1, 7), (28, None, 1), (2, 3, None), (29, 2, 0), (3, 1, 9)], "customer_no int, a int, b int")
    out = {r["customer_no"]: tuple(r)[2:] for r in dedup.keep_delete(pairs, facts, [("a", "A"), ("b", "B")]).collect()}
    assert out[27] == (1, 27, "B") and out[28] == (None, None, None) and out[29] == (29, 3, "A")


def test_matching(spark):
    import random

    r = random.Random(4)
    members = [(r.randrange(20), i, float(a := r.randrange(1, 200) * 10), 0.0, a, a, D0 + timedelta(r.randrange(900)), f"c{r.randrange(9)}") for i in range(150)]
    pays = [(m[0], 1000 + m[1], None, m[2], m[6], m[6], m[7]) for m in members] + [(99, 5000, None, 10.0, D0, D0, "c1")]
    m = spark.createDataFrame([(g, i, a, v, float(x), float(y), t, t, c) for g, i, a, v, x, y, t, c in members], "group_customer_no int, cust_memb_no int, memb_amt double, AVC_amt double, recog_amt double, start_amt double, create_dt timestamp_ntz, init_dt timestamp_ntz, campaign_category_desc string")
    c = spark.createDataFrame(pays, "group_customer_no int, ref_no int, cust_memb_no int, cont_amt double, create_dt timestamp_ntz, cont_dt timestamp_ntz, campaign_category_desc string")
    out = matching.greedy_match(c, m).collect()
    assert len(out) == 151
    home, value = {x[1]: x[0] for x in members}, {x[1]: x[2] for x in members}
    held = {}
    for x in out:
        if x["cust_memb_no"] is not None:
            assert home[x["cust_memb_no"]] == x["group_customer_no"]
            held[x["cust_memb_no"]] = held.get(x["cust_memb_no"], 0) + x["cont_amt"]
    assert all(held[k] <= value[k] + 1e-9 for k in held)
    assert sum(x["cust_memb_no"] == x["ref_no"] - 1000 for x in out) >= 0.9 * 150


def test_memo(spark, tmp_path):
    catalog = Catalog(spark, str(tmp_path))
    seen = spark.sparkContext.accumulator(0)

    def work(keys: pd.DataFrame) -> pd.DataFrame:
        seen.add(len(keys))
        return pd.DataFrame({"y": [None if x is None else f"<{x}>" for x in keys["a"]]})

    df = spark.createDataFrame([("p", 1), ("q", 2), (None, 3), ("p", 4)], "a string, n int")
    run = lambda d: rows(memo.memoised(d, ["a"], work, "y string", catalog, "m", chunk=1), "n", "a", "y")
    assert run(df.where("n < 3")) == [(1, "p", "<p>"), (2, "q", "<q>")]
    first = seen.value
    assert run(df) == [(1, "p", "<p>"), (2, "q", "<q>"), (3, None, None), (4, "p", "<p>")]
    assert seen.value - first == 1
    assert run(df) and seen.value - first == 1
    assert run(df.limit(0)) == []


def test_nested(spark):
    df = spark.createDataFrame([(1, {"x": 1, "y": "b"}, {"k": "1"}, [1, 2]), (2, None, {"j": "2"}, []), (3, {"x": 3, "y": None}, {}, None)], "id int, s struct<x:int,y:string>, m map<string,string>, l array<int>")
    out = nested.widen_all(df)
    assert out.columns == ["id", "s.x", "s.y", "m.j", "m.k", "l.1", "l.2"]
    assert rows(out, *(f"`{c}`" for c in out.columns)) == [(1, 1, "b", None, "1", 1, 2), (2, None, None, "2", None, None, None), (3, 3, None, None, None, None, None)]
    one = spark.createDataFrame([(1, [5]), (2, [])], "id int, l array<int>")
    assert rows(nested.widen(one, "l"), "id", "l") == [(1, 5), (2, None)]
    pages = nested.combine_pages([{"a": spark.range(1)}, {"a": spark.range(1).withColumn("z", F.lit(1))}])
    assert pages["a"].count() == 2 and nested.combine_pages([{}]) is None
    assert nested.from_json_text(spark, spark.createDataFrame([('{"q": 1}',), ("no",)], "t string"), "t", "q int").collect()[0]["q"] == 1


def test_upsert(spark):
    t = spark.createDataFrame([(1, 1.0, "x"), (2, 2.0, "y")], "a int, b double, c string")
    n = spark.createDataFrame([(2, 5.0), (3, 6.0)], "a int, b double")
    assert rows(upsert.upsert(t, n, ["a"]), "a", "b", "c") == [(1, 1.0, "x"), (2, 5.0, "y"), (3, 6.0, None)]
    with pytest.warns(UserWarning):
        upsert.upsert(t, n.withColumn("zz", F.lit(1)), ["a"])
    with pytest.raises(ValueError):
        upsert.upsert(t, n, [])


def test_catalog(spark, tmp_path):
    c = Catalog(spark, str(tmp_path))
    assert not c.exists("t") and c.high_water("t", "d") is None
    with pytest.raises(FileNotFoundError):
        c.read("t")
    day = lambda *ds: spark.createDataFrame([(datetime(2023, 1, d), d) for d in ds], "d timestamp_ntz, v int")
    c.overwrite("t", day(1, 2, 3))
    c.replace_range("t", day(3, 4).withColumn("v", F.col("v") * 10), "d")
    assert rows(c.read("t"), "v") == [(1,), (2,), (30,), (40,)] and c.high_water("t", "v") == 40
    c.merge("t", day(4).withColumn("w", F.lit("new")), ["d"])
    assert sorted(r["v"] for r in c.read("t").collect()) == [1, 2, 4, 30] and "w" in c.read("t").columns
    assert c.copy("t", Catalog(spark, str(tmp_path / "shallow")), ["v"]).columns == ["v"]


def test_text(spark):
    import hashlib
    import hmac

    df = spark.createDataFrame([("  o'brien-smith  4TH ", "unknown"), ("12 None Such Rd", " web added "), ("", "Unknown"), ("x", None)], "a string, b string")
    out = df.select(X.clean(F.col("a")).alias("a"), X.clean(F.col("b")).alias("b"), X.slug(F.col("a")).alias("s"), X.anonymize(F.lit("7"), ("k", "q")).alias("h"), X.excel_time(F.lit("40000.5")).alias("t"), X.file_stem(F.lit("/x/y.z/in put.v1.xlsx")).alias("f"), X.separators(F.lit("a,b,,c")).alias("n"), X.repeated_word(F.lit("a b a")).alias("r"), X.epoch_time(F.lit("1600000000")).alias("e"), X.blank_to_null(F.lit(" ")).alias("z")).collect()
    assert out[0]["a"] == "O'Brien-Smith 4th" and [r["b"] for r in out] == [None, None, "Unknown", None] and [r["a"] for r in out[1:]] == ["12 None Such Rd", None, "X"]
    one = lambda k, m: hmac.new(k.encode(), m.encode(), hashlib.sha256).hexdigest()
    assert out[0]["h"] == one("q", one("k", "7") + "-7") and out[0]["t"] == datetime(2009, 7, 6, 12)
    assert (out[0]["f"], out[0]["n"], out[0]["r"], out[0]["z"]) == ("in put.v1", 3, True, None) and out[0]["e"] == datetime(2020, 9, 13, 12, 26, 40)
    u = X.unite(df, "a", ["a", "b"], "-", skip_null=True)
    assert u.columns == ["a"] and X.unite(df, "c", ["b"], remove=False).where("c = 'NA'").count() == 1


def test_catalog_late_and_crash(spark, tmp_path):
    from rivulet import catalog as module

    c = Catalog(spark, str(tmp_path))
    frame = lambda *days: spark.createDataFrame([(datetime(2020 + d // 10, 1, 1 + d % 10), d) for d in days], "t timestamp_ntz, d int").withColumn("year", F.year("t"))
    c.overwrite("x", frame(1, 5, 9), ["year"])
    assert rows(c.replace_range("x", frame(2), "t", ["year"]), "d") == [(1,), (2,), (5,), (9,)]
    c.replace_range("x", frame(11, 12), "t", ["year"])
    versions = len(list((tmp_path / "x").glob("*/year=2020")))
    assert {r["d"] for r in c.replace_range("x", frame(12, 15), "t", ["year"]).collect()} == {1, 2, 5, 9, 11, 12, 15}
    assert len(list((tmp_path / "x").glob("*/year=2020"))) == versions  # a year that isn't touched isn't written
    # a crash before the new state has its name leaves the old one
    real, module.Catalog._swap = module.Catalog._swap, lambda self, name, versions: (_ for _ in ()).throw(OSError("crash"))
    try:
        with pytest.raises(OSError):
            c.overwrite("x", frame(3), ["year"])
    finally:
        module.Catalog._swap = real
    assert c.read("x").count() == 7
    for k in range(module.VERSIONS + 1):
        c.replace_range("x", frame(30 + k % 10), "t", ["year"])
    assert c.versions("x") < module.VERSIONS and c.read("x").count() == 17


def test_memo_keeps_one_version(spark, tmp_path):
    c = Catalog(spark, str(tmp_path))
    work = lambda keys: keys[["a"]].rename(columns={"a": "y"}).astype(str)
    df = spark.createDataFrame([(1,), (2,)], "a int")
    for _ in range(3):
        memo.memoised(df, ["a"], work, "y string", c, "m").count()
    assert c.versions("m") == 1


def test_nearest_number(spark):
    left = spark.createDataFrame([(1, 5), (1, 8), (2, 5), (None, 1), (1, None)], "k int, n int")
    right = spark.createDataFrame([(1, 4, "a"), (1, 6, "b"), (1, 9, "c"), (None, 3, "d"), (1, None, "e")], "k int, m int, x string")
    out = asof.nearest_number(left, right, ["k"], "n", "m", ["m", "x"])
    assert rows(out, "k", "n", "m", "x") == sorted([(1, 5, 4, "a"), (1, 8, 9, "c"), (2, 5, None, None), (None, 1, 3, "d"), (1, None, None, None)], key=str)
