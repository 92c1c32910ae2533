"""Asking services, regions of many corners, and a paged service followed as a stream, against plain versions."""

from __future__ import annotations

import math
import random
import sys
from urllib.parse import parse_qs, urlparse

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rivulet.catalog import Catalog
from rivulet.operators.region import Region
from rivulet.plans import addresses
from rivulet.sources import rest
from rivulet.sources.geocoders import Pace, Service, cascade, one_by_one
from rivulet.streaming.incremental import follow_service


def plain_inside(lat, lon, rings):
    edges = [(a, b, c, d) for ring in rings for (a, b), (c, d) in zip(ring, [*ring[1:], ring[0]]) if a != c]
    return sum(min(a, c) <= lat < max(a, c) and lon < (lat - a) * ((d - b) / (c - a)) + b for a, b, c, d in edges) % 2 == 1


def star(n, lat, lon, size, rng):
    return [(lat + size * (0.5 + rng.random()) * math.sin(2 * math.pi * i / n), lon + size * (0.5 + rng.random()) * math.cos(2 * math.pi * i / n)) for i in range(n)]


@pytest.mark.parametrize("cells", [None, 1, 7])
def test_region_as_plain(spark, cells):
    rng = random.Random(8)
    rings = [star(700, 10, 20, 8, rng), star(40, 10, 20, 2, rng), star(5, 40, 60, 3, rng), [(30.0, 30.0), (30.0, 34.0), (34.0, 34.0), (34.0, 30.0)]]
    points = [(rng.uniform(-5, 50), rng.uniform(0, 70)) for _ in range(1500)] + [(lat + rng.gauss(0, 0.1), lon + rng.gauss(0, 0.1)) for ring in rings for lat, lon in ring]
    df = spark.createDataFrame(points, "lat double, lon double").withColumn("_cell", F.lit("clash"))
    got = {(r.lat, r.lon): r.inside for r in Region(rings, cells).with_inside(df.drop("_cell"), "lat", "lon").collect()}
    assert len(got) == len(points)
    assert {p: plain_inside(*p, rings) for p in got} == got
    odd = spark.createDataFrame([(None, 1.0), (float("nan"), 1.0), (float("inf"), 1.0), (1e9, 1.0)], "lat double, lon double")
    assert [r.inside for r in Region(rings).with_inside(odd, "lat", "lon").collect()] == [None, False, False, False]
    with pytest.raises(ValueError):
        Region([[(1.0, 1.0)]])


def test_pace():
    now, slept = [0.0], []

    def sleep(s):
        slept.append(s)
        now[0] += s

    pace = Pace(4, lambda: now[0], sleep)
    for _ in range(5):
        pace.wait()
        now[0] += 0.1
    assert now[0] == pytest.approx(1.1) and len(slept) == 4
    Pace(None, lambda: 0.0, sleep).wait()


def test_cascade_as_plain(spark):
    rows = [(i, f"a{i}" if i % 3 else None, f"b{i % 7}") for i in range(60)]
    rules = {"one": lambda q: q == "b3" or q.endswith("1"), "two": lambda q: q.startswith("a") and len(q) > 2, "three": lambda q: True}

    def broken(queries):
        raise OSError

    services = [Service("none", broken, batch=10, tries=1)] + [Service(n, one_by_one(lambda q, rule=rule: {"x": float(len(q))} if rule(q) else None), batch=4, tasks=2) for n, rule in rules.items()]
    df = spark.createDataFrame(rows, "i int, e0 string, e1 string")
    got = {r.i: (r.service, r["query"], r.x) for r in cascade(df, ["i"], ["e0", "e1"], services, StructType.fromDDL("x double"), "x").collect()}
    want = {}
    for i, *asked in rows:
        want[i] = next((n, q, float(len(q))) for n, rule in rules.items() for q in asked if q and rule(q))
    assert got == want


def test_answers_come_in_frames_of_the_queries():
    from rivulet.sources.geocoders import _asked

    service = Service("s", one_by_one(lambda q: {"x": 1.0} if q.endswith("1") else None))
    frames = list(_asked(iter([pd.DataFrame({"query": [f"q{i}" for i in range(500)]})]), service, ["x"], "x"))
    assert len(frames) == 1 and frames[0]["query"].tolist() == [f"q{i}" for i in range(1, 500, 10)]


def test_street_expressions(spark):
    names = "street1 string, street2 string, city string, state string, postal_code string, country string, `parsed.house_number` string, `parsed.road` string"
    rows = [
        ("30 street", "30 street", "Brooklyn", "NY", "11217", "USA", "30", "street"),
        ("1 A St", " ", "Town", None, None, None, None, None),
        (None, None, None, " ", None, None, None, None),
    ]
    df = spark.createDataFrame(rows, names)
    got = [tuple(r) for r in df.select(*addresses.street_expressions(df).values()).collect()]
    assert got == [("30 street, Brooklyn, NY, 11217, USA", None, None), ("Town", "1 A St, Town", None), (None, None, None)]


TABLE = [{"id": str(i), "name": f"n{i}", "updated": f"2024-01-01T00:{i // 60:02}:{i % 60:02}"} for i in range(250)]


def growing(method, url, key, body=None):
    q = {k: v[0] for k, v in parse_qs(urlparse(url).query).items()}
    rows = [r for r in TABLE[: int(q["shown"])] if r["updated"] > q.get("filters[updated_after]", "")]
    if any(k.startswith("orders") for k in q):
        rows = rows[::-1]
    at = int(q.get("offset", 0))
    return 200, {"things": rows[at : at + int(q["limit"])], "meta": {"total": str(len(rows))}}


def test_offsets_of_streams(spark):
    sys.modules.setdefault("tests.test_providers", sys.modules[__name__])
    schema = spark.createDataFrame([], "id string").schema
    options = {"url": "http://h/things?shown=230", "transport": "tests.test_providers:growing"}
    r = rest.GrowingReader(schema, options)
    assert (r.initialOffset(), r.latestOffset()) == ({"rows": 0}, {"rows": 230})
    pages = r.partitions({"rows": 120}, {"rows": 230})
    assert [x for p in pages for x in r.read(p)] == [(str(i),) for i in range(120, 230)]
    assert r.partitions({"rows": 230}, {"rows": 230}) == []
    c = rest.ChangedReader(schema, options | {"changed": "updated"})
    end = c.latestOffset()
    assert end == {"until": TABLE[229]["updated"]}
    pages = c.partitions({"until": TABLE[99]["updated"]}, {"until": TABLE[199]["updated"]})
    assert [x for p in pages for x in c.read(p)] == [(str(i),) for i in range(100, 200)]
    assert c.partitions(end, end) == []


def test_service_followed(spark, tmp_path):
    from rivulet.plan_queries import _service_at

    c = Catalog(spark, f"file://{tmp_path}/c")
    for shown, n in ((40, 40), (40, 40), (90, 90)):
        follow_service(spark, _service_at("/root/testdata/sf0.001", shown=shown), "id string, name string", c, "things", query=f"q{tmp_path.name}").awaitTermination()
        got = c.read("things")
        assert got.count() == n and got.select("id").distinct().count() == n


def test_runs_of_pages():
    """Many pages make no more partitions than `RUNS`; few are a partition each."""
    assert rest.runs(250, 30) == rest.offsets(250, 30) and rest.runs(0) == []
    some = rest.runs(5_400_030, 30)
    assert len(some) <= rest.RUNS and some[0][0] == 30 and sum(n for _, n in some) == 5_400_000
    assert all(a + n == b and n % rest.PAGE == 0 for (a, n), (b, _) in zip(some, some[1:]))


def test_stand_in_service_reads_blocks(spark, monkeypatch):
    """An answer reads the blocks of its rows alone, and times of change are found without going through the table."""
    from rivulet import plan_queries as q

    monkeypatch.setattr(q, "BLOCK", 10)
    table = q._things(spark, "/root/testdata/sf0.001", True, True)
    ask = lambda **o: q.table_service("GET", rest.paged_url(q._service_at("", table)["url"], **o), "")[1]
    q._block.cache_clear()
    first = ask(limit=10, offset=0)["things"]
    assert q._block.cache_info().misses == 1 and len(first) == 10 and int(ask(limit=1)["meta"]["total"]) == table["rows"] == 150
    late = ask(limit=100, offset=0, **{"filters[updated_after]": "2024-02-01"})
    assert all(int(r["id"]) % 3 == 0 and r["name"] == "new" for r in late["things"])
    assert int(late["meta"]["total"]) == len(late["things"]) == 50
    assert ask(limit=1, **{"orders[updated]": "DESC"})["things"] == late["things"][-1:]
