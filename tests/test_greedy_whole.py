"""Greedy matching of every order, held against a plain matcher."""

from __future__ import annotations

import math
from collections import defaultdict
from datetime import timedelta

from pyspark.sql import functions as F

from rivulet.operators.matching import greedy_match
from rivulet.queries import QUERIES

DIR = "/root/testdata/sf0.001"
YEAR = timedelta(days=365)


def plain_match(pays, members):
    """{ref_no: cust_memb_no} of (ref_no, amount, day, category) and (cust_memb_no, value, day, category) of one household."""
    got = {}
    while True:
        wanted = {}
        for no, value, day, category in sorted(members):
            room = value - math.fsum(amount for ref, amount, _, _ in pays if got.get(ref) == no)
            best = None
            for ref, amount, when, kind in sorted(pays):
                if ref in got or amount <= 0 or amount > room or room == 0:
                    continue
                score = amount / room + (kind == category) - 2 * (abs(when - day) / YEAR)
                if score > 0 and (best is None or score >= best[0]):
                    best = score, ref
            if best:
                wanted[best[1]] = no  # of rival memberships the last
        if not wanted:
            return got
        got |= wanted


def test_every_order_as_a_plain_matcher(spark):
    homes = defaultdict(list)
    for r in spark.read.parquet(f"{DIR}/orders.parquet").collect():
        homes[r["o_custkey"]].append((r["o_orderkey"], float(r["o_totalprice"]), r["o_orderdate"], r["o_orderpriority"]))
    assert any(k % 4 for k in homes)
    want = {}
    for pays in homes.values():
        got = plain_match(pays, [p for p in pays if p[0] % 2 == 0])
        want |= {p[0]: got.get(p[0]) for p in pays}
    assert sum(x is not None for x in want.values()) > len(want) // 4
    found = QUERIES["greedy_matching"](spark, DIR).collect()
    assert len(found) == len(want)
    assert {r["ref_no"]: r["cust_memb_no"] for r in found} == want


def test_households_in_rounds_of_joins_as_in_tasks(spark):
    """Households of every size by joins of frames, and the largest alone: the same matches as in tasks. Ten customers are one household,
    a tenth of the orders have a membership already."""
    o = spark.read.parquet(f"{DIR}/orders.parquet").where("o_custkey < 60")
    home = F.when(F.col("o_custkey") < 30, F.lit(0)).otherwise(F.col("o_custkey")).alias("group_customer_no")
    pays = o.select(home, F.col("o_orderkey").alias("ref_no"), F.expr("CASE WHEN o_orderkey % 10 = 1 THEN o_orderkey + 1 END").alias("cust_memb_no"), F.col("o_totalprice").alias("cont_amt"), F.col("o_orderdate").alias("create_dt"), F.col("o_orderdate").alias("cont_dt"), F.expr("CASE WHEN o_orderkey % 3 > 0 THEN o_orderpriority END").alias("campaign_category_desc"))
    members = o.where("o_orderkey % 2 = 0").select(home, F.col("o_orderkey").alias("cust_memb_no"), (F.col("o_totalprice") * 2).alias("memb_amt"), F.lit(0.0).alias("AVC_amt"), F.col("o_totalprice").alias("recog_amt"), F.col("o_totalprice").alias("start_amt"), F.col("o_orderdate").alias("create_dt"), F.col("o_orderdate").alias("init_dt"), F.col("o_orderpriority").alias("campaign_category_desc"))
    tasks = {r["ref_no"]: r["cust_memb_no"] for r in greedy_match(pays, members).collect()}
    assert sum(x is not None for x in tasks.values()) > len(tasks) // 2
    for most in (0, 400):
        assert {r["ref_no"]: r["cust_memb_no"] for r in greedy_match(pays, members, in_a_task=most).collect()} == tasks
