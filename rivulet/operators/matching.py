"""Greedy scored matching of payments to memberships, household by household."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.contracts import need
from rivulet.durable import discard, stored

_YEAR = 365 * 86400.0
#: Pairs of a payment and a membership up to which a household is matched in one task; a matrix of so many numbers fits there.
IN_A_TASK = 20_000_000


def _capacity(memberships: DataFrame) -> DataFrame:
    """value_amt: the largest of received-plus-value, recognised and start amounts; null if any is null."""
    parts = [F.col("memb_amt") + F.col("AVC_amt"), F.col("recog_amt"), F.col("start_amt")]
    known = parts[0].isNotNull() & parts[1].isNotNull() & parts[2].isNotNull()
    return memberships.withColumn("value_amt", F.when(known, F.greatest(*parts)))


def _rounds(values: np.ndarray, ids: np.ndarray, amounts: np.ndarray, got: np.ndarray, base: np.ndarray) -> np.ndarray:
    """got, the membership of each payment of a household (nan: none), after rounds until nothing more fits. base: what a pair
    scores besides its share of the free capacity."""
    place = {m: i for i, m in enumerate(ids.tolist())}
    while True:
        at = np.array([place.get(g, -1) for g in got.tolist()])
        filled = np.bincount(at[at >= 0], amounts[at >= 0], len(ids))
        room = values - filled
        free = np.isnan(got) & (amounts > 0)
        able = free[None, :] & (room[:, None] >= amounts[None, :]) & (room[:, None] != 0)
        with np.errstate(divide="ignore", invalid="ignore"):
            score = np.where(able, amounts[None, :] / room[:, None] + base, -np.inf)
        score[~(score > 0)] = -np.inf
        some = np.flatnonzero(score.max(1) > 0)
        if not len(some):
            return got
        # of equal scores the largest reference; of rival memberships the last
        best = score.shape[1] - 1 - score[some, ::-1].argmax(1)
        got[best] = ids[some]


def _matched(house: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """References and memberships of one household's payments, the columns as arrays."""
    of = lambda at: {k: x[at] for k, x in house.items()}
    once = lambda at: at[np.unique(house["no"][at], return_index=True)[1]]
    m = of(once(np.flatnonzero(house["is_membership"] & ~np.isnan(house["value_amt"]))))
    c = of(once(np.flatnonzero(~house["is_membership"])))
    got = c["matched"].copy()
    if not len(m["no"]) or not len(got):
        return c["no"], got
    gap = sum(np.abs(c[k][None, :] - m[k][:, None]) / 1e6 / _YEAR for k in ("made", "start"))
    same = (m["category"][:, None] == c["category"][None, :]) & (m["category"] != None)[:, None]  # noqa: E711  elementwise
    return c["no"], _rounds(m["value_amt"], m["no"], c["amount"], got, same - gap)


def _households(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Matches of rows sorted by household: many to a batch, the last of which may go on in the next."""
    held = None

    def solved(rows: pd.DataFrame) -> pd.DataFrame:
        house = rows["house"].to_numpy()
        cuts = np.flatnonzero(house[1:] != house[:-1]) + 1
        whole = {k: rows[k].to_numpy(np.float64, na_value=np.nan) for k in ("value_amt", "amount", "matched", "made", "start")}
        whole |= {"no": rows["no"].to_numpy(np.int64), "is_membership": rows["is_membership"].to_numpy(bool)}
        whole["category"] = rows["category"].astype(object).where(rows["category"].notna(), None).to_numpy(object)
        found = [_matched({k: x[i:j] for k, x in whole.items()}) for i, j in zip([0, *cuts], [*cuts, len(rows)])]
        return pd.DataFrame({"ref_no": np.concatenate([x for x, _ in found]), "match": np.concatenate([x for _, x in found])}).dropna()

    for batch in batches:
        rows = batch if held is None else pd.concat([held, batch], ignore_index=True)
        last = rows["house"].to_numpy() == rows["house"].iloc[-1] if len(rows) else np.zeros(0, bool)
        held = rows[last]
        if not last.all():
            yield solved(rows[~last])
    if held is not None and len(held):
        yield solved(held)


def _in_rounds(rows: DataFrame, spread: int) -> DataFrame:
    """ref_no, match of households of any size: the same rounds as joins of frames. A round meets every membership with the free
    payments of its household, dealt to `spread` parts each, keeps the best of each part, then of all; what payments take is stored."""
    key = ["house", "no"]
    first = lambda cond, *cols: rows.where(cond).groupBy(*key).agg(F.min(F.struct(*cols)).alias("x")).select(*key, "x.*")
    members = stored(first("is_membership and value_amt is not null", "value_amt", "made", "start", "category"), "match-members")
    pays = stored(first("not is_membership", "amount", "made", "start", "category", "matched").withColumnRenamed("matched", "got"), "match-payments")
    before = pays.where("got is not null").count()
    part = F.explode(F.sequence(F.lit(0), F.lit(spread - 1)))
    while True:
        taken = F.aggregate(F.array_sort(F.collect_list(F.struct("no", "amount"))), F.lit(0.0), lambda total, x: total + x["amount"])
        filled = pays.where("got is not null and amount is not null").groupBy("house", F.col("got").cast("long").alias("no")).agg(taken.alias("_filled"))
        room = members.join(filled, key, "left").withColumn("room", F.col("value_amt") - F.coalesce("_filled", F.lit(0.0))).where("room <> 0")
        m = room.select("house", part.alias("_part"), F.col("no").alias("m"), "room", F.col("made").alias("m_made"), F.col("start").alias("m_start"), F.col("category").alias("m_category"))
        free = pays.where("got is null and amount > 0").withColumn("_part", F.pmod(F.xxhash64("no"), F.lit(spread)).cast("int"))
        gap = F.abs(F.col("made") - F.col("m_made")) / 1e6 / _YEAR + F.abs(F.col("start") - F.col("m_start")) / 1e6 / _YEAR
        same = F.coalesce(F.col("category") == F.col("m_category"), F.lit(False)).cast("double")
        pairs = free.join(m, ["house", "_part"]).where("room >= amount").withColumn("score", F.col("amount") / F.col("room") + (same - gap)).where("score > 0")
        best = pairs.groupBy("house", "m", "_part").agg(F.max(F.struct("score", "no")).alias("b")).groupBy("house", "m").agg(F.max("b").alias("b"))
        chosen = best.groupBy("house", F.col("b.no").alias("no")).agg(F.max("m").alias("_m"))
        after = stored(pays.join(chosen, key, "left").select(*key, "amount", "made", "start", "category", F.coalesce("got", F.col("_m").cast("double")).alias("got")), "match-payments")
        discard(pays)
        pays, n = after, after.where("got is not null").count()
        if n == before:
            discard(members)
            return pays.where("got is not null").select(F.col("no").alias("ref_no"), F.col("got").alias("match"))
        before = n


def greedy_match(contributions: DataFrame, memberships: DataFrame, by: str = "group_customer_no", in_a_task: int = IN_A_TASK) -> DataFrame:
    """contributions with cust_memb_no set where a membership of the same household takes the payment.

    In each round every membership takes the unmatched payment of the highest score above 0 that still fits its
    capacity: share of the free capacity, plus 1 for the same campaign category, less the years between creation
    dates and between start and payment; of equal scores the largest reference. Rounds go on until nothing is taken. All
    work is within a household, of those with both sides: one shuffle and sort, and the loop runs where the household's rows are; many
    households share a batch. Those of more than `in_a_task` pairs are matched by joins, round by round, with the same result."""
    need(contributions, [by, "ref_no", "cont_amt", "cust_memb_no", "create_dt", "cont_dt", "campaign_category_desc"])
    need(memberships, [by, "cust_memb_no", "memb_amt", "AVC_amt", "recog_amt", "start_amt", "create_dt", "init_dt", "campaign_category_desc"])
    at = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    m = _capacity(memberships).select(F.col(by).alias("house"), F.lit(True).alias("is_membership"), F.col("cust_memb_no").cast("long").alias("no"), F.col("value_amt").cast("double").alias("value_amt"), F.lit(None).cast("double").alias("amount"), F.lit(None).cast("double").alias("matched"), at("create_dt").alias("made"), at("init_dt").alias("start"), F.col("campaign_category_desc").alias("category"))
    c = contributions.select(F.col(by).alias("house"), F.lit(False).alias("is_membership"), F.col("ref_no").cast("long").alias("no"), F.lit(None).cast("double").alias("value_amt"), F.col("cont_amt").cast("double").alias("amount"), F.col("cust_memb_no").cast("double").alias("matched"), at("create_dt").alias("made"), at("cont_dt").alias("start"), F.col("campaign_category_desc").alias("category"))
    rows = m.unionByName(c).where("house is not null and made is not null and start is not null")
    sizes = rows.groupBy("house").agg(F.count_if("is_membership").alias("_m"), F.count_if(~F.col("is_membership")).alias("_c")).where("_m > 0 and _c > 0")
    sized = rows.join(sizes, "house")
    large = F.col("_m").cast("double") * F.col("_c") > in_a_task
    small = sized.where(~large).drop("_m", "_c")
    found = small.repartition("house").sortWithinPartitions("house").mapInPandas(_households, "ref_no long, match double")
    if not sizes.where(large).isEmpty():
        spread = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        found = found.unionByName(_in_rounds(sized.where(large).drop("_m", "_c"), spread))
    kind = contributions.schema["cust_memb_no"].dataType
    found = found.select(F.col("ref_no").alias("_ref"), F.col("match").cast(kind).alias("_match"))
    out = contributions.join(found, F.col("ref_no") == F.col("_ref"), "left")
    return out.withColumn("cust_memb_no", F.coalesce("cust_memb_no", "_match")).drop("_ref", "_match")
