"""Queries of the customer-event operators over the standard tables, and SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.functions.text import anonymize, clean, collapse, repeated_word, slug, title_case, unite
from rivulet.operators.asof import asof_join, nearest_number
from rivulet.operators.audit import reconstruct, reconstruct_open
from rivulet.operators.debounce import debounce, last_state
from rivulet.operators.dedup import adjacent_pairs, drop_related, keep_delete
from rivulet.operators.fill import fill_nulls
from rivulet.operators.matching import greedy_match
from rivulet.operators.nested import widen
from rivulet.operators.running import category_features, previous_other, repeat_kind, running_counts, running_totals
from rivulet.operators.upsert import upsert
from rivulet.operators.windows import window_features
from rivulet.plans import census, contributions, email, marketing, surveys, unified

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

EVENT_TYPES = ("click", "error", "purchase", "signup", "view")
PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def _spent(spark: SparkSession, d: str) -> DataFrame:
    return _t(spark, d, "events").select("event_id", "user_id", "ts", "event_type", F.expr("CASE WHEN event_type = 'purchase' THEN value END").alias("amount"))


_SPENT = "SELECT event_id, user_id, ts, event_type, CASE WHEN event_type = 'purchase' THEN value END AS amount FROM events"


@query(f"SELECT event_id, coalesce(amount, 0.0) AS amount FROM ({_SPENT})")
def fill_const(spark: SparkSession, d: str) -> DataFrame:
    return fill_nulls(_spent(spark, d), "const", ["amount"], value=0.0).select("event_id", "amount")


@query(f"SELECT event_id, last_value(amount IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS amount FROM ({_SPENT})")
def fill_locf(spark: SparkSession, d: str) -> DataFrame:
    return fill_nulls(_spent(spark, d), "locf", ["amount"], ["user_id"], ["ts", "event_id"]).select("event_id", "amount")


@query(f"SELECT event_id, first_value(amount IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS amount FROM ({_SPENT})")
def fill_nocb(spark: SparkSession, d: str) -> DataFrame:
    return fill_nulls(_spent(spark, d), "nocb", ["amount"], ["user_id"], ["ts", "event_id"]).select("event_id", "amount")


@query(f"SELECT event_id, last_value(amount IGNORE NULLS) OVER (ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS amount, first_value(event_type IGNORE NULLS) OVER (ORDER BY ts, event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS event_type FROM (SELECT event_id, ts, amount, CASE WHEN amount IS NULL THEN NULL ELSE event_type END AS event_type FROM ({_SPENT}))")
def fill_ungrouped(spark: SparkSession, d: str) -> DataFrame:
    """All rows as one group: filled along ranges of the order, no task sees all."""
    df = _spent(spark, d).withColumn("event_type", F.when(F.col("amount").isNotNull(), F.col("event_type")))
    df = fill_nulls(df, "locf", ["amount"], order_by=["ts", "event_id"])
    return fill_nulls(df, "nocb", ["event_type"], order_by=["ts", "event_id"]).select("event_id", "amount", "event_type")


@query(f"SELECT event_id, last_value(amount IGNORE NULLS) OVER (PARTITION BY k ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS amount FROM (SELECT *, CASE WHEN event_id % 2 = 0 THEN user_id END AS k FROM ({_SPENT}))")
def fill_skewed(spark: SparkSession, d: str) -> DataFrame:
    """Half of the rows lie in the group of those without a user."""
    df = _spent(spark, d).withColumn("k", F.when(F.col("event_id") % 2 == 0, F.col("user_id")))
    return fill_nulls(df, "locf", ["amount"], ["k"], ["ts", "event_id"], spread=True).select("event_id", "amount")


@query("SELECT event_id, user_id, CAST(day AS VARCHAR) AS day, value FROM (SELECT *, CAST(ts AS DATE) AS day, row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts DESC, event_id DESC) AS n FROM events) WHERE n = 1")
def debounce_daily(spark: SparkSession, d: str) -> DataFrame:
    df = _t(spark, d, "events").withColumn("day", F.to_date("ts"))
    return debounce(df, ["user_id", "day"], ["ts", "event_id"]).select("event_id", "user_id", F.col("day").cast("string").alias("day"), "value")


@query("SELECT user_id, ts, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n FROM events WHERE ts < TIMESTAMP '2024-01-15') WHERE n = 1")
def customer_history(spark: SparkSession, d: str) -> DataFrame:
    return last_state(_t(spark, d, "events"), ["user_id"], "2024-01-15", "ts", ["event_id"], ["^event_type$", "^value$"])


def _running(spark: SparkSession, d: str) -> DataFrame:
    w = "OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    return _t(spark, d, "events").select("event_id", "user_id", "ts", F.expr(f"count(*) {w}").alias("seen"), F.expr(f"sum(cast(round(value * 100) as bigint)) {w}").alias("cents"))


_LOOKBACK = """
WITH r AS (
  SELECT event_id, user_id, ts, count(*) OVER w AS seen, CAST(sum(CAST(round(value * 100) AS BIGINT)) OVER w AS BIGINT) AS cents
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
), h AS (SELECT user_id, ts, seen, cents FROM (SELECT *, row_number() OVER (PARTITION BY user_id, ts ORDER BY event_id DESC) AS n FROM r) WHERE n = 1)
, a AS (
  SELECT r.*, r.seen - x.seen AS s1, r.seen - y.seen AS s7, r.seen - z.seen AS s14, r.cents - x.cents AS c1, r.cents - y.cents AS c7, r.cents - z.cents AS c14
  FROM r ASOF LEFT JOIN h x ON r.user_id = x.user_id AND r.ts - INTERVAL 1 DAY >= x.ts
  ASOF LEFT JOIN h y ON r.user_id = y.user_id AND r.ts - INTERVAL 7 DAY >= y.ts
  ASOF LEFT JOIN h z ON r.user_id = z.user_id AND r.ts - INTERVAL 14 DAY >= z.ts
)
SELECT event_id, user_id, ts, seen, cents, s1 AS seen_1, s7 - s1 AS seen_7, s14 - s7 AS seen_14, c1 AS cents_1, c7 - c1 AS cents_7, c14 - c7 AS cents_14 FROM a
"""


@query(_LOOKBACK)
def window_features_1_7_14(spark: SparkSession, d: str) -> DataFrame:
    return window_features(_running(spark, d), ["seen", "cents"], (7, 1, 14), ["user_id"], "ts", ["event_id"], name="{col}_{days}")


QUERIES["window_features"] = QUERIES.pop("window_features_1_7_14")
SQL["window_features"] = SQL.pop("window_features_1_7_14")


def _views(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    e = _t(spark, d, "events")
    return e.where("event_type = 'purchase'").select("event_id", "user_id", "ts"), e.where("event_type = 'view'").select(F.col("event_id").alias("view_id"), "user_id", F.col("ts").alias("view_ts"))


def _asof(direction: str) -> Query:
    def run(spark: SparkSession, d: str) -> DataFrame:
        left, right = _views(spark, d)
        return asof_join(left, right, ["user_id"], "ts", "view_ts", ["view_id", "view_ts"], direction, ["view_id"])

    return run


_VIEWS = "WITH p AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'purchase'), v AS (SELECT event_id AS view_id, user_id, ts AS view_ts FROM events WHERE event_type = 'view')"
def _asof_skewed(direction: str) -> Query:
    def run(spark: SparkSession, d: str) -> DataFrame:
        """Half of the rows have one key, null: no task holds them all."""
        e = _t(spark, d, "events").withColumn("k", F.when(F.col("event_id") % 4 < 2, F.col("user_id")))
        left = e.where("event_type = 'purchase'").select("event_id", "k", "ts")
        right = e.where("event_type = 'view'").select("k", F.col("event_id").alias("view_id"), F.col("ts").alias("view_ts"))
        return asof_join(left, right, ["k"], "ts", "view_ts", ["view_id", "view_ts"], direction, ["view_id"], spread=True)

    return run


QUERIES["asof_skewed"], QUERIES["asof_skewed_nearest"] = _asof_skewed("backward"), _asof_skewed("nearest")
_HALF = "WITH e AS (SELECT *, CASE WHEN event_id % 4 < 2 THEN user_id ELSE -1 END AS k FROM events), p AS (SELECT * FROM e WHERE event_type = 'purchase'), v AS (SELECT k, ts AS view_ts, {pick}(event_id) AS view_id FROM e WHERE event_type = 'view' GROUP BY k, ts)"
SQL["asof_skewed"] = _HALF.format(pick="max") + " SELECT p.event_id, nullif(p.k, -1) AS k, p.ts, v.view_id, v.view_ts FROM p ASOF LEFT JOIN v ON p.k = v.k AND p.ts >= v.view_ts"
SQL["asof_skewed_nearest"] = _HALF.format(pick="max") + """, w AS (SELECT k, ts AS view_ts, min(event_id) AS view_id FROM e WHERE event_type = 'view' GROUP BY k, ts), b AS (SELECT p.event_id, v.view_id, v.view_ts FROM p ASOF JOIN v ON p.k = v.k AND p.ts >= v.view_ts), f AS (SELECT p.event_id, w.view_id, w.view_ts FROM p ASOF JOIN w ON p.k = w.k AND p.ts <= w.view_ts)
SELECT p.event_id, nullif(p.k, -1) AS k, p.ts, CASE WHEN f.view_ts IS NULL OR p.ts - b.view_ts <= f.view_ts - p.ts THEN b.view_id ELSE f.view_id END AS view_id, CASE WHEN f.view_ts IS NULL OR p.ts - b.view_ts <= f.view_ts - p.ts THEN b.view_ts ELSE f.view_ts END AS view_ts
FROM p LEFT JOIN b ON p.event_id = b.event_id LEFT JOIN f ON p.event_id = f.event_id"""
QUERIES["asof_backward"], QUERIES["asof_forward"], QUERIES["asof_nearest"] = _asof("backward"), _asof("forward"), _asof("nearest")
SQL["asof_backward"] = f"{_VIEWS} SELECT p.event_id, p.user_id, p.ts, v.view_id, v.view_ts FROM p ASOF LEFT JOIN v ON p.user_id = v.user_id AND p.ts >= v.view_ts"
SQL["asof_forward"] = f"{_VIEWS} SELECT p.event_id, p.user_id, p.ts, v.view_id, v.view_ts FROM p ASOF LEFT JOIN v ON p.user_id = v.user_id AND p.ts <= v.view_ts"
SQL["asof_nearest"] = f"""{_VIEWS}
SELECT event_id, user_id, ts, view_id, view_ts FROM (
  SELECT p.event_id, p.user_id, p.ts, v.view_id, v.view_ts, row_number() OVER (PARTITION BY p.event_id ORDER BY abs(epoch_us(p.ts) - epoch_us(v.view_ts)) NULLS LAST, v.view_ts, v.view_id DESC) AS n
  FROM p LEFT JOIN v ON p.user_id = v.user_id
) WHERE n = 1"""


def _slugs(template: str, values: tuple[str, ...]) -> str:
    return ", ".join(template.format(v=v, s=v.lower().replace(" ", "_")) for v in values)


@query(
    "SELECT event_id, "
    + _slugs("min(CASE WHEN event_type = '{v}' THEN ts END) OVER w AS {s}_timestamp_min, max(CASE WHEN event_type = '{v}' THEN ts END) OVER w AS {s}_timestamp_max, count(CASE WHEN event_type = '{v}' THEN ts END) OVER w AS {s}_count", EVENT_TYPES)
    + " FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
)
def subtype_features(spark: SparkSession, d: str) -> DataFrame:
    df = category_features(_t(spark, d, "events"), "event_type", EVENT_TYPES, ["user_id"], "ts")
    return df.drop("user_id", "ts", "event_type", "value", "props")


@query("""
SELECT user_id AS group_customer_no, ts AS "timestamp", event_id, CAST(NULL AS BIGINT) AS o_orderkey, 'events' AS stream, epoch_us(ts) AS timestamp_id,
  last_value(value IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS amount
FROM events WHERE user_id NOT IN (SELECT o_custkey FROM orders)
UNION ALL
SELECT group_customer_no, "timestamp", event_id, o_orderkey, stream, timestamp_id, last_value(amount IGNORE NULLS) OVER (PARTITION BY group_customer_no ORDER BY "timestamp", stream, event_id NULLS FIRST, o_orderkey NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
FROM (
  SELECT user_id AS group_customer_no, ts AS "timestamp", event_id, CAST(NULL AS BIGINT) AS o_orderkey, value AS amount, 'events' AS stream, epoch_us(ts) AS timestamp_id FROM events WHERE user_id IN (SELECT o_custkey FROM orders)
  UNION ALL SELECT o_custkey, o_orderdate, NULL, o_orderkey, NULL, 'orders', epoch_us(o_orderdate) FROM orders
)
""")
def union_streams(spark: SparkSession, d: str) -> DataFrame:
    events = _t(spark, d, "events").select(F.col("user_id").alias("group_customer_no"), F.col("ts").alias("timestamp"), "event_id", F.col("value").alias("amount"))
    orders = _t(spark, d, "orders").select(F.col("o_custkey").alias("group_customer_no"), F.col("o_orderdate").alias("timestamp"), "o_orderkey")
    rows = unified.united({"events": events, "orders": orders})
    return unified.enriched(rows, ["^amount$"], tie=["stream", "event_id", "o_orderkey"])


def _payments(spark: SparkSession, d: str) -> DataFrame:
    return _t(spark, d, "orders").select(F.col("o_custkey").alias("group_customer_no"), F.col("o_orderkey").alias("ref_no"), F.col("o_orderdate").alias("cont_dt"), F.expr("cast(round(o_totalprice * 100) as bigint)").alias("cont_amt"), "o_orderpriority")


_PAID = "SELECT o_custkey AS group_customer_no, o_orderkey AS ref_no, o_orderdate AS cont_dt, CAST(round(o_totalprice * 100) AS BIGINT) AS cont_amt, o_orderpriority FROM orders"


@query(
    f"""SELECT group_customer_no, ref_no, CAST(sum(cont_amt) OVER w AS BIGINT) AS contribution_amt, max(cont_amt) OVER w AS contribution_max, min(cont_dt) OVER (PARTITION BY group_customer_no) AS contribution_timestamp_min,
  max(cont_dt) OVER (PARTITION BY group_customer_no ORDER BY cont_dt RANGE BETWEEN UNBOUNDED PRECEDING AND INTERVAL 1 MICROSECOND PRECEDING) AS contribution_timestamp_last, """
    + _slugs("CAST(sum(CASE WHEN o_orderpriority = '{v}' THEN 1 ELSE 0 END) OVER w AS BIGINT) AS \"contribution_{s}_count\"", PRIORITIES)
    + f" FROM ({_PAID}) WINDOW w AS (PARTITION BY group_customer_no ORDER BY cont_dt, ref_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
)
def contribution_features(spark: SparkSession, d: str) -> DataFrame:
    df = running_totals(_payments(spark, d), ["group_customer_no"], ["cont_dt", "ref_no"], "cont_amt", "cont_dt", "contribution")
    df = running_counts(df, ["group_customer_no"], ["cont_dt", "ref_no"], "o_orderpriority", PRIORITIES, "contribution")
    return df.drop("cont_dt", "cont_amt", "o_orderpriority")


@query(f"""SELECT ref_no, CASE WHEN row_number() OVER w = 1 THEN 'New' WHEN row_number() OVER (PARTITION BY group_customer_no, o_orderpriority, month(cont_dt) ORDER BY cont_dt, ref_no) > 1 THEN 'Upgrade'
  WHEN epoch_us(cont_dt) - epoch_us(lag(cont_dt) OVER w) <= 365 * 86400000000 THEN 'Renew' ELSE 'Reinstate' END AS event_subtype2 FROM ({_PAID}) WINDOW w AS (PARTITION BY group_customer_no, o_orderpriority ORDER BY cont_dt, ref_no)""")
def contribution_subtype2(spark: SparkSession, d: str) -> DataFrame:
    df = _payments(spark, d).withColumn("campaign", F.month("cont_dt"))
    return repeat_kind(df, ["group_customer_no", "o_orderpriority"], ["cont_dt", "ref_no"], "cont_dt", "campaign", "event_subtype2").select("ref_no", "event_subtype2")


@query(f"SELECT ref_no, max(cont_dt) OVER (PARTITION BY group_customer_no ORDER BY cont_dt RANGE BETWEEN UNBOUNDED PRECEDING AND INTERVAL 1 MICROSECOND PRECEDING) AS before FROM ({_PAID})")
def distinct_date_lag(spark: SparkSession, d: str) -> DataFrame:
    return previous_other(_payments(spark, d), "cont_dt", ["group_customer_no"], "before").select("ref_no", "before")


def _log(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    e = _t(spark, d, "events").where("event_type in ('click', 'view')")
    log = e.select(F.col("user_id").cast("string").alias("alternate_key"), F.col("ts").alias("date"), F.lit("u").alias("userid"), F.lit("Updated").alias("action"), F.col("event_type").alias("column_updated"), F.expr("cast(cast(round(value * 100) as bigint) as string)").alias("new_value"), F.expr("cast(event_id as string)").alias("old_value"))
    base = _t(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.lit("2023-01-01").cast("timestamp_ntz").alias("create_dt"), F.lit("m").alias("created_by"), F.lit("2025-01-01").cast("timestamp_ntz").alias("last_update_dt"), F.lit("n").alias("last_updated_by"), F.col("c_name").alias("click"), F.col("c_mktsegment").alias("view"))
    return log, base


@query("""
WITH log AS (SELECT user_id AS id, ts, event_type AS col, CAST(CAST(round(value * 100) AS BIGINT) AS VARCHAR) AS nv, CAST(event_id AS VARCHAR) AS ov FROM events WHERE event_type IN ('click', 'view')),
b AS (SELECT c_custkey AS id, c_name AS click, c_mktsegment AS view FROM customer),
made AS (
  SELECT b.id, TIMESTAMP '2023-01-01' AS "timestamp", 'm' AS last_updated_by, 0 AS r, c.ov AS click, v.ov AS view FROM b
  LEFT JOIN (SELECT id, ov FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY ts, ov) AS n FROM log WHERE col = 'click') WHERE n = 1) c ON b.id = c.id
  LEFT JOIN (SELECT id, ov FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY ts, ov) AS n FROM log WHERE col = 'view') WHERE n = 1) v ON b.id = v.id
), rows_ AS (
  SELECT * FROM made
  UNION ALL SELECT id, ts, 'u', 1, CASE WHEN col = 'click' THEN nv END, CASE WHEN col = 'view' THEN nv END FROM log
  UNION ALL SELECT id, TIMESTAMP '2025-01-01', 'n', 2, click, view FROM b
), f AS (
  SELECT id, "timestamp", last_updated_by, r,
    coalesce(last_value(click IGNORE NULLS) OVER bk, first_value(click IGNORE NULLS) OVER ah) AS click,
    coalesce(last_value(view IGNORE NULLS) OVER bk, first_value(view IGNORE NULLS) OVER ah) AS view
  FROM rows_ WINDOW bk AS (PARTITION BY id ORDER BY r, "timestamp", last_updated_by, click NULLS FIRST, view NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
    ah AS (PARTITION BY id ORDER BY r, "timestamp", last_updated_by, click NULLS FIRST, view NULLS FIRST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
)
SELECT id, "timestamp", CASE r WHEN 0 THEN 'Creation' WHEN 1 THEN 'Change' ELSE 'Current' END AS event_subtype, last_updated_by, click, view
FROM (SELECT *, row_number() OVER (PARTITION BY id, "timestamp" ORDER BY r DESC, last_updated_by DESC, click DESC NULLS LAST, view DESC NULLS LAST) AS n FROM f) WHERE n = 1
""")
def audit_reconstruct(spark: SparkSession, d: str) -> DataFrame:
    log, base = _log(spark, d)
    return reconstruct(log, base, "id", {"click": "click", "view": "view"})


_each = lambda template: ", ".join(template.format(n=n) for n in EVENT_TYPES)


@query(f"""WITH log AS (SELECT user_id AS id, ts, event_type AS col, CAST(CAST(round(value * 100) AS BIGINT) AS VARCHAR) AS nv, CAST(event_id AS VARCHAR) AS ov FROM events),
k AS (SELECT id, {_each("arg_min(ov, (ts, ov)) FILTER (col = '{n}') AS {n}")} FROM log GROUP BY id),
r AS (SELECT c_custkey AS id, TIMESTAMP '2023-01-01' AS t, 'm' AS made_by, 0 AS r, {_each("{n}")} FROM customer LEFT JOIN k ON c_custkey = id
  UNION ALL SELECT id, ts, 'u', 1, {_each("max(nv) FILTER (col = '{n}')")} FROM log GROUP BY id, ts
  UNION ALL SELECT c_custkey, TIMESTAMP '2025-01-01', 'n', 2, c_name, NULL, NULL, NULL, c_mktsegment FROM customer),
f AS (SELECT id, t, made_by, r, {_each("coalesce(last_value({n} IGNORE NULLS) OVER bk, first_value({n} IGNORE NULLS) OVER ah) AS {n}")} FROM r
  WINDOW bk AS (PARTITION BY id ORDER BY r, t ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), ah AS (PARTITION BY id ORDER BY r, t ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
SELECT id, t AS "timestamp", CASE r WHEN 0 THEN 'Creation' WHEN 1 THEN 'Change' ELSE 'Current' END AS event_subtype, made_by AS last_updated_by, concat_ws(';', {_each("'{n}=' || {n}")}) AS state
FROM (SELECT *, row_number() OVER (PARTITION BY id, t ORDER BY r DESC) AS n FROM f) WHERE n = 1""")
def audit_open(spark: SparkSession, d: str) -> DataFrame:
    """A log of names that nobody has listed: two are columns of the table, the others appear by themselves."""
    _, base = _log(spark, d)
    log = _t(spark, d, "events").select(F.col("user_id").cast("string").alias("alternate_key"), F.col("ts").alias("date"), F.lit("u").alias("userid"), F.lit("Updated").alias("action"), F.col("event_type").alias("column_updated"), F.expr("cast(cast(round(value * 100) as bigint) as string)").alias("new_value"), F.expr("cast(event_id as string)").alias("old_value"))
    out = reconstruct_open(log, base, "id", {"click": "click", "view": "view"})
    said = F.transform(F.array_sort(F.map_entries("state")), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return out.withColumn("state", F.array_join(said, ";"))


def _pairs(spark: SparkSession, d: str) -> DataFrame:
    return adjacent_pairs(_t(spark, d, "customer").withColumnRenamed("c_custkey", "customer_no"), "customer_no", ["c_nationkey", "c_mktsegment"])


_PAIRS = 'SELECT c_custkey AS customer_no, lag(c_custkey) OVER (PARTITION BY c_nationkey, c_mktsegment ORDER BY c_custkey) AS "i.customer_no" FROM customer'


@query(f'SELECT * FROM ({_PAIRS}) WHERE "i.customer_no" IS NOT NULL')
def exact_duplicates(spark: SparkSession, d: str) -> DataFrame:
    return _pairs(spark, d)


@query("SELECT doc_id, before AS \"i.doc_id\" FROM (SELECT doc_id, lag(doc_id) OVER (PARTITION BY text ORDER BY doc_id) AS before FROM documents WHERE text IS NOT NULL) WHERE before IS NOT NULL")
def exact_text_pairs(spark: SparkSession, d: str) -> DataFrame:
    return adjacent_pairs(_t(spark, d, "documents"), "doc_id", ["text"])


@query(f"""WITH p AS (SELECT * FROM ({_PAIRS}) WHERE "i.customer_no" IS NOT NULL)
SELECT * FROM p WHERE customer_no % 7 <> "i.customer_no" % 7 AND NOT (customer_no % 5 = 0 AND "i.customer_no" = customer_no - 1)""")
def suppress_related(spark: SparkSession, d: str) -> DataFrame:
    c = _t(spark, d, "customer").select(F.col("c_custkey").alias("customer_no"))
    homes = c.withColumn("group_customer_no", F.col("customer_no") % 7)
    known = c.where("customer_no % 5 = 0").withColumn("associated_customer_no", F.col("customer_no") - 1)
    return drop_related(_pairs(spark, d), homes, known)


@query(f"""WITH p AS (SELECT * FROM ({_PAIRS}) WHERE "i.customer_no" IS NOT NULL)
SELECT p.*, CASE WHEN l.n <> r.n THEN CASE WHEN l.n > r.n THEN customer_no ELSE "i.customer_no" END WHEN l.b > r.b THEN customer_no WHEN l.b < r.b THEN "i.customer_no" END AS keep_customer_no,
  CASE WHEN l.n <> r.n THEN CASE WHEN l.n < r.n THEN customer_no ELSE "i.customer_no" END WHEN l.b < r.b THEN customer_no WHEN l.b > r.b THEN "i.customer_no" END AS delete_customer_no,
  CASE WHEN l.n <> r.n THEN 'orders' WHEN l.b <> r.b THEN 'balance' END AS keep_reason
FROM p LEFT JOIN (SELECT c_custkey, c_acctbal AS b, (SELECT count(*) FROM orders WHERE o_custkey = c_custkey) AS n FROM customer) l ON p.customer_no = l.c_custkey
LEFT JOIN (SELECT c_custkey, c_acctbal AS b, (SELECT count(*) FROM orders WHERE o_custkey = c_custkey) AS n FROM customer) r ON p."i.customer_no" = r.c_custkey""")
def keep_delete_pairs(spark: SparkSession, d: str) -> DataFrame:
    n = _t(spark, d, "orders").groupBy(F.col("o_custkey").alias("customer_no")).agg(F.count("*").alias("n"))
    facts = _t(spark, d, "customer").select(F.col("c_custkey").alias("customer_no"), "c_acctbal").join(n, "customer_no", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    return keep_delete(_pairs(spark, d), facts, [("n", "orders"), ("c_acctbal", "balance")])


@query()
def greedy_matching(spark: SparkSession, d: str) -> DataFrame:
    o = _t(spark, d, "orders")
    pays = o.select(F.col("o_custkey").alias("group_customer_no"), F.col("o_orderkey").alias("ref_no"), F.lit(None).cast("long").alias("cust_memb_no"), F.col("o_totalprice").alias("cont_amt"), F.col("o_orderdate").alias("create_dt"), F.col("o_orderdate").alias("cont_dt"), F.col("o_orderpriority").alias("campaign_category_desc"))
    members = o.where("o_orderkey % 2 = 0").select(F.col("o_custkey").alias("group_customer_no"), F.col("o_orderkey").alias("cust_memb_no"), F.col("o_totalprice").alias("memb_amt"), F.lit(0.0).alias("AVC_amt"), F.col("o_totalprice").alias("recog_amt"), F.col("o_totalprice").alias("start_amt"), F.col("o_orderdate").alias("create_dt"), F.col("o_orderdate").alias("init_dt"), F.col("o_orderpriority").alias("campaign_category_desc"))
    return greedy_match(pays, members).select("ref_no", "cust_memb_no")


@query("""
WITH b AS (SELECT lower(trim(s_name)) AS email, s_suppkey AS subscriberid, s_nationkey AS customer_no FROM supplier
  UNION ALL SELECT lower(n_name), NULL, n_nationkey FROM nation UNION ALL SELECT lower(s_name), NULL, (s_nationkey + 1) % 25 FROM supplier),
m AS (SELECT email, customer_no, max(subscriberid) OVER (PARTITION BY email) AS subscriberid FROM b)
SELECT DISTINCT m.email, CAST(m.customer_no AS INTEGER) AS customer_no, m.subscriberid, CAST(n_regionkey AS INTEGER) AS group_customer_no FROM m JOIN nation ON m.customer_no = n_nationkey WHERE m.subscriberid IS NOT NULL
""")
def email_map(spark: SparkSession, d: str) -> DataFrame:
    s, n = _t(spark, d, "supplier"), _t(spark, d, "nation")
    contacts = s.select(F.col("s_suppkey").cast("string").alias("id"), F.concat(F.lit(" "), "s_name").alias("email"))
    fields = s.select(F.col("s_suppkey").cast("string").alias("contact"), F.lit("1").alias("field"), F.col("s_nationkey").cast("string").alias("value"))
    mails = n.select(F.col("n_name").alias("address"), F.col("n_nationkey").alias("customer_no")).unionByName(s.select(F.col("s_name").alias("address"), ((F.col("s_nationkey") + 1) % 25).alias("customer_no")))
    return marketing.email_map(mails, contacts, fields, n.select(F.col("n_nationkey").alias("customer_no"), F.col("n_regionkey").alias("group_customer_no")))


@query("""SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer WHERE c_custkey % 3 <> 0
UNION ALL SELECT c_custkey, c_name, c_nationkey, c_acctbal + 1, c_mktsegment FROM customer WHERE c_custkey % 3 = 0
UNION ALL SELECT -c_custkey - 1, NULL, NULL, c_acctbal + 1, NULL FROM customer WHERE c_custkey % 3 = 0""")
def upsert_customers(spark: SparkSession, d: str) -> DataFrame:
    c = _t(spark, d, "customer")
    new = c.where("c_custkey % 3 = 0").select("c_custkey", (F.col("c_acctbal") + 1).alias("c_acctbal"))
    return upsert(c, new.unionByName(new.withColumn("c_custkey", -F.col("c_custkey") - 1)), ["c_custkey"])


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS VARCHAR) AS \"props.k\" FROM events")
def json_unnest(spark: SparkSession, d: str) -> DataFrame:
    df = _t(spark, d, "events").select("event_id", F.from_json("props", "map<string,string>").alias("props"))
    return widen(df, "props", keys=["k"])


@query(r"""SELECT p_partkey, regexp_replace(trim(p_name), '\s+', ' ', 'g') AS spaced, array_to_string(list_transform(regexp_extract_all(lower(p_name), '[A-Za-z0-9_]+|[^A-Za-z0-9_]+'), lambda x: upper(x[1:1]) || x[2:]), '') AS titled,
  regexp_replace(lower(p_type), '\s+', '_', 'g') AS slug, len(string_split_regex(p_type, '\s+')) <> len(list_distinct(string_split_regex(p_type, '\s+'))) AS twice FROM part""")
def clean_text(spark: SparkSession, d: str) -> DataFrame:
    p = _t(spark, d, "part")
    return p.select("p_partkey", collapse(F.col("p_name")).alias("spaced"), title_case(F.col("p_name")).alias("titled"), slug(F.col("p_type")).alias("slug"), repeated_word(F.col("p_type")).alias("twice"))


@query("SELECT p_partkey, concat_ws('_', p_brand, p_type, coalesce(CASE WHEN p_size > 10 THEN CAST(p_size AS VARCHAR) END, 'NA')) AS said, concat_ws('-', p_brand, CASE WHEN p_size > 10 THEN CAST(p_size AS VARCHAR) END) AS short FROM part")
def unite_columns(spark: SparkSession, d: str) -> DataFrame:
    p = _t(spark, d, "part").select("p_partkey", "p_brand", "p_type", F.expr("CASE WHEN p_size > 10 THEN cast(p_size as string) END").alias("size"))
    p = unite(p, "said", ["p_brand", "p_type", "size"], remove=False)
    return unite(p, "short", ["p_brand", "size"], "-", skip_null=True).drop("p_type")


def _hmac(key: str, message: str) -> str:
    """HMAC-SHA-256 in SQL: pads are written out, in hexadecimal."""
    k = key.encode().ljust(64, b"\0")
    inner, outer = bytes(b ^ 0x36 for b in k).hex(), bytes(b ^ 0x5C for b in k).hex()
    return f"sha256(unhex('{outer}' || sha256(unhex('{inner}' || hex({message})))))"


@query(f"SELECT c_custkey, {_hmac('second', _hmac('first', 'CAST(c_custkey AS VARCHAR)') + " || '-' || CAST(c_custkey AS VARCHAR)")} AS hash FROM customer")
def anonymize_keys(spark: SparkSession, d: str) -> DataFrame:
    return _t(spark, d, "customer").select("c_custkey", anonymize(F.col("c_custkey").cast("string"), ("first", "second")).alias("hash"))


def _answers(spark: SparkSession, d: str) -> DataFrame:
    return _t(spark, d, "conversations").select(F.col("conv_id").alias("customer_hash"), F.col("role").alias("question"), F.col("turn").alias("subquestion"), F.col("text").alias("answer"))


@query("""SELECT c_custkey, id, answer FROM (SELECT c_custkey, 'c_name' AS id, c_name AS answer FROM customer UNION ALL SELECT c_custkey, 'c_mktsegment', c_mktsegment FROM customer UNION ALL SELECT c_custkey, 'rich', CASE WHEN c_acctbal > 5000 THEN 'yes' END FROM customer) WHERE answer IS NOT NULL""")
def survey_melt(spark: SparkSession, d: str) -> DataFrame:
    c = _t(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment", F.expr("CASE WHEN c_acctbal > 5000 THEN 'yes' END").alias("rich"))
    return c.unpivot("c_custkey", ["c_name", "c_mktsegment", "rich"], "id", "answer").where("answer is not null")


@query("""WITH a AS (SELECT conv_id AS customer_hash, role AS question, turn AS subquestion, text AS answer FROM conversations)
SELECT coalesce(x.customer_hash, y.customer_hash) AS customer_hash, x.question AS "question.1", x.subquestion AS "subquestion.1", x.answer AS "answer.1", y.question AS "question.2", y.subquestion AS "subquestion.2", y.answer AS "answer.2"
FROM (SELECT * FROM a WHERE question = 'system') x FULL JOIN (SELECT * FROM a WHERE question = 'assistant') y ON x.customer_hash = y.customer_hash""")
def survey_cross(spark: SparkSession, d: str) -> DataFrame:
    """Every answer of either role; that patterns tell capitals apart is tested beside it."""
    return surveys.survey_cross(_answers(spark, d), "^system$", "assist")


@query("""SELECT n AS column_no, CASE WHEN c >= greatest(a, b, c) THEN 'c_acctbal' WHEN b >= a THEN 'c_nationkey' ELSE 'c_custkey' END AS found FROM (
  SELECT n, sum(CASE WHEN c_custkey % n = 0 THEN 1 ELSE 0 END) AS a, sum(CASE WHEN c_nationkey % n = 0 THEN 1 ELSE 0 END) AS b, sum(CASE WHEN CAST(floor(c_acctbal) AS BIGINT) % n = 0 THEN 1 ELSE 0 END) AS c FROM customer, (VALUES (2), (5), (9)) AS v(n) GROUP BY n)""")
def find_column(spark: SparkSession, d: str) -> DataFrame:
    """Which column has the most multiples of a number."""
    c = _t(spark, d, "customer").select(F.floor("c_acctbal").alias("c_acctbal"), F.col("c_nationkey").cast("long").alias("c_nationkey"), F.col("c_custkey").cast("long").alias("c_custkey"))
    found = [(n, surveys.find_column(c, lambda x: (x % n == 0).cast("int"))) for n in (2, 5, 9)]  # noqa: B023
    return spark.createDataFrame(found, "column_no int, found string")


@query("WITH s AS (SELECT c_nationkey, " + ", ".join(f"CAST(count(*) FILTER (c_mktsegment = '{s}') AS DOUBLE) AS {s.lower()}" for s in SEGMENTS) + " FROM customer GROUP BY c_nationkey) SELECT c_nationkey, " + ", ".join(f"{s.lower()} / ({' + '.join(x.lower() for x in SEGMENTS)}) * 3 AS {s.lower()}" for s in SEGMENTS) + " FROM s")
def pivot_share(spark: SparkSession, d: str) -> DataFrame:
    wide = _t(spark, d, "customer").groupBy("c_nationkey").pivot("c_mktsegment", list(SEGMENTS)).agg(F.count("c_custkey"))
    wide = wide.select("c_nationkey", *(F.coalesce(F.col(s), F.lit(0)).cast("double").alias(s.lower()) for s in SEGMENTS))
    return census.shares(wide, [s.lower() for s in SEGMENTS])


@query("""SELECT o_orderkey, y, label FROM (SELECT o_orderkey, y, label, row_number() OVER (PARTITION BY o_orderkey ORDER BY abs(year(o_orderdate) - y), y) AS n
FROM orders LEFT JOIN (SELECT k, y + k AS y, label FROM (VALUES (1994, 'a'), (1997, 'b'), (1999, 'c')) AS r(y, label), range(4) AS t(k)) ON k = o_custkey % 5) WHERE n = 1""")
def nearest_year(spark: SparkSession, d: str) -> DataFrame:
    """Each fifth customer has no years to choose from."""
    o = _t(spark, d, "orders").select("o_orderkey", F.year("o_orderdate").alias("year"), (F.col("o_custkey") % 5).alias("k"))
    r = spark.createDataFrame([(k, y + k, label) for k in range(4) for y, label in ((1994, "a"), (1997, "b"), (1999, "c"))], "k long, y int, label string")
    return nearest_number(o, r, ["k"], "year", "y", ["y", "label"]).select("o_orderkey", "y", "label")


def _mails(spark: SparkSession, d: str) -> DataFrame:
    return email.data(*_mail_tables(spark, d)[:2], "2024-01-05", "2024-01-12")


def _mail_tables(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Promotions, responses and customers' e-mails."""
    e = _t(spark, d, "events")
    promos = e.where("event_type = 'view' and user_id % 4 > 0").select(F.lit(3).alias("media_type"), F.col("user_id").alias("customer_no"), (F.col("user_id") % 40).alias("group_customer_no"), F.col("ts").alias("promote_dt"), (F.col("event_id") % 10).alias("appeal_no"), (F.col("event_id") % 7).alias("campaign_no"), (F.col("user_id") * 3 + F.dayofmonth("ts") % 3).alias("source_no"), F.expr("CASE WHEN event_id % 10 = 0 THEN concat(' User', user_id, '@X.org ') END").alias("eaddress"), F.col("event_id").alias("promo_id"))
    replies = e.where("event_type = 'click'").select((F.col("user_id") % 40).alias("group_customer_no"), F.col("user_id").alias("customer_no"), F.expr("cast(event_id % 5 + 1 as int)").alias("response"), F.col("ts").alias("response_dt"), (F.col("user_id") * 3 + F.dayofmonth("ts") % 3).alias("source_no"), F.col("event_id").alias("reply_id"))
    known = e.where("event_type = 'signup'").select(F.col("user_id").alias("customer_no"), (F.col("user_id") % 40).alias("group_customer_no"), F.col("ts").alias("timestamp"), F.concat(F.lit("C"), "event_id", F.lit("@y.com")).alias("address"), F.expr("CASE WHEN event_id % 3 > 0 THEN 'Y' ELSE 'N' END").alias("primary_ind"))
    return promos, replies, known


_MAILS = """
WITH p AS (SELECT event_id AS promo_id, user_id * 3 + day(ts) % 3 AS source_no, ts AS promote_dt, event_id % 10 AS appeal_no, event_id % 7 AS campaign_no, CASE WHEN event_id % 10 = 0 THEN ' User' || user_id || '@X.org ' END AS eaddress FROM events WHERE event_type = 'view' AND user_id % 4 > 0),
r AS (SELECT event_id AS reply_id, user_id * 3 + day(ts) % 3 AS source_no, ts AS response_dt, event_id % 5 + 1 AS response FROM events WHERE event_type = 'click'),
f AS (SELECT source_no FROM p WHERE promote_dt >= TIMESTAMP '2024-01-05' AND promote_dt < TIMESTAMP '2024-01-12' UNION SELECT source_no FROM r WHERE response_dt >= TIMESTAMP '2024-01-05' AND response_dt < TIMESTAMP '2024-01-12'),
x AS (SELECT source_no, max(appeal_no) AS appeal_no, max(campaign_no) AS campaign_no, max(eaddress) AS eaddress FROM p GROUP BY source_no)
"""


@query(f"""{_MAILS}
SELECT promo_id, CAST(NULL AS BIGINT) AS reply_id, source_no, appeal_no, campaign_no, eaddress, promote_dt, CAST(NULL AS TIMESTAMP) AS response_dt FROM p WHERE source_no IN (SELECT source_no FROM f)
UNION ALL SELECT NULL, r.reply_id, r.source_no, x.appeal_no, x.campaign_no, x.eaddress, NULL, r.response_dt FROM r LEFT JOIN x ON r.source_no = x.source_no WHERE r.source_no IN (SELECT source_no FROM f)
""")
def email_data(spark: SparkSession, d: str) -> DataFrame:
    """A quarter of the users have no promotion: their responses stay, without what a promotion says."""
    return _mails(spark, d).select("promo_id", "reply_id", "source_no", "appeal_no", "campaign_no", "eaddress", "promote_dt", "response_dt")


@query(f"""{_MAILS},
fr AS (SELECT source_no, min(response_dt) AS first_dt FROM r WHERE source_no IN (SELECT source_no FROM f) GROUP BY source_no)
SELECT p.promo_id, CAST(NULL AS BIGINT) AS reply_id, CASE WHEN abs(epoch_us(first_dt) - epoch_us(promote_dt)) < 3 * 86400000000 THEN first_dt ELSE promote_dt END AS "timestamp" FROM p LEFT JOIN fr ON p.source_no = fr.source_no WHERE p.source_no IN (SELECT source_no FROM f)
UNION ALL SELECT NULL, reply_id, response_dt FROM r WHERE source_no IN (SELECT source_no FROM f)
""")
def email_timed(spark: SparkSession, d: str) -> DataFrame:
    """Three days instead of thirty, as the events span a month: both sides of the limit are met."""
    return email.timed(_mails(spark, d), 3).select("promo_id", "reply_id", "timestamp")


@query(f"""{_MAILS},
a AS (SELECT promo_id AS id, source_no, eaddress, promote_dt, CAST(NULL AS TIMESTAMP) AS response_dt, CAST(NULL AS BIGINT) AS response FROM p WHERE source_no IN (SELECT source_no FROM f)
  UNION ALL SELECT reply_id, r.source_no, x.eaddress, NULL, response_dt, response FROM r LEFT JOIN x ON r.source_no = x.source_no WHERE r.source_no IN (SELECT source_no FROM f)),
fr AS (SELECT source_no, min(response_dt) AS first_dt FROM a GROUP BY source_no),
t AS (SELECT a.*, user_id, user_id % 40 AS house, coalesce(response_dt, CASE WHEN abs(epoch_us(first_dt) - epoch_us(promote_dt)) < 30 * 86400000000 THEN first_dt END, promote_dt) AS ts FROM a JOIN fr ON a.source_no = fr.source_no JOIN events ON event_id = id),
e AS (SELECT * FROM t WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-12'),
m AS (SELECT user_id, user_id % 40 AS house, ts, 'C' || event_id || '@y.com' AS address, row_number() OVER (PARTITION BY user_id, ts ORDER BY 'C' || event_id || '@y.com' DESC) AS n, row_number() OVER (PARTITION BY user_id % 40, ts ORDER BY 'C' || event_id || '@y.com' DESC) AS k FROM events WHERE event_type = 'signup' AND event_id % 3 > 0)
SELECT id, source_no, e.ts AS "timestamp", CASE response WHEN 1 THEN 'Open' WHEN 2 THEN 'Click' WHEN 3 THEN 'Unsubscribe' WHEN 4 THEN 'Soft Bounce' WHEN 5 THEN 'Other' ELSE 'Send' END AS event_subtype, 'Email' AS event_type, epoch_us(e.ts) AS timestamp_id,
  lower(trim(coalesce(eaddress, h.address, c.address))) AS eaddress, regexp_replace(lower(trim(coalesce(eaddress, h.address, c.address))), '.+@', '') AS domain, CASE WHEN source_no % 2 = 0 THEN 's' || source_no END AS source_desc, CASE WHEN source_no % 3 = 0 THEN 'x' || source_no END AS extraction_desc
FROM e ASOF LEFT JOIN (SELECT * FROM m WHERE n = 1) c ON e.user_id = c.user_id AND e.ts >= c.ts ASOF LEFT JOIN (SELECT * FROM m WHERE k = 1) h ON e.house = h.house AND e.ts >= h.ts""")
def email_base(spark: SparkSession, d: str) -> DataFrame:
    """Promotions and responses of a week with subtypes, times, addresses and descriptions; households' e-mails by ranges."""
    promos, replies, known = _mail_tables(spark, d)
    codes = spark.createDataFrame([(1, "Opened"), (2, "clicked thru"), (3, "Unsubscribed"), (4, "soft bounce"), (5, "Other")], "response int, event_subtype string")
    sources = promos.select("source_no").unionByName(replies.select("source_no")).distinct()
    told = sources.where("source_no % 2 = 0").select("source_no", F.concat(F.lit("s"), "source_no").alias("source_desc"), F.lit(None).cast("timestamp_ntz").alias("acq_dt"))
    drawn = sources.where("source_no % 3 = 0").select("source_no", F.concat(F.lit("x"), "source_no").alias("extraction_desc"))
    out = email.base(promos, replies, codes, told, drawn, known, "2024-01-05", "2024-01-12")
    return out.select(F.coalesce("promo_id", "reply_id").alias("id"), "source_no", "timestamp", "event_subtype", "event_type", "timestamp_id", "eaddress", "domain", "source_desc", "extraction_desc")


@query("""WITH e AS (SELECT event_id, user_id, user_id % 40 AS house, ts, CASE WHEN event_id % 10 = 0 THEN ' User' || user_id || '@X.org ' END AS own FROM events WHERE event_type = 'view'),
m AS (SELECT user_id, user_id % 40 AS house, ts, 'C' || event_id || '@y.com' AS address, row_number() OVER (PARTITION BY user_id, ts ORDER BY 'C' || event_id || '@y.com' DESC) AS n, row_number() OVER (PARTITION BY user_id % 40, ts ORDER BY 'C' || event_id || '@y.com' DESC) AS k FROM events WHERE event_type = 'signup' AND event_id % 3 > 0)
SELECT e.event_id, lower(trim(coalesce(own, h.address, c.address))) AS eaddress, regexp_replace(lower(trim(coalesce(own, h.address, c.address))), '.+@', '') AS domain FROM e
ASOF LEFT JOIN (SELECT * FROM m WHERE n = 1) c ON e.user_id = c.user_id AND e.ts >= c.ts ASOF LEFT JOIN (SELECT * FROM m WHERE k = 1) h ON e.house = h.house AND e.ts >= h.ts""")
def email_addressed(spark: SparkSession, d: str) -> DataFrame:
    e = _t(spark, d, "events")
    house = (F.col("user_id") % 40).alias("group_customer_no")
    sends = e.where("event_type = 'view'").select("event_id", F.col("user_id").alias("customer_no"), house, F.col("ts").alias("timestamp"), F.expr("CASE WHEN event_id % 10 = 0 THEN concat(' User', user_id, '@X.org ') END").alias("eaddress"))
    known = _mail_tables(spark, d)[2]
    return email.addressed(sends, known).select("event_id", "eaddress", "domain")


@query("""SELECT event_id, CASE WHEN kind IS NULL THEN 'Send' WHEN kind ILIKE '%open%' THEN 'Open' WHEN kind ILIKE '%click%' THEN 'Click' WHEN kind ILIKE '%unsub%' THEN 'Unsubscribe' WHEN kind ILIKE '%soft%' THEN 'Soft Bounce' WHEN kind ILIKE '%hard%' THEN 'Hard Bounce' ELSE kind END AS event_subtype, p_name AS source_desc
FROM events LEFT JOIN (VALUES (0, 'Re-Opened'), (1, 'CLICK'), (2, 'unsubscribed'), (3, 'a soft one'), (4, 'HARD'), (5, 'Other')) AS c(response, kind) ON event_id % 8 = response LEFT JOIN part ON event_id = p_partkey""")
def email_described(spark: SparkSession, d: str) -> DataFrame:
    rows = _t(spark, d, "events").select("event_id", (F.col("event_id") % 8).cast("int").alias("response"), F.col("event_id").alias("source_no"))
    codes = spark.createDataFrame([(0, "Re-Opened"), (1, "CLICK"), (2, "unsubscribed"), (3, "a soft one"), (4, "HARD"), (5, "Other")], "response int, event_subtype string")
    p = _t(spark, d, "part").select(F.col("p_partkey").alias("source_no"), F.col("p_name").alias("source_desc"), F.lit(None).cast("timestamp_ntz").alias("acq_dt"), F.col("p_type").alias("extraction_desc"))
    return email.described(rows, codes, p, p).select("event_id", "event_subtype", "source_desc")


@query(f"""SELECT ref_no, event_subtype, event_subtype2, "contribution_Urgent one_count", contribution_timestamp_max, CAST(contribution_amt AS BIGINT) AS contribution_amt FROM (
  SELECT *, CASE WHEN row_number() OVER w = 1 THEN 'New'
    WHEN CASE WHEN memb IS NOT NULL THEN row_number() OVER (PARTITION BY group_customer_no, event_subtype, memb ORDER BY cont_dt, ref_no) ELSE row_number() OVER (PARTITION BY group_customer_no, event_subtype, month(cont_dt) ORDER BY cont_dt, ref_no) END > 1 THEN 'Upgrade'
    WHEN epoch_us(cont_dt) - epoch_us(lag(cont_dt) OVER w) <= 365 * 86400000000 THEN 'Renew' ELSE 'Reinstate' END AS event_subtype2,
    CAST(sum(CASE WHEN event_subtype = 'Urgent one' THEN 1 ELSE 0 END) OVER g AS BIGINT) AS "contribution_Urgent one_count", cont_dt AS contribution_timestamp_max, sum(cont_amt) OVER g AS contribution_amt
  FROM (SELECT *, CASE WHEN o_orderpriority = '1-URGENT' THEN 'Urgent one' ELSE 'Other' END AS event_subtype, CASE WHEN ref_no % 3 = 0 THEN ref_no % 4 END AS memb FROM ({_PAID}) WHERE cont_amt > 0)
  WINDOW w AS (PARTITION BY group_customer_no, event_subtype ORDER BY cont_dt, ref_no), g AS (PARTITION BY group_customer_no ORDER BY cont_dt, ref_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))""")
def contribution_plan(spark: SparkSession, d: str) -> DataFrame:
    """A third of the payments belong to memberships; the others repeat by campaign."""
    rows = _payments(spark, d).withColumns({"cust_memb_no": F.expr("CASE WHEN ref_no % 3 = 0 THEN ref_no % 4 END"), "campaign_no": F.month("cont_dt")})
    out = contributions.features(rows, [("Urgent one", F.col("o_orderpriority") == "1-URGENT"), ("Other", F.lit(True))])
    return out.select("ref_no", "event_subtype", "event_subtype2", "`contribution_Urgent one_count`", "contribution_timestamp_max", "contribution_amt")


_TITLED = "array_to_string(list_transform(regexp_extract_all(lower(x), '[A-Za-z0-9_]+|[^A-Za-z0-9_]+'), lambda y: upper(y[1:1]) || y[2:]), '')"


@query(rf"""SELECT p_partkey, CASE WHEN NOT regexp_matches(x, '^(web add|unknown|no add)|^$') THEN {_TITLED} END AS name
FROM (SELECT p_partkey, trim(regexp_replace(CASE p_partkey % 8 WHEN 0 THEN 'web  address' WHEN 1 THEN ' no address ' WHEN 2 THEN '' WHEN 3 THEN '12 None Such Rd' WHEN 4 THEN 'Unknown' WHEN 5 THEN 'unknown st' ELSE p_name END, '\s+', ' ', 'g')) AS x FROM part)""")
def clean_names(spark: SparkSession, d: str) -> DataFrame:
    said = F.expr("CASE p_partkey % 8 WHEN 0 THEN 'web  address' WHEN 1 THEN ' no address ' WHEN 2 THEN '' WHEN 3 THEN '12 None Such Rd' WHEN 4 THEN 'Unknown' WHEN 5 THEN 'unknown st' ELSE p_name END")
    return _t(spark, d, "part").select("p_partkey", clean(said).alias("name"))


