"""Queries of the plans, the catalog and the sources, over data made from the standard tables, and SQL that gives the same rows."""

from __future__ import annotations

import json
import uuid
from bisect import bisect_right
from functools import lru_cache, reduce
from urllib.parse import parse_qs, urlparse

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.catalog import Catalog
from rivulet.durable import discard, shared_dir
from rivulet.functions.text import epoch_time, excel_time, file_stem, separators
from rivulet.operators.memo import memoised
from rivulet.operators.nested import combine_pages, from_json_text
from rivulet.operators.ordered import chunk_bounds, numbered, with_chunk
from rivulet.operators.region import Region
from rivulet.plans import addresses, census, contributions, duplicates, email, marketing, surveys, unified
from rivulet.queries import _PAID, EVENT_TYPES, _hmac, _payments, _slugs, _t, query
from rivulet.sources import rest
from rivulet.sources.geocoders import Service, one_by_one
from rivulet.sources.tables import Tables
from rivulet.sources.workbooks import xlsx
from rivulet.streaming.incremental import follow, follow_service


def _catalog(spark: SparkSession) -> Catalog:
    return Catalog(spark, f"{shared_dir(spark)}/catalog-{uuid.uuid4().hex}")


@query("SELECT n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey > 3")
def table_sql(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    t.register("nation")
    t.table("region", ["r_regionkey", "r_name"]).createOrReplaceTempView("region")
    return t.sql("SELECT n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey > 3")


@query("""WITH b AS (SELECT * FROM events WHERE event_id % 3 = 0 AND ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-15')
SELECT event_id, user_id, ts FROM events WHERE event_id % 3 <> 0 AND NOT ts BETWEEN (SELECT min(ts) FROM b) AND (SELECT max(ts) FROM b) UNION ALL SELECT event_id, user_id, ts FROM b""")
def catalog_increment(spark: SparkSession, d: str) -> DataFrame:
    """A range in the middle of a dataset is replaced; what is later stays."""
    e = _t(spark, d, "events").select("event_id", "user_id", "ts", F.dayofmonth("ts").alias("day"))
    c = _catalog(spark)
    c.overwrite("events", e.where("event_id % 3 <> 0"), ["day"])
    batch = e.where("event_id % 3 = 0 and ts >= timestamp_ntz '2024-01-10' and ts < timestamp_ntz '2024-01-15'")
    return c.replace_range("events", batch, "ts", ["day"]).drop("day")


@query("""SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN 'new' ELSE c_name END AS c_name, CASE WHEN c_custkey % 4 = 0 THEN c_nationkey END AS home, (SELECT max(c_custkey) FROM customer) AS mark FROM customer""")
def catalog_merge(spark: SparkSession, d: str) -> DataFrame:
    """Merge by key adds a column; the greatest key is the mark of the next load; a shallow copy is read."""
    c, shallow = _catalog(spark), _catalog(spark)
    rows = _t(spark, d, "customer")
    c.overwrite("customer", rows.select("c_custkey", "c_name", "c_mktsegment"))
    c.merge("customer", rows.where("c_custkey % 4 = 0").select("c_custkey", F.lit("new").alias("c_name"), F.col("c_nationkey").alias("home")), ["c_custkey"])
    return c.copy("customer", shallow, ["c_custkey", "c_name", "home"]).withColumn("mark", F.lit(c.high_water("customer", "c_custkey")))


@query("SELECT event_id, user_id, ts FROM events")
def stream_follow(spark: SparkSession, d: str) -> DataFrame:
    """Files of a folder in two batches, the late one second."""
    e = _t(spark, d, "events").select("event_id", "user_id", "ts")
    at, c, name = f"{shared_dir(spark)}/arrivals-{uuid.uuid4().hex}", _catalog(spark), uuid.uuid4().hex
    for part in (e.where("ts >= timestamp_ntz '2024-01-15'"), e.where("ts < timestamp_ntz '2024-01-15'")):
        part.write.mode("append").parquet(at)
        follow(spark, at, e.schema, c, "events", date_column="ts", query=name).awaitTermination()
    return c.read("events")


_UNITED = """SELECT user_id AS group_customer_no, ts AS "timestamp", event_id, CAST(NULL AS BIGINT) AS o_orderkey, value AS amount, 'events' AS stream, epoch_us(ts) AS timestamp_id FROM events
  UNION ALL SELECT o_custkey, o_orderdate, NULL, o_orderkey, NULL, 'orders', epoch_us(o_orderdate) FROM orders"""
#: Rows of a chunk of the unified stream in the queries below.
CHUNK = 5000
_CHUNKED = f"""SELECT u.*, (SELECT min(j) FROM b WHERE b.t >= u.timestamp_id) AS partition FROM u"""
_BOUNDS = f"""u AS ({_UNITED}), p AS (SELECT timestamp_id, (row_number() OVER (ORDER BY timestamp_id) - 1) // {CHUNK} + 1 AS j FROM u), b AS (SELECT j, max(timestamp_id) AS t FROM p GROUP BY j)"""


@query(f"""WITH {_BOUNDS}
SELECT group_customer_no, "timestamp", event_id, o_orderkey, stream, timestamp_id, last_value(amount IGNORE NULLS) OVER (PARTITION BY group_customer_no ORDER BY "timestamp", stream, event_id NULLS FIRST, o_orderkey NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS amount,
  row_number() OVER (ORDER BY "timestamp", stream, event_id NULLS FIRST, o_orderkey NULLS FIRST) AS rowid, partition FROM ({_CHUNKED})""")
def stream_increments(spark: SparkSession, d: str) -> DataFrame:
    """Built until a day, then extended twice: what one build gives, row numbers and chunks too."""
    c = _catalog(spark)
    e, o = _streams(spark, d)
    c.overwrite("orders", o)
    for part in (e.where("timestamp < timestamp_ntz '2024-01-11'"), e.where("timestamp < timestamp_ntz '2024-01-21'"), e):
        c.overwrite("events", part)
        out = unified.stream(c, ["events", "orders"], fill_match=["^amount$"], tie=["stream", "event_id", "o_orderkey"], chunk_size=CHUNK)
    return out


def _streams(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    e = _t(spark, d, "events").select(F.col("user_id").alias("group_customer_no"), F.col("ts").alias("timestamp"), "event_id", F.col("value").alias("amount"))
    return e, _t(spark, d, "orders").select(F.col("o_custkey").alias("group_customer_no"), F.col("o_orderdate").alias("timestamp"), "o_orderkey")


@query(f"""WITH {_BOUNDS} SELECT partition, count(*) AS n, min("timestamp") AS first, max("timestamp") AS last FROM ({_CHUNKED}) GROUP BY partition""")
def stream_chunks(spark: SparkSession, d: str) -> DataFrame:
    """Chunks of a given number of rows: sizes differ from it by days' ties alone."""
    e, o = _streams(spark, d)
    rows = unified.united({"events": e, "orders": o})
    found = with_chunk(rows, "timestamp", chunk_bounds(rows, "timestamp", CHUNK))
    return found.groupBy("partition").agg(F.count("*").alias("n"), F.min("timestamp").alias("first"), F.max("timestamp").alias("last"))


@query("SELECT event_id, " + _slugs("min(CASE WHEN event_type = '{v}' THEN ts END) OVER w AS email_{s}_timestamp_min, max(CASE WHEN event_type = '{v}' THEN ts END) OVER w AS email_{s}_timestamp_max, count(CASE WHEN event_type = '{v}' THEN ts END) OVER w AS email_{s}_count", EVENT_TYPES) + " FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)")
def email_increments(spark: SparkSession, d: str) -> DataFrame:
    """The e-mail stream written in two parts: features go on from the state before."""
    e = _t(spark, d, "events").select("event_id", F.col("user_id").alias("group_customer_no"), F.col("ts").alias("timestamp"), F.col("event_type").alias("event_subtype"), F.col("event_id").alias("timestamp_id"))
    c = _catalog(spark)
    for part in (e.where("timestamp < timestamp_ntz '2024-01-15'"), e.where("timestamp >= timestamp_ntz '2024-01-15'")):
        out = email.email_stream(c, part, subtypes=EVENT_TYPES)
    return out.drop("group_customer_no", "timestamp", "event_subtype", "timestamp_id", "year")


def _service(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    """A marketing service's tables, all text as it gives them."""
    e = _t(spark, d, "events")
    text = lambda c: F.expr(f"cast({c} as string)")
    at = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    of = lambda kind: e.where(f"event_type = '{kind}'")
    common = [text("event_id").alias("id"), F.unix_seconds(F.col("ts").cast("timestamp")).cast("string").alias("tstamp"), text("user_id").alias("subscriberid")]
    opened = [*common, text("event_id % 5").alias("campaignid"), text("event_id % 4").alias("messageid"), text("event_id % 6").alias("link"), text("event_id % 2").alias("isread")]
    names = {k: e.select(F.explode(F.sequence(F.lit(0), F.lit(9))).alias("id")).distinct().select(F.col("id").cast("string").alias("id"), F.concat(F.lit(k), "id").alias("name")) for k in ("campaigns", "messages", "links", "lists")}
    return {
        "logs": of("view").select(*common, text("event_id % 5").alias("campaignid"), text("event_id % 4").alias("messageid")),
        "linkData": of("click").select(*opened),
        "mppLinkData": of("add_to_cart").select(*opened),
        "bounceLogs": of("signup").select(*common, F.expr("CASE WHEN event_id % 2 = 0 THEN '' ELSE 'x' END").alias("email")),
        "contactLists": of("purchase").select(text("event_id").alias("id"), at.alias("updated_timestamp"), text("event_id % 3 + 1").alias("status"), text("user_id").alias("contact"), text("event_id % 5").alias("campaign"), text("event_id % 4").alias("message"), text("event_id % 7").alias("list")),
        **names,
    }


_EVENTS = """WITH e AS (SELECT *, date_trunc('second', ts) AS sec FROM events),
s AS (SELECT sec AS "timestamp", user_id AS subscriberid, event_id % 5 AS campaignid, event_id % 4 AS messageid, CAST(NULL AS BIGINT) AS linkid, CAST(NULL AS BIGINT) AS listid, 'Send' AS event_subtype FROM e WHERE event_type = 'view'
  UNION ALL SELECT sec, user_id, event_id % 5, event_id % 4, event_id % 6, NULL, CASE WHEN event_id % 2 = 1 THEN 'Open' ELSE 'Click' END FROM e WHERE event_type IN ('click', 'add_to_cart') AND event_id % 4 <> 0
  UNION ALL SELECT sec, user_id, NULL, NULL, NULL, NULL, 'Soft Bounce' FROM e WHERE event_type = 'signup' AND event_id % 2 <> 0
  UNION ALL SELECT sec, user_id, event_id % 5, event_id % 4, NULL, event_id % 7, CASE WHEN event_id % 3 = 1 THEN 'Unsubscribe' ELSE 'Hard Bounce' END FROM e WHERE event_type = 'purchase' AND event_id % 3 <> 0)"""


@query(_EVENTS + """ SELECT s.*, c_custkey AS customer_no, 'campaigns' || campaignid AS campaign_name, 'messages' || messageid AS message_name, 'links' || linkid AS link_name, 'lists' || listid AS list_name FROM s LEFT JOIN customer ON subscriberid = c_custkey % 300""")
def marketing_events(spark: SparkSession, d: str) -> DataFrame:
    """Every customer that a subscriber stands for has its events; dimensions add columns and no rows."""
    t = _service(spark, d)
    mapped = _t(spark, d, "customer").select((F.col("c_custkey") % 300).alias("subscriberid"), F.col("c_custkey").alias("customer_no"))
    return marketing.marketing_stream(_catalog(spark), t, mapped).drop("event_type")


@query("""WITH c AS (SELECT c_custkey AS id, 'u' || c_custkey || '@z.com' AS address, c_custkey % 200 AS customer_no FROM customer WHERE c_custkey % 7 <> 0 AND c_custkey % 3 = 0)
SELECT id, address, CAST(customer_no AS INTEGER) AS customer_no, customer_no % 40 AS group_customer_no FROM c WHERE NOT EXISTS (SELECT 1 FROM customer k WHERE c_custkey % 2 = 0 AND 'u' || c_custkey || '@z.com' = c.address AND (c_custkey % 200) % 40 = c.customer_no % 40) AND customer_no < 150""")
def marketing_orphans(spark: SparkSession, d: str) -> DataFrame:
    k = _t(spark, d, "customer").select("c_custkey", (F.col("c_custkey") % 200).alias("n"), F.col("c_custkey").cast("string").alias("id"), F.concat(F.lit(" U"), "c_custkey", F.lit("@Z.com")).alias("email"))
    contacts = k.where("c_custkey % 3 = 0").select("id", "email")
    fields = k.select(F.col("id").alias("contact"), F.lit("1").alias("field"), F.col("n").cast("string").alias("value"))
    lists = k.select(F.col("id").alias("contact"), F.expr("CASE WHEN c_custkey % 7 = 0 THEN '2' ELSE '1' END").alias("status"))
    homes = spark.range(150).select(F.col("id").alias("customer_no"), (F.col("id") % 40).alias("group_customer_no"))
    primary = k.where("c_custkey % 2 = 0").select(F.col("email").alias("address"), (F.col("n") % 40).alias("group_customer_no"))
    return marketing.orphans(contacts, fields, lists, homes, primary)


@query("""WITH h AS (SELECT user_id % 200 AS customer_no, event_id % 500 AS eaddress_no, ts, 'a' || (event_id % 900) || '@x' AS address, event_type, event_id, value FROM events WHERE event_id % 13 <> 0 AND event_id % 17 <> 0),
s AS (SELECT *, coalesce(lead(ts) OVER w, TIMESTAMP '2124-01-01') AS stop, lead(event_type) OVER w AS changed_by FROM h WINDOW w AS (PARTITION BY eaddress_no ORDER BY ts, address)),
p AS (SELECT * FROM s WHERE value > 50),
b AS (SELECT customer_no, ts, address FROM (SELECT *, row_number() OVER (PARTITION BY customer_no, ts ORDER BY eaddress_no DESC) AS n FROM p) WHERE n = 1),
x AS (SELECT p.customer_no, p.address AS "from", b.address AS "to", p.stop AS "timestamp", p.changed_by AS last_updated_by FROM p ASOF JOIN b ON p.customer_no = b.customer_no AND p.stop >= b.ts)
SELECT customer_no, "from", "to", "timestamp", last_updated_by FROM (SELECT *, row_number() OVER (PARTITION BY "from" ORDER BY "timestamp" DESC, "to" DESC) AS n FROM x WHERE "from" <> "to" AND "timestamp" > TIMESTAMP '2024-01-10') WHERE n = 1 AND "timestamp" < TIMESTAMP '2100-01-01'""")
def changed_emails(spark: SparkSession, d: str) -> DataFrame:
    """Rows without a customer or an address among the states: they end nothing and follow nothing."""
    e = _t(spark, d, "events")
    history = e.select(F.expr("CASE WHEN event_id % 13 <> 0 THEN user_id % 200 END").alias("customer_no"), F.lit(1).alias("group_customer_no"), (F.col("event_id") % 500).alias("eaddress_no"), F.col("ts").alias("timestamp"), F.expr("CASE WHEN value > 50 THEN 'Y' ELSE 'N' END").alias("primary_ind"), F.when(F.col("event_id") % 17 != 0, F.concat(F.lit(" A"), F.col("event_id") % 900, F.lit("@X "))).alias("address"), F.col("event_type").alias("last_updated_by"))
    out = marketing.changed_emails(history, "2024-01-10", "2024-02-01")
    return out.where("timestamp < timestamp_ntz '2100-01-01'").select("customer_no", "from", "to", "timestamp", "last_updated_by")


@query("""SELECT c_custkey AS customer_no, 'm' || c_custkey AS "from", CASE c_custkey % 4 WHEN 0 THEN 'm1' WHEN 1 THEN NULL ELSE 'new' || c_custkey END AS "to", CASE WHEN c_custkey % 3 <> 0 THEN c_custkey END AS id,
  CASE WHEN c_custkey % 3 = 0 OR c_custkey % 5 = 0 THEN 'nothing' WHEN c_custkey % 4 IN (0, 1) THEN 'tag' ELSE 'update' END AS action FROM customer""")
def orphan_resolutions(spark: SparkSession, d: str) -> DataFrame:
    c = _t(spark, d, "customer")
    changes = c.select(F.col("c_custkey").alias("customer_no"), F.concat(F.lit("m"), "c_custkey").alias("from"), F.expr("CASE c_custkey % 4 WHEN 0 THEN 'm1' WHEN 1 THEN NULL ELSE concat('new', c_custkey) END").alias("to"))
    contacts = c.where("c_custkey % 3 <> 0").select(F.col("c_custkey").cast("string").alias("id"), F.concat(F.lit(" M"), "c_custkey").alias("email"))
    fields = c.select(F.col("c_custkey").cast("string").alias("contact"), F.lit("1").alias("field"), F.expr("cast(CASE WHEN c_custkey % 5 = 0 THEN -1 ELSE c_custkey END as string)").alias("value"))
    return marketing.resolutions(changes, contacts, fields)


def _people(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    c = _t(spark, d, "customer")
    people = c.select(F.col("c_custkey").alias("customer_no"), (F.col("c_custkey") % 300).alias("group_customer_no"), F.expr("CASE WHEN c_custkey % 11 = 0 THEN 'Organization' ELSE 'Individual' END").alias("cust_type_desc"), F.expr("CASE WHEN c_custkey % 13 = 0 THEN 'Inactive' ELSE 'Active' END").alias("inactive_desc"), F.concat(F.lit(" "), "c_mktsegment").alias("fname"), F.expr("CASE WHEN c_custkey % 17 = 0 THEN '' ELSE c_mktsegment END").alias("lname"), (F.col("c_acctbal") * 100).cast("long").alias("cents"))
    homes = c.where("c_custkey < 300").select(F.col("c_custkey").alias("group_customer_no"), F.lit("1").alias("house_number"), F.concat(F.lit("Road "), F.col("c_custkey") % 10).alias("road"), F.expr("CASE WHEN c_custkey % 2 = 0 THEN 'U1' END").alias("unit"), F.lit("C").alias("city"), F.lit("S").alias("state"))
    return people, homes


_PEOPLE = """people AS (SELECT c_custkey AS customer_no, c_custkey % 300 AS house, lower(c_mktsegment) AS fname, lower(c_mktsegment) AS lname FROM customer WHERE c_custkey % 11 <> 0 AND c_custkey % 13 <> 0 AND c_custkey % 17 <> 0),
homes AS (SELECT c_custkey AS house, 'road ' || (c_custkey % 10) AS road, CASE WHEN c_custkey % 2 = 0 THEN 'u1' END AS unit FROM customer WHERE c_custkey < 300),
mails AS (SELECT DISTINCT c_custkey % 300 AS house, 'm' || (c_custkey % 20) || '@x' AS email FROM customer WHERE c_custkey % 10 NOT IN (6, 7)),
data AS (SELECT customer_no, p.house AS group_customer_no, fname, lname, road, unit, email FROM people p LEFT JOIN homes h ON p.house = h.house LEFT JOIN mails m ON p.house = m.house)"""


def _household_data(spark: SparkSession, d: str) -> DataFrame:
    people, homes = _people(spark, d)
    mails = _t(spark, d, "customer").select((F.col("c_custkey") % 300).alias("group_customer_no"), F.concat(F.lit(" M"), F.col("c_custkey") % 20, F.lit("@X")).alias("address"), (F.col("c_custkey") % 10).alias("eaddress_type"))
    phones = homes.where("group_customer_no % 3 = 0").select("group_customer_no", F.concat(F.lit(" 55X"), "group_customer_no").alias("phone"))
    return duplicates.load(people, homes, phones, mails)


@query(f"WITH {_PEOPLE} SELECT customer_no, group_customer_no, fname, lname, road, unit, email, CASE WHEN group_customer_no % 3 = 0 AND group_customer_no < 300 THEN '55x' || group_customer_no END AS phone FROM data")
def duplicates_data(spark: SparkSession, d: str) -> DataFrame:
    return _household_data(spark, d).select("customer_no", "group_customer_no", "fname", "lname", "road", "unit", "email", "phone")


@query(f"""WITH {_PEOPLE},
pairs AS (SELECT DISTINCT customer_no, before AS other FROM (SELECT customer_no, lag(customer_no) OVER (PARTITION BY email, road, coalesce(unit, ''), fname, lname ORDER BY customer_no) AS before FROM (SELECT DISTINCT customer_no, email, road, unit, fname, lname FROM data WHERE email IS NOT NULL AND road IS NOT NULL)) WHERE before IS NOT NULL),
apart AS (SELECT * FROM pairs WHERE customer_no % 300 <> other % 300 AND NOT (customer_no % 5 = 0 AND other = customer_no - 10)),
f AS (SELECT c_custkey AS n, c_custkey <> c_custkey % 300 AS housed, c_custkey % 13 <> 0 AS active, c_custkey % 9 = 0 AND c_custkey % 2 = 0 AS member, c_acctbal AS seen, CASE WHEN c_custkey % 4 = 0 AND c_custkey % 8 <> 0 THEN c_custkey % 5 END AS login FROM customer),
r AS (SELECT a.customer_no, a.other, CASE WHEN l.housed AND NOT k.housed OR NOT l.housed AND k.housed THEN 1 WHEN l.member <> k.member THEN 2 WHEN l.login <> k.login THEN 4 WHEN l.seen <> k.seen THEN 3 END AS why,
  CASE WHEN l.housed <> k.housed THEN l.housed WHEN l.member <> k.member THEN l.member WHEN l.login <> k.login THEN l.login > k.login WHEN l.seen <> k.seen THEN l.seen > k.seen END AS first FROM apart a JOIN f l ON a.customer_no = l.n JOIN f k ON a.other = k.n)
SELECT customer_no, other AS "i.customer_no", CASE first WHEN true THEN customer_no WHEN false THEN other END AS keep_customer_no, CASE first WHEN true THEN other WHEN false THEN customer_no END AS delete_customer_no, CASE why WHEN 1 THEN 'In household' WHEN 2 THEN 'Current membership' WHEN 3 THEN 'Last activity date' WHEN 4 THEN 'Last login date' END AS keep_reason FROM r""")
def duplicates_stream(spark: SparkSession, d: str) -> DataFrame:
    """Pairs that agree in all, not of one household nor associated, and which of them is kept and why."""
    c = _t(spark, d, "customer")
    people, _ = _people(spark, d)
    known = people.withColumns({"last_activity_dt": F.timestamp_micros(F.col("cents") * 1_000_000).cast("timestamp_ntz"), "last_update_dt": F.lit(None).cast("timestamp_ntz")})
    members = c.where("c_custkey % 9 = 0").select(F.col("c_custkey").alias("customer_no"), F.expr("CASE WHEN c_custkey % 2 = 0 THEN 'Y' ELSE 'N' END").alias("cur_record_ind"), F.lit(1.0).alias("memb_amt"), F.lit("Level").alias("memb_level"))
    logins = c.where("c_custkey % 4 = 0").select(F.col("c_custkey").alias("customer_no"), F.expr("CASE WHEN c_custkey % 8 = 0 THEN 'Y' ELSE 'N' END").alias("inactive"), F.timestamp_seconds(F.col("c_custkey") % 5).cast("timestamp_ntz").alias("last_login_dt"))
    related = c.where("c_custkey % 5 = 0").select(F.col("c_custkey").alias("customer_no"), (F.col("c_custkey") - 10).alias("associated_customer_no"))
    return duplicates.duplicates_stream(_household_data(spark, d), people.select("customer_no", "group_customer_no"), related, duplicates.facts(known, members, logins))


@query("""SELECT c_custkey, CASE c_custkey % 6 WHEN 0 THEN c_custkey || ' Main St' WHEN 1 THEN NULL WHEN 2 THEN '1 A St' WHEN 3 THEN '5 B Rd, 2f' ELSE c_custkey || ' None Such Rd' END AS street1,
  CASE c_custkey % 6 WHEN 2 THEN 'Apt 4' WHEN 3 THEN 'Po Box 9' WHEN 4 THEN 'X' WHEN 5 THEN 'Tower' END AS street2,
  CASE c_custkey % 6 WHEN 0 THEN 'Boston' WHEN 1 THEN 'Here' WHEN 2 THEN 'Town' END AS city, CASE c_custkey % 6 WHEN 0 THEN 'MA' WHEN 2 THEN 'NY' END AS state, CASE c_custkey % 6 WHEN 0 THEN '02139' WHEN 2 THEN '10001' END AS postal_code, CASE c_custkey % 6 WHEN 0 THEN 'USA' WHEN 2 THEN 'USA' END AS country FROM customer""")
def address_normalised(spark: SparkSession, d: str) -> DataFrame:
    """Six kinds of address: a rooftop match, junk, a census match, a parsed road, a repeated word and plain text."""
    rows = _kinds(_t(spark, d, "customer"), {
        "street1": {0: "elsewhere", 1: "web added", 4: "{} None  Such Rd", 5: "{} none such rd"}, "street2": {4: "x"}, "city": {0: "elsewhere", 1: "here", 3: "lost"}, "state": {}, "postal_code": {}, "country": {},
        "formatted_address": {0: "{} Main St, Boston, MA 02139, USA", 1: "Main St, Boston, MA, USA"}, "location_type": {0: "ROOFTOP", 1: "ROOFTOP"}, "matched_address": {2: "1 A ST, TOWN, NY, 10001"},
        "parsed.house_number": {3: "5"}, "parsed.road": {3: "b rd"}, "parsed.unit": {2: "apt 4", 3: "2f"}, "parsed.po_box": {3: "po box 9"}, "parsed.house": {4: "unit unit", 5: "tower"}, "parsed.city": {2: "no"}, "parsed.state": {}, "parsed.postcode": {}, "parsed.country": {},
    })
    names = ("street1", "street2", "city", "state", "postal_code", "country")
    return addresses.normalised(rows).select("c_custkey", *(F.col(f"{n}_cleaned").alias(n) for n in names))


def _kinds(rows: DataFrame, columns: dict[str, dict[int, str]], of: int = 6) -> DataFrame:
    """rows' key and columns of text by the key's remainder, {} standing for the key; null where there is none."""
    out = []
    for name, said in columns.items():
        value = F.lit(None).cast("string")
        for k, text in said.items():
            value = F.when(F.col("c_custkey") % of == k, F.replace(F.lit(text), F.lit("{}"), F.col("c_custkey").cast("string"))).otherwise(value)
        out.append(value.alias(name))
    return rows.select("c_custkey", *out)


@query("""SELECT c_custkey, CASE c_custkey % 6 WHEN 1 THEN 'apt 5' WHEN 2 THEN '7' WHEN 3 THEN 'apt 3' WHEN 4 THEN '2f' END AS unit, CASE c_custkey % 6 WHEN 0 THEN 'front st' WHEN 2 THEN 'main st nw' WHEN 4 THEN '5 main ave' WHEN 5 THEN c_custkey || ' st' ELSE 'main st' END AS road,
  CASE WHEN c_custkey % 6 NOT IN (3, 5) THEN '02139' END AS postcode, CASE c_custkey % 6 WHEN 3 THEN 'a, b' END AS city, CASE c_custkey % 6 WHEN 5 THEN 'near c' END AS house FROM customer""")
def address_units(spark: SparkSession, d: str) -> DataFrame:
    """Units in the road, the second line, after a direction, in the post code and in a level."""
    rows = _kinds(_t(spark, d, "customer"), {
        "street2": {1: "Apt 5", 2: "suite"}, "postal_code": {k: "02139" for k in range(6)},
        "components": {0: '{"road":"front st","postcode":"02139"}', 1: '{"road":"main st","postcode":"02139"}', 2: '{"road":"main st nw # 7","postcode":"02139"}', 3: '{"road":"main st","postcode":"apt 3","suburb":"a","city":"b"}', 4: '{"road":"5 main ave 2f","level":"2f","house":"2f","postcode":"02139"}', 5: '{"road":"{} st","near":"c","category":"near"}'},
    })
    return addresses.repaired(rows).select("c_custkey", *(F.col(f"`parsed.{c}`").alias(c) for c in ("unit", "road", "postcode", "city", "house")))


@query("""WITH a AS (SELECT c_custkey, c_custkey % 50 AS n FROM customer WHERE c_custkey % 4 <> 0)
SELECT c_custkey AS customer_no, n || ' Main St' AS street1_cleaned, 'Dear ' || c_custkey AS salutation, count(*) OVER (PARTITION BY n, c_custkey % 2) > 1 AS possible_duplicate, c_custkey % 2 = 1 AS repeated_word FROM a""")
def street_list(spark: SparkSession, d: str) -> DataFrame:
    """The latest address of each member of a list, with flags over both lines, city and state."""
    c = _t(spark, d, "customer")
    none = {f"parsed.{x}": F.lit(None).cast("string") for x in addresses.PARSED} | {x: F.lit(None).cast("string") for x in ("matched_address", "formatted_address", "location_type", "postal_code", "country")}
    one = c.select(F.col("c_custkey").alias("customer_no"), F.col("c_custkey").alias("address_no"), F.lit("Y").alias("primary_ind"), F.concat((F.col("c_custkey") % 50).cast("string"), F.lit(" main st")).alias("street1"), F.lit("c").alias("city"), F.expr("CASE WHEN c_custkey % 2 = 1 THEN 'Main' ELSE 'side' END").alias("_second")).withColumns(none)
    one = one.withColumn("parsed.house", F.col("_second")).withColumns({"street2": F.lit(None).cast("string"), "state": F.lit("s"), "timestamp": F.lit("2024-01-02").cast("timestamp_ntz")}).drop("_second")
    older = one.withColumns({"street1": F.lit("old"), "timestamp": F.lit("2024-01-01").cast("timestamp_ntz")})
    other = one.withColumns({"street1": F.lit("not primary"), "primary_ind": F.lit("N"), "timestamp": F.lit("2024-01-03").cast("timestamp_ntz")})
    said = c.select(F.col("c_custkey").alias("customer_no"), F.concat(F.lit("Dear "), "c_custkey").alias("salutation"))
    out = addresses.street_cleaner(c.where("c_custkey % 4 <> 0").select(F.col("c_custkey").alias("customer_no")), one.unionByName(older).unionByName(other), said)
    return out.select("customer_no", "street1_cleaned", "salutation", "possible_duplicate", "repeated_word")


@query("SELECT event_id, user_id, CASE WHEN user_id % 3 <> 0 THEN 'user ' || user_id END AS said FROM events")
def memo_lookup(spark: SparkSession, d: str) -> DataFrame:
    """A function of a key, run for keys not met before: a third of the users is known from an earlier run."""
    e = _t(spark, d, "events").select("event_id", "user_id")
    work = lambda keys: pd.DataFrame({"said": [f"user {k}" if k % 3 else None for k in keys["user_id"]]})
    c = _catalog(spark)
    memoised(e.where("user_id % 3 = 1"), ["user_id"], work, "said string", c, "said")
    return memoised(e, ["user_id"], work, "said string", c, "said")


@query("SELECT c_custkey, c_acctbal + c_custkey % 97 * 100 < 9000 AND c_acctbal > 0 AS inside FROM customer")
def inside_polygon(spark: SparkSession, d: str) -> DataFrame:
    c = _t(spark, d, "customer")
    return c.select("c_custkey", addresses.inside(F.col("c_acctbal"), F.col("c_custkey") % 97 * 100.0, [(0.0, -1.0), (0.0, 9000.0), (9001.0, -1.0)]).alias("inside"))


def _corners() -> list[list[tuple[float, float]]]:
    """A coast of ten thousand corners, an island, and a lake in the mainland."""
    coast = [(100.0 + i * 7919 % 50, float(i)) for i in range(10_000)]
    return [[*coast, (0.0, 9999.0), (0.0, 0.0)], [(20.0, 2000.0), (60.0, 2000.0), (60.0, 4000.0), (20.0, 4000.0)], [(200.0, 100.0), (250.0, 100.0), (250.0, 300.0), (200.0, 300.0)]]


@query("""WITH p AS (SELECT event_id, event_id * 37 % 10000 AS i, event_id * 37 % 10000 + 0.25::DOUBLE AS lon, event_id * 13 % 2600 / 10.0::DOUBLE + 0.03::DOUBLE AS lat FROM events),
h AS (SELECT *, 100 + i * 7919 % 50 AS a, 100 + (i + 1) * 7919 % 50 AS b FROM p)
SELECT event_id, (i < 9999 AND lat < a + 0.25::DOUBLE * (b - a) AND NOT (lat BETWEEN 20 AND 60 AND lon BETWEEN 2000 AND 4000)) OR (lat BETWEEN 200 AND 250 AND lon BETWEEN 100 AND 300) AS inside FROM h""")
def inside_region(spark: SparkSession, d: str) -> DataFrame:
    """Points in a country of several parts with a hole, under a grid."""
    points = _t(spark, d, "events").select("event_id", (F.col("event_id") * 37 % 10000 + F.lit(0.25)).alias("lon"), (F.col("event_id") * 13 % 2600 / F.lit(10.0) + F.lit(0.03)).alias("lat"))
    return Region(_corners()).with_inside(points, "lat", "lon").select("event_id", "inside")


def _place(query: str, some: bool) -> dict | None:
    return {"lat": float(len(query)), "lon": 1.0, "matched_address": query.upper()} if some else None


#: Stand-ins for services, as rules about queries: the first takes batches, the second fails at times, the third is slow.
SERVICES = (
    Service("census", lambda asked: [_place(q, "main street" in q and q.endswith("3")) for q in asked], batch=50, tasks=2),
    Service("map", one_by_one(lambda q: _place(q, q.startswith("apt") or ("main st, " in q and len(q) % 2 == 0))), tasks=4),
    Service("open", one_by_one(lambda q: _place(q, q.startswith("town") and q.endswith("5"))), per_second=2000.0, tasks=2),
)


@query("""WITH a AS (SELECT c_custkey AS k, 'town' || (c_custkey % 7) AS city, CASE WHEN c_custkey % 11 <> 0 OR c_custkey % 2 = 0 THEN c_custkey || ' main st' END AS s1, CASE c_custkey % 3 WHEN 0 THEN 'apt ' || (c_custkey % 50) WHEN 1 THEN c_custkey || ' main st' END AS s2, CASE WHEN c_custkey % 2 = 0 THEN c_custkey || ' main street' END AS s0 FROM customer),
e AS (SELECT k, concat_ws(', ', s0, city) AS e0, concat_ws(', ', s1, city) AS e1, concat_ws(', ', s2, city) AS e2 FROM a),
x AS (SELECT k, e0, CASE WHEN e1 <> e0 THEN e1 END AS e1, CASE WHEN e2 <> e0 AND e2 <> e1 THEN e2 END AS e2 FROM e),
q AS (SELECT k, unnest([{'o': 0, 'q': e0}, {'o': 1, 'q': e1}, {'o': 2, 'q': e2}], recursive := true) FROM x),
h AS (SELECT k, q, o, 'census' AS service, 0 AS s FROM q WHERE contains(q, 'main street') AND ends_with(q, '3') UNION ALL SELECT k, q, o, 'map', 1 FROM q WHERE starts_with(q, 'apt') OR (contains(q, 'main st, ') AND length(q) % 2 = 0) UNION ALL SELECT k, q, o, 'open', 2 FROM q WHERE starts_with(q, 'town') AND ends_with(q, '5')),
f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY s, o) AS n FROM h) WHERE n = 1)
SELECT a.k AS c_custkey, f.service, f.q AS query, CAST(length(f.q) AS DOUBLE) AS lat, upper(f.q) AS matched_address FROM a LEFT JOIN f ON a.k = f.k""")
def geocode_cascade(spark: SparkSession, d: str) -> DataFrame:
    """Three services, three expressions: who answers first. A third of the addresses was asked for before."""
    k = F.col("c_custkey")
    none = F.lit(None).cast("string")
    rows = _t(spark, d, "customer").select(
        k, F.when((k % 11 != 0) | (k % 2 == 0), F.concat(k, F.lit(" main st"))).alias("street1"), F.when(k % 3 == 0, F.concat(F.lit("apt "), k % 50)).when(k % 3 == 1, F.concat(k, F.lit(" main st"))).alias("street2"),
        F.concat(F.lit("town"), k % 7).alias("city"), none.alias("state"), F.lit(" ").alias("postal_code"), none.alias("country"),
        F.when(k % 2 == 0, k.cast("string")).alias("parsed.house_number"), F.when(k % 2 == 0, F.lit("main street")).alias("parsed.road"),
    )
    c = _catalog(spark)
    addresses.geocode(rows.where("c_custkey % 3 = 1"), SERVICES, c)
    return addresses.geocode(rows, SERVICES, c).select("c_custkey", "service", "query", "lat", "matched_address")


@query("""SELECT CAST(2010 AS INTEGER) AS year, 'g' || n_nationkey AS GEOID, CAST(10 + n_nationkey AS DOUBLE) AS address_white_level, CASE WHEN n_nationkey % 4 = 0 THEN 0.0 ELSE CAST(20 + n_nationkey AS DOUBLE) END AS address_other_level, CAST(30 + n_nationkey AS DOUBLE) AS address_male_level, CAST(2 * (40 + n_nationkey) AS DOUBLE) AS address_under_5_years_level, CAST(3 * (50 + n_nationkey) AS DOUBLE) AS address_20_to_24_years_level, CAST(60 + n_nationkey AS DOUBLE) AS address_median_income_level FROM nation""")
def census_features(spark: SparkSession, d: str) -> DataFrame:
    """Races, sexes, finer ages added to bands, incomes; of 2010 the decennial set alone counts for people. What a place lacks is 0."""
    return _census(_t(spark, d, "nation"))


_BANDS = ["Under 5 years", "20 to 24 years"]


def _census(nation: DataFrame) -> DataFrame:
    spark = nation.sparkSession
    r = [("sf1", "P003002", "Total!!Population of one race!!White alone", "RACE", 10), ("sf1", "P003007", "Total!!Population of one race!!Some Other Race alone", "RACE", 20), ("sf1", "P003001", "Total", "RACE", 1), ("sf1", "P012002", "Total!!Male", "SEX BY AGE", 30)]
    r += [("sf1", f"P01201{i}", f"Total!!{s}!!Under 5 years", "SEX BY AGE", 40) for i, s in enumerate(("Male", "Female"))]
    r += [("sf1", f"P01202{i}", f"Total!!Male!!{a}", "SEX BY AGE", 50) for i, a in enumerate(("20 years", "21 years", "22 to 24 years"))]
    r += [("acs5/profile", "DP03_0062", "Estimate!!Median household income (dollars)", "ECONOMIC", 60), ("acs5/profile", "DP05_0002", "Estimate!!SEX AND AGE!!Male", "DEMOGRAPHIC", 5)]
    labels = spark.createDataFrame([(2010, *x[:4]) for x in r], "year int, dataset string, variable string, label string, concept string")
    each = F.array(*(F.struct(F.lit(x[0]).alias("dataset"), F.lit(x[1]).alias("variable"), F.lit(float(x[4])).alias("n")) for x in r))
    values = nation.select("n_nationkey", F.lit(2010).alias("year"), F.inline(each)).where("variable <> 'P003007' or n_nationkey % 4 <> 0")
    tables = values.select("year", "dataset", "variable", F.concat(F.lit("g"), "n_nationkey").alias("GEOID"), F.expr("CASE WHEN dataset = 'sf1' THEN n + n_nationkey END").alias("value"), F.expr("CASE WHEN dataset <> 'sf1' THEN n + n_nationkey END").alias("estimate"), F.lit(1.0).alias("moe"))
    domain = [f"address_{x}_level" for x in ("white", "other", "male", "under_5_years", "20_to_24_years", "median_income")]
    return census.features(census.data(tables, census.variables(labels)), _BANDS, domain)


_PLACES = ("white", "other", "male", "under_5_years", "20_to_24_years")


@query("""WITH f AS (SELECT 'g' || n_nationkey AS GEOID, y AS year, CAST(n_nationkey + y - 2010 AS DOUBLE) AS k, n_nationkey AS n FROM nation, (VALUES (2010), (2014)) AS v(y)),
g AS (SELECT GEOID, year, 10 + k AS address_white_level, CASE WHEN n % 4 = 0 THEN 0.0 ELSE 20 + k END AS address_other_level, 30 + k AS address_male_level, 2 * (40 + k) AS address_under_5_years_level, 3 * (50 + k) AS address_20_to_24_years_level, CASE WHEN n % 5 = 0 THEN 0.0 ELSE 60 + k END AS address_median_income_level FROM f),
a AS (SELECT c_custkey, 'g' || (c_nationkey + CASE WHEN c_custkey % 9 = 0 THEN 100 ELSE 0 END) AS GEOID, CASE WHEN c_custkey % 20 < 10 THEN 2010 ELSE 2014 END AS year FROM customer),
s AS (SELECT *, address_white_level + address_other_level + address_male_level + address_under_5_years_level + address_20_to_24_years_level AS total FROM g)
SELECT c_custkey, """ + ", ".join(f"address_{x}_level / total * 3 AS address_{x}_level" for x in _PLACES) + """, nullif(address_median_income_level, 0) AS address_median_income_level FROM a LEFT JOIN s ON a.GEOID = s.GEOID AND a.year = s.year""")
def address_census(spark: SparkSession, d: str) -> DataFrame:
    """Each address with its place's shares of the nearest year (2012 lies midway: the earlier), an income of 0 as null."""
    one = _census(_t(spark, d, "nation"))
    later = one.withColumns({"year": F.lit(2014), **{c: F.when(F.col(c) != 0, F.col(c) + w * 4).otherwise(0.0) for c, w in zip(one.columns[2:], (1, 1, 1, 2, 3, 1))}})
    table = one.unionByName(later).withColumn("address_median_income_level", F.when(F.substring("GEOID", 2, 9).cast("int") % 5 == 0, 0.0).otherwise(F.col("address_median_income_level")))
    at = F.make_timestamp_ntz(F.lit(2003) + F.col("c_custkey") % 20, F.lit(5), F.lit(1), F.lit(0), F.lit(0), F.lit(0))
    places = _t(spark, d, "customer").select("c_custkey", F.concat(F.lit("g"), F.col("c_nationkey") + F.when(F.col("c_custkey") % 9 == 0, 100).otherwise(0)).alias("GEOID"), at.alias("timestamp"))
    return census.address_census(places, table).drop("GEOID", "timestamp")


def _address_log(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """A log of changes of cities and flags, and the addresses as they are; several changes of one address fall on a day."""
    e = _t(spark, d, "events").where("event_type in ('click', 'view')")
    log = e.select(F.col("user_id").cast("string").alias("alternate_key"), F.col("ts").alias("date"), F.concat(F.lit("u"), F.col("event_id") % 3).alias("userid"), F.lit("Updated").alias("action"), F.expr("CASE event_type WHEN 'click' THEN 'city' ELSE 'primary_ind' END").alias("column_updated"), F.expr("CASE event_type WHEN 'click' THEN cast(event_id as string) WHEN 'view' THEN substring('YN', cast(event_id % 2 as int) + 1, 1) END").alias("new_value"), F.expr("CASE event_type WHEN 'click' THEN concat('o', event_id) ELSE 'N' END").alias("old_value"))
    none = {c: F.lit(None).cast("string") for c in addresses.COLUMNS}
    base = _t(spark, d, "customer").select(F.col("c_custkey").alias("address_no"), (F.col("c_custkey") * 3).alias("group_customer_no"), F.lit("2023-01-01").cast("timestamp_ntz").alias("create_dt"), F.lit("m").alias("created_by"), F.lit("2025-01-01").cast("timestamp_ntz").alias("last_update_dt"), F.lit("n").alias("last_updated_by"), F.lit("Y").alias("primary_ind")).withColumns(none | {"city": F.lit("now")})
    return log, base


_HISTORY = """l AS (SELECT user_id AS id, ts, 'u' || event_id % 3 AS who, CASE event_type WHEN 'click' THEN 'city' ELSE 'flag' END AS col, CASE event_type WHEN 'click' THEN CAST(event_id AS VARCHAR) ELSE substr('YN', event_id % 2 + 1, 1) END AS nv, CASE event_type WHEN 'click' THEN 'o' || event_id ELSE 'N' END AS ov FROM events WHERE event_type IN ('click', 'view')),
h AS (SELECT id, arg_min(ov, (ts, ov)) FILTER (col = 'city') AS city, arg_min(ov, (ts, ov)) FILTER (col = 'flag') AS flag FROM l GROUP BY id),
s AS (SELECT c_custkey AS id, TIMESTAMP '2023-01-01' AS ts, 'm' AS who, 0 AS r, city, flag FROM customer LEFT JOIN h ON c_custkey = id UNION ALL SELECT id, ts, who, 1, max(nv) FILTER (col = 'city'), max(nv) FILTER (col = 'flag') FROM l GROUP BY id, ts, who, ov UNION ALL SELECT c_custkey, TIMESTAMP '2025-01-01', 'n', 2, 'now', 'Y' FROM customer),
g AS (SELECT id, ts, who, r, coalesce(last_value(city IGNORE NULLS) OVER b, first_value(city IGNORE NULLS) OVER a) AS city, coalesce(last_value(flag IGNORE NULLS) OVER b, first_value(flag IGNORE NULLS) OVER a) AS flag FROM s
  WINDOW b AS (PARTITION BY id ORDER BY r, ts, who ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), a AS (PARTITION BY id ORDER BY r, ts, who ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
k AS (SELECT *, CAST(ts AS DATE) AS d FROM g), n AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id, d ORDER BY ts DESC, r DESC) AS n FROM k) WHERE n = 1),
y AS (SELECT n.id AS address_no, d AS "timestamp", CASE r WHEN 0 THEN 'Creation' WHEN 1 THEN 'Change' ELSE 'Current' END AS event_subtype, who AS last_updated_by, c_custkey * 3 AS group_customer_no, city, flag AS primary_ind FROM n LEFT JOIN customer ON n.id = c_custkey)"""


@query(f"WITH {_HISTORY} SELECT * FROM y")
def address_history(spark: SparkSession, d: str) -> DataFrame:
    """One row per address and day: the last state of the day."""
    return addresses.history(*_address_log(spark, d)).select("address_no", "timestamp", "event_subtype", "last_updated_by", "group_customer_no", "city", "primary_ind")


@query(f"""WITH {_HISTORY} SELECT address_no, "timestamp", group_customer_no, city, event_subtype, 'Address' AS event_type FROM y WHERE primary_ind = 'Y' AND group_customer_no >= 200""")
def address_stream(spark: SparkSession, d: str) -> DataFrame:
    """The stream of primary addresses of real households, read from where it was written."""
    rows = addresses.history(*_address_log(spark, d)).withColumn("event_type", F.lit("Address"))
    return addresses.address_stream(_catalog(spark), rows, ["address_no", "timestamp", "group_customer_no", "city", "event_subtype", "event_type"])


@query("""WITH p AS (SELECT event_id, event_id * 37 % 500 + 0.25::DOUBLE AS lon, event_id % 300 + 0.5::DOUBLE AS lat, CASE WHEN event_id % 4 = 0 THEN 't' || event_id END AS tract FROM events)
SELECT event_id, lat, lon, CASE WHEN tract IS NOT NULL THEN tract WHEN lon < 100 OR lon > 300 OR lat < 200 OR lat > 250 OR CAST(floor(lat) AS BIGINT) % 7 = 0 THEN NULL ELSE 'tract ' || CAST(floor(lat) AS BIGINT) || ' ' || CAST(floor(lon) AS BIGINT) END AS tract FROM p""")
def reverse_census(spark: SparkSession, d: str) -> DataFrame:
    """Tracts by coordinates where they are missing and lie in the country; the service fails for some."""

    def ask(lat: float, lon: float) -> str | None:
        if int(lat) % 7 == 0:
            raise OSError
        return f"tract {int(lat)} {int(lon)}"

    points = _t(spark, d, "events").select("event_id", (F.col("event_id") % 300 + F.lit(0.5)).alias("lat"), (F.col("event_id") * 37 % 500 + F.lit(0.25)).alias("lon"), F.expr("CASE WHEN event_id % 4 = 0 THEN concat('t', event_id) END").alias("tract"))
    island = Region(_corners()[2:])
    return addresses.reverse_census(points, ask, island, _catalog(spark), tasks=4).select("event_id", "lat", "lon", "tract")


@query("""SELECT kind, id, said FROM (SELECT 'logs' AS kind, CAST(c_custkey + 1 AS VARCHAR) AS id, c_name AS said FROM customer UNION ALL SELECT 'contacts', CAST(c_custkey AS VARCHAR), CASE WHEN c_custkey % 3 = 0 THEN 'new' ELSE c_name END FROM customer UNION ALL SELECT 'campaigns', CAST(n_nationkey AS VARCHAR), n_name || ' later' FROM nation
  UNION ALL SELECT 'contactLists', CAST(r_regionkey AS VARCHAR), r_name FROM region WHERE r_regionkey > 1)""")
def marketing_update(spark: SparkSession, d: str) -> DataFrame:
    """The local copy of the service brought up to date twice: whole tables, one replaced, changed contacts, logs beyond the greatest id."""
    c, n, r = _t(spark, d, "customer"), _t(spark, d, "nation"), _t(spark, d, "region")
    text = lambda k: F.col(k).cast("string").alias("id")

    def service(later: bool):
        def load(table: str, offset: int = 0, updated_after: str | None = None, field: str | None = None) -> DataFrame:
            if table == "logs":
                seen = c.where(F.lit(later) | (F.col("c_custkey") < 50))
                return seen.where(F.col("c_custkey") + 1 > offset).select((F.col("c_custkey") + 1).cast("string").alias("id"), F.col("c_name").alias("said"))
            if table == "contacts":
                fresh = c.where((F.col("c_custkey") % 3 == 0) | F.lit(updated_after is None))
                said = F.when((F.col("c_custkey") % 3 == 0) & F.lit(later), "new").otherwise(F.col("c_name"))
                return fresh.select(text("c_custkey"), said.alias("said"), F.lit("2024-02-01" if later else "2024-01-01").alias("updated_timestamp"))
            if table == "campaigns":
                return n.select(text("n_nationkey"), (F.concat("n_name", F.lit(" later")) if later else F.col("n_name")).alias("said"))
            if table == "contactLists":
                return r.where(F.col("r_regionkey") > (1 if later else -1)).select(text("r_regionkey"), F.col("r_name").alias("said"))
            return r.limit(0).select(text("r_regionkey"))

        return load

    kept = _catalog(spark)
    for later in (False, True):
        marketing.update(kept, service(later))
    parts = [kept.read(k).select(F.lit(k).alias("kind"), "id", "said") for k in ("logs", "contacts", "campaigns", "contactLists")]
    return reduce(lambda a, b: a.unionByName(b), parts)


@query("""WITH a AS (SELECT event_id AS address_no, user_id AS group_customer_no, ts AS "timestamp", CASE WHEN event_id % 3 = 0 THEN 'apt ' || event_id END AS street2, CASE WHEN event_id % 2 = 0 THEN 'Y' END AS primary_ind FROM events WHERE event_type = 'click'),
s AS (SELECT user_id, ts, event_id, value FROM events WHERE event_type = 'purchase' AND user_id % 4 <> 0), t AS (SELECT DISTINCT group_customer_no AS h, "timestamp" AS near FROM a),
b AS (SELECT s.event_id, t.near FROM s ASOF JOIN t ON s.user_id = t.h AND s.ts >= t.near), f AS (SELECT s.event_id, t.near FROM s ASOF JOIN t ON s.user_id = t.h AND s.ts <= t.near),
p AS (SELECT s.*, CASE WHEN f.near IS NULL OR s.ts - b.near <= f.near - s.ts THEN b.near ELSE f.near END AS near FROM s LEFT JOIN b ON s.event_id = b.event_id LEFT JOIN f ON s.event_id = f.event_id),
l AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id, near ORDER BY ts DESC, event_id DESC) AS n FROM p WHERE near IS NOT NULL) WHERE n = 1),
j AS (SELECT a.*, CASE WHEN l.event_id % 5 <> 0 THEN l.value END AS v, l.event_id AS e FROM a LEFT JOIN l ON a.group_customer_no = l.user_id AND a."timestamp" = l.near)
SELECT address_no, group_customer_no, "timestamp", street2, primary_ind, 'Address' AS event_type, last_value(v IGNORE NULLS) OVER w AS address_pro_score_level, last_value(e IGNORE NULLS) OVER w AS address_capacity_level, """ + ", ".join(f"last_value(CASE WHEN e % {k} = 0 THEN v END IGNORE NULLS) OVER w AS address_{x}_level" for k, x in ((2, "properties"), (3, "donations"))) + """
FROM j WINDOW w AS (PARTITION BY group_customer_no ORDER BY "timestamp", address_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")
def address_build(spark: SparkSession, d: str) -> DataFrame:
    """Addresses with their household's scores, which alone are filled forward: second lines and flags stay what they are."""
    e = _t(spark, d, "events")
    rows = e.where("event_type = 'click'").select(F.col("event_id").alias("address_no"), F.col("user_id").alias("group_customer_no"), F.col("ts").alias("timestamp"))
    more = rows.select("address_no", "timestamp", F.expr("CASE WHEN address_no % 3 = 0 THEN concat('apt ', address_no) END").alias("street2"), F.expr("CASE WHEN address_no % 2 = 0 THEN 'Y' END").alias("primary_ind"))
    worth = F.when(F.col("event_id") % 5 != 0, F.col("value"))
    scores = e.where("event_type = 'purchase' and user_id % 4 <> 0").select(F.col("user_id").alias("group_customer_no"), F.col("ts").alias("score_dt"), "event_id", worth.alias("pro_score"), F.col("event_id").alias("capacity_value"), F.when(F.col("event_id") % 2 == 0, worth).alias("properties_total_value"), F.when(F.col("event_id") % 3 == 0, worth).alias("donations_total_value"))
    return addresses.build(rows, [more], scores, tie=["event_id"])


@query("""SELECT 'p' || c_custkey || '@q.com' AS email, TIMESTAMP '1899-12-30' + INTERVAL 45000 DAY + INTERVAL (c_custkey % 100) DAY AS "timestamp", question, subquestion, answer FROM (
  SELECT c_custkey, 'Like' AS question, 'Tea' AS subquestion, c_mktsegment AS answer FROM customer UNION ALL SELECT c_custkey, 'Like', 'Milk', CASE WHEN c_custkey % 2 = 0 THEN 'yes' END FROM customer UNION ALL SELECT c_custkey, 'Number', NULL, CAST(c_nationkey AS VARCHAR) FROM customer) WHERE answer IS NOT NULL""")
def survey_answers(spark: SparkSession, d: str) -> DataFrame:
    """A wide sheet as long answers; the columns of e-mails and times are found by what they hold."""
    c = _t(spark, d, "customer")
    sheet = c.select(F.col("c_nationkey").cast("string").alias("c0"), F.concat(F.lit("p"), "c_custkey", F.lit("@q.com")).alias("c1"), (45000 + F.col("c_custkey") % 100).cast("string").alias("c2"), F.concat(F.lit(' xml:space="preserve">'), "c_mktsegment").alias("c3"), F.expr("CASE WHEN c_custkey % 2 = 0 THEN 'yes' END").alias("c4"))
    return surveys.melt(sheet, {"c0": ("Number", None), "c1": ("Mail", None), "c2": ("When", None), "c3": ("Like", "Tea"), "c4": ("Like", "Milk")})


def _hash(column: str) -> str:
    text = f"CAST({column} AS VARCHAR)"
    return _hmac("second", _hmac("first", text) + f" || '-' || {text}")


@query(f"""WITH a AS (SELECT c_custkey AS n, c_custkey % 40 AS g FROM customer)
SELECT {_hash("n")} AS customer_hash, {_hash("g")} AS group_customer_hash, 'Like' AS question, 'q' || (n % 5) AS answer, 'Two' AS survey, t.total FROM a JOIN (SELECT o_custkey % 40 AS k, count(*) AS total FROM orders GROUP BY 1) t ON a.g = t.k""")
def survey_hashed(spark: SparkSession, d: str) -> DataFrame:
    """Respondents that are known by e-mail or by the number they gave, as hashes, and payments of their household."""
    c = _t(spark, d, "customer").select(F.col("c_custkey").cast("int").alias("customer_no"), (F.col("c_custkey") % 40).alias("group_customer_no"))
    at = F.lit("2024-01-05").cast("timestamp_ntz")
    mail = F.concat(F.lit("P"), "customer_no", F.lit("@q.com "))
    base = c.select(mail.alias("email"), at.alias("timestamp"), "customer_no")
    rows = base.select("email", "timestamp", F.lit("Like").alias("question"), F.lit("Tea").alias("subquestion"), F.concat(F.lit("q"), F.col("customer_no") % 5).alias("answer"))
    rows = rows.unionByName(base.select("email", "timestamp", F.lit("Your number").alias("question"), F.lit(None).cast("string").alias("subquestion"), F.col("customer_no").cast("string").alias("answer")))
    emails = c.where("customer_no % 2 = 0").select("customer_no", "group_customer_no", F.lit("Y").alias("primary_ind"), F.lit("2023-01-05").cast("timestamp_ntz").alias("timestamp"), mail.alias("address"))
    out = surveys.survey_stream([("/in/Two.xlsx", rows)], emails, c, ("first", "second"))
    paid = _t(spark, d, "orders").select((F.col("o_custkey") % 40).alias("group_customer_no"), "o_orderkey")
    return surveys.append_features(out, [paid], ("first", "second"), [F.count("o_orderkey").alias("total")]).select("customer_hash", "group_customer_hash", "question", "answer", "survey", "total")


@query(r"""SELECT event_id, length(event_type || ',' || user_id || ',,') - length(replace(event_type || ',' || user_id || ',,', ',', '')) AS separators, event_type || '.v' AS stem, TIMESTAMP '1899-12-30' + INTERVAL (event_id % 40000) DAY + INTERVAL 12 HOUR AS excel,
  CASE WHEN event_id % 3 < 2 THEN date_trunc('second', ts) END AS epoch, CASE WHEN event_id % 5 <> 0 THEN greatest(value, user_id, event_id % 50) END AS capacity FROM events""")
def text_and_dates(spark: SparkSession, d: str) -> DataFrame:
    from rivulet.operators.matching import _capacity

    e = _t(spark, d, "events")
    at = F.expr("CASE event_id % 3 WHEN 0 THEN cast(unix_seconds(cast(ts as timestamp)) as string) WHEN 1 THEN date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss'Z'\") ELSE 'never' END")
    df = _capacity(e.withColumns({"memb_amt": F.col("value"), "AVC_amt": F.lit(0.0), "recog_amt": F.expr("CASE WHEN event_id % 5 <> 0 THEN cast(user_id as double) END"), "start_amt": (F.col("event_id") % 50).cast("double")}))
    return df.select("event_id", separators(F.concat("event_type", F.lit(","), "user_id", F.lit(",,"))).cast("long").alias("separators"), file_stem(F.concat(F.lit("/in/"), "event_type", F.lit(".v.xlsx"))).alias("stem"), excel_time((F.col("event_id") % 40000) + 0.5).alias("excel"), epoch_time(at).alias("epoch"), F.col("value_amt").alias("capacity"))


@query("SELECT CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, event_id AS id FROM events")
def json_rows(spark: SparkSession, d: str) -> DataFrame:
    texts = _t(spark, d, "events").select(F.concat(F.lit("["), F.expr("substring(props, 1, length(props) - 1)"), F.lit(', "id": '), "event_id", F.lit("}]")).alias("text"))
    return from_json_text(spark, texts, "text").select(F.col("k").cast("long").alias("k"), F.col("id").cast("long").alias("id"))


@query("SELECT n_nationkey AS id, n_name AS name, NULL AS note FROM nation UNION ALL SELECT r_regionkey, NULL, r_name FROM region")
def pages_combined(spark: SparkSession, d: str) -> DataFrame:
    one = _t(spark, d, "nation").select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"))
    two = _t(spark, d, "region").select(F.col("r_regionkey").alias("id"), F.col("r_name").alias("note"))
    return combine_pages([{"things": one, "": two}, {"things": two}])["things"]


#: Rows of a block of the stand-in service's table.
BLOCK = 10_000


def _things(spark: SparkSession, d: str, changed: bool = False, later: bool = False) -> dict[str, object]:
    """The customers as a service's table, laid out in blocks of rows, a folder each: in the order of their keys or, if changed, of
    their last change, which for each third is later in a later state."""
    rows = numbered(_t(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey"), ["c_custkey"], "at")
    i = F.col("at") - 1
    clock = F.format_string("%02d:%02d:%02d", F.expr("(at - 1) div 3600 % 24"), F.expr("(at - 1) div 60 % 60"), i % 60)
    again = F.lit(later) & (F.col("c_custkey") % 3 == 0)
    told = rows.select("at", "c_custkey", F.when(again, "new").otherwise(F.col("c_name")).alias("name"), "c_nationkey", F.concat(F.when(again, "2024-02-02T").otherwise("2024-01-01T"), clock).alias("updated"))
    laid = numbered(told.drop("at"), ["updated", "c_custkey"], "at") if changed else told
    at = f"{shared_dir(spark)}/things-{uuid.uuid4().hex}"
    blocks = laid.withColumn("block", F.expr(f"(at - 1) div {BLOCK}")).repartition("block").sortWithinPartitions("block", "at")
    blocks.write.partitionBy("block").parquet(at)
    for held in (rows, laid):
        discard(held)
    return {"at": at, "rows": spark.read.parquet(at).count()}


@lru_cache(maxsize=8)
def _block(at: str, block: int) -> list[dict]:
    import pyarrow.parquet as pq
    from pyarrow import fs

    store, folder = fs.FileSystem.from_uri(f"{at}/block={block}")
    files = [x.path for x in store.get_file_info(fs.FileSelector(folder)) if x.path.endswith(".parquet")]
    rows = [r for f in files for r in pq.ParquetFile(store.open_input_file(f)).read().to_pylist()]
    return [{"id": str(r["c_custkey"]), "name": r["name"], "x": {"y": r["c_nationkey"]}, "updated": r["updated"]} for r in rows]


def table_service(method: str, url: str, key: str, body: object = None) -> tuple[int, object]:
    """Stands in for a service over the customer table: an answer reads the blocks that its rows lie in. What it shows is told by the
    address: a table's layout and, of that, a number of rows. Times of change are asked of a layout in their order."""
    asked = {k: v[0] for k, v in parse_qs(urlparse(url).query).items()}
    row = lambda i: _block(asked["at"], i // BLOCK)[i % BLOCK]
    shown = min(int(asked["rows"]), int(asked.get("shown", 1 << 60)))
    after = asked.get("filters[updated_after]")
    places = range(bisect_right(range(shown), after, key=lambda i: row(i)["updated"]) if after else 0, shown)
    if "orders[updated]" in asked:
        places = places[::-1]
    at = int(asked.get("offset", 0))
    return 200, {"things": [row(i) for i in places[at : at + int(asked["limit"])]], "meta": {"total": str(len(places))}}


def _service_at(d: str, table: dict[str, object] | None = None, **state: object) -> dict[str, str]:
    table = table or _things(SparkSession.active(), d)
    return {"url": rest.paged_url("http://service/api/things", **table, **state), "transport": "rivulet.plan_queries:table_service"}


@query("""SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name, '{"y": ' || c_nationkey || '}' AS x FROM customer""")
def rest_pages(spark: SparkSession, d: str) -> DataFrame:
    """A paginated source, one partition a page or a run of pages."""
    spark.dataSource.register(rest.PagedSource)
    return spark.read.format("paged_rest").options(**_service_at(d)).schema("id string, name string, x string").load()


@query("SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name FROM customer")
def rest_growing(spark: SparkSession, d: str) -> DataFrame:
    """A table that grows, followed as a stream in three goes, the last without news: each row once."""
    c, name, table = _catalog(spark), uuid.uuid4().hex, _things(spark, d)
    for shown in (70, 1 << 40, 1 << 40):
        follow_service(spark, _service_at(d, table, shown=shown), "id string, name string", c, "things", query=name).awaitTermination()
    return c.read("things")


@query("SELECT CAST(c_custkey AS VARCHAR) AS id, CASE WHEN c_custkey % 3 = 0 THEN 'new' ELSE c_name END AS name FROM customer")
def rest_changed(spark: SparkSession, d: str) -> DataFrame:
    """Rows by the time of their change: what changed comes again and is merged by id."""
    c, name = _catalog(spark), uuid.uuid4().hex
    for later in (False, True):
        follow_service(spark, _service_at(d, _things(spark, d, True, later)) | {"changed": "updated"}, "id string, name string, updated string", c, "things", ["id"], query=name).awaitTermination()
    return c.read("things").select("id", "name")


@query("""SELECT 'Nation ' || c_nationkey AS survey, 'p' || c_custkey || '@q.com' AS email, TIMESTAMP '1899-12-30' + INTERVAL 45000 DAY + INTERVAL (c_custkey % 100) DAY + INTERVAL 12 HOUR AS "timestamp", question, subquestion, answer FROM (
  SELECT c_custkey, c_nationkey, 'Like' AS question, 'Tea' AS subquestion, c_mktsegment AS answer FROM customer UNION ALL SELECT c_custkey, c_nationkey, 'Like', 'Milk', CASE WHEN c_custkey % 2 = 0 THEN 'yes & no' END FROM customer UNION ALL SELECT c_custkey, c_nationkey, 'Number', NULL, CAST(c_custkey AS VARCHAR) FROM customer) WHERE answer IS NOT NULL""")
def survey_workbooks(spark: SparkSession, d: str) -> DataFrame:
    """A workbook for each nation, its columns in another order for every second one, written and read by tasks."""
    at = f"{shared_dir(spark)}/books-{uuid.uuid4().hex}"

    def book(rows: pd.DataFrame) -> pd.DataFrame:
        from pyarrow import fs

        n = int(rows["c_nationkey"].iloc[0])
        turn = (lambda x: x[::-1]) if n % 2 else (lambda x: x)
        # a blank question is the one before, so the two lines of the same question stand together
        heads = [("When", None), ("Mail", None), ("Number", None)], [("Like", "Tea"), (None, "Milk")]
        lines = [[q for q, _ in turn(heads[0]) + heads[1]], [s for _, s in turn(heads[0]) + heads[1]]]
        for r in rows.itertuples(index=False):
            lines.append([*turn([45000.5 + r.c_custkey % 100, f"p{r.c_custkey}@q.com", str(r.c_custkey)]), r.c_mktsegment, "yes & no" if r.c_custkey % 2 == 0 else None])
        store, folder = fs.FileSystem.from_uri(at)
        store.create_dir(folder)
        with store.open_output_stream(f"{folder}/Nation {n}.xlsx") as out:
            out.write(xlsx(lines))
        return pd.DataFrame({"n": [n]})

    made = _t(spark, d, "customer").select("c_custkey", "c_nationkey", "c_mktsegment").groupBy("c_nationkey").applyInPandas(book, "n int")
    made.agg(F.sum("n")).collect()
    read = surveys.read_files(spark, at)
    return read.select(F.regexp_replace(file_stem(F.url_decode("filename")), "%20", " ").alias("survey"), "email", "timestamp", "question", "subquestion", "answer")


@query(f"""SELECT ref_no, CASE WHEN ref_no % 5 = 0 AND ref_no % 100 < 80 THEN ref_no % 100 ELSE group_customer_no END AS customer_no, CASE WHEN ref_no % 5 = 0 AND ref_no % 100 < 80 THEN ref_no % 100 % 10 ELSE group_customer_no % 10 END AS house, CASE WHEN ref_no % 3 = 0 THEN ref_no + 1 END AS cust_memb_no, CASE WHEN month(cont_dt) < 10 THEN 'c' || month(cont_dt) END AS campaign_category_desc FROM ({_PAID})""")
def contribution_load(spark: SparkSession, d: str) -> DataFrame:
    """Payments with their membership, their creditee's household (a fifth of the creditees has none) and their campaign."""
    p = _payments(spark, d).select("ref_no", F.col("group_customer_no").alias("customer_no"), (F.col("group_customer_no") % 10).alias("group_customer_no"), F.month("cont_dt").alias("campaign_no"))
    links = p.where("ref_no % 3 = 0").select("ref_no", (F.col("ref_no") + 1).alias("cust_memb_no"))
    credit = p.where("ref_no % 5 = 0").select("ref_no", (F.col("ref_no") % 100).alias("creditee_no"))
    campaigns = spark.range(1, 10).select(F.col("id").cast("int").alias("campaign_no"), F.concat(F.lit("c"), "id").alias("campaign_category_desc"))
    homes = spark.range(80).select(F.col("id").alias("customer_no"), (F.col("id") % 10).alias("group_customer_no"))
    members = links.select("cust_memb_no", F.lit(1).alias("campaign_no"), F.lit("L").alias("memb_level"), F.lit("Active").alias("current_status_desc"))
    levels = spark.range(1).select(F.lit("L").alias("memb_level"), F.lit("Level").alias("level_desc"))
    pays, _ = contributions.load(p, links, credit, members, campaigns, levels, homes)
    return pays.select("ref_no", "customer_no", F.col("group_customer_no").alias("house"), "cust_memb_no", "campaign_category_desc")


@query("SELECT c_custkey AS id, CASE WHEN c_custkey % 2 = 0 THEN 'new' ELSE c_name END AS email, CASE WHEN c_custkey % 2 = 1 THEN 1 END AS \"tags.a\" FROM customer")
def marketing_contacts(spark: SparkSession, d: str) -> DataFrame:
    """Contacts loaded whole, then those that changed merged in, nested columns spread."""
    c, catalog = _t(spark, d, "customer"), _catalog(spark)
    tags = F.from_json(F.lit(json.dumps({"a": 1})), "struct<a:int>")
    marketing.store(catalog, "contacts", c.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("email"), tags.alias("tags")), overwrite=True)
    return marketing.store(catalog, "contacts", c.where("c_custkey % 2 = 0").select(F.col("c_custkey").alias("id"), F.lit("new").alias("email"), F.struct(F.lit(None).cast("int").alias("a")).alias("tags")))
