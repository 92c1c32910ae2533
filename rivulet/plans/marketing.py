"""An e-mail marketing service's tables as a stream, and its contacts against the customer records."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rivulet.catalog import Catalog
from rivulet.functions.text import epoch_time
from rivulet.operators.asof import asof_join
from rivulet.operators.debounce import debounce
from rivulet.operators.nested import widen_all
from rivulet.operators.upsert import upsert

#: The contact field that holds the customer number.
CUSTOMER_FIELD = "1"


def _long(c: str) -> F.Column:
    return F.col(c).cast("string").try_cast("bigint")


def _mail(c: str) -> F.Column:
    return F.trim(F.lower(F.col(c)))


def store(catalog: Catalog, name: str, rows: DataFrame, overwrite: bool = False) -> DataFrame:
    """Nested columns spread, one row per id (the first), none without; replaced or merged by id."""
    flat = widen_all(rows).where(F.col("id").isNotNull())
    flat = debounce(flat, ["id"], [c for c in flat.columns if c != "id"] or ["id"], keep="first")
    return catalog.overwrite(name, flat) if overwrite else catalog.merge(name, flat, ["id"])


def update(catalog: Catalog, load: Callable[..., DataFrame], full: tuple[str, ...] = ("campaigns", "messages", "links", "lists", "bounceLogs"), growing: tuple[str, ...] = ("logs", "linkData", "mppLinkData")) -> None:
    """Brings the catalog up to the service: some tables whole, contacts since the last change, growing ones from the
    greatest id on. load(table, **arguments) gives a table's rows."""
    for t in full:
        store(catalog, t, load(t))
    store(catalog, "contactLists", load("contactLists"), overwrite=True)
    store(catalog, "fieldValues", load("fieldValues", field=CUSTOMER_FIELD))
    store(catalog, "contacts", load("contacts", updated_after=catalog.high_water("contacts", "updated_timestamp")))
    for t in growing:
        mark = catalog.read(t).agg(F.max(_long("id"))).first()[0] if catalog.exists(t) else None
        store(catalog, t, load(t, offset=mark or 0))


def email_map(customers_by_email: DataFrame, contacts: DataFrame, field_values: DataFrame, households: DataFrame) -> DataFrame:
    """email, customer_no, subscriberid (the greatest of the e-mail), group_customer_no; distinct, without nulls.

    customers_by_email: customer_no, address of primary e-mails. A contact's customer brings in all customers that
    share the contact's e-mail."""
    c = contacts.select(_long("id").alias("subscriberid"), _mail("email").alias("email"))
    told = field_values.where(F.col("field") == CUSTOMER_FIELD).select(_long("contact").alias("subscriberid"), F.col("value").cast("string").try_cast("int").alias("customer_no"))
    by_contact = c.join(told, "subscriberid", "left")
    by_mail = customers_by_email.select(_mail("address").alias("email"), F.col("customer_no").cast("int").alias("customer_no"))
    both = by_contact.unionByName(by_mail.withColumn("subscriberid", F.lit(None).cast("long")))
    both = both.withColumn("subscriberid", F.max("subscriberid").over(Window.partitionBy("email")))
    home = households.select(F.col("customer_no").cast("int").alias("customer_no"), "group_customer_no").distinct()
    return both.join(home, "customer_no", "left").dropna().distinct().select("email", "customer_no", "subscriberid", "group_customer_no")


def events(logs: DataFrame, links: DataFrame, machine_links: DataFrame, bounces: DataFrame, contact_lists: DataFrame) -> DataFrame:
    """Sends, opens and clicks, bounces and list states of subscribers, one under the other."""
    sends = logs.select(epoch_time(F.col("tstamp")).alias("timestamp"), _long("subscriberid").alias("subscriberid"), _long("campaignid").alias("campaignid"), _long("messageid").alias("messageid"), F.lit("Send").alias("event_subtype"))

    def opened(df: DataFrame) -> DataFrame:
        read = F.when(F.col("isread").cast("string").isin("1", "true"), "Open").when(F.col("isread").isNotNull(), "Click")
        kept = [c for c in ("times", "ip", "ua", "uasrc", "referer") if c in df.columns]
        return df.where("messageid <> '0'").select(epoch_time(F.col("tstamp")).alias("timestamp"), _long("subscriberid").alias("subscriberid"), _long("campaignid").alias("campaignid"), _long("messageid").alias("messageid"), _long("link").alias("linkid"), read.alias("event_subtype"), *kept)

    soft = bounces.where("email <> ''").select(epoch_time(F.col("tstamp")).alias("timestamp"), _long("subscriberid").alias("subscriberid"), F.lit("Soft Bounce").alias("event_subtype"))
    state = F.when(F.col("status") == "2", "Unsubscribe").otherwise("Hard Bounce")
    left = contact_lists.where("status <> '1'").select(epoch_time(F.col("updated_timestamp")).alias("timestamp"), _long("contact").alias("subscriberid"), _long("campaign").alias("campaignid"), _long("message").alias("messageid"), _long("list").alias("listid"), state.alias("event_subtype"))
    out = sends
    for part in (opened(links), opened(machine_links), soft, left):
        out = out.unionByName(part, allowMissingColumns=True)
    return out.withColumn("event_type", F.lit("Email"))


def build(event_rows: DataFrame, mapped: DataFrame) -> DataFrame:
    """Events of every customer that the subscriber stands for."""
    return event_rows.join(mapped, "subscriberid", "left")


def enrich(rows: DataFrame, campaigns: DataFrame, messages: DataFrame, links: DataFrame, lists: DataFrame) -> DataFrame:
    """rows with the columns of their campaign, message, link and list; no row is added."""
    for dim, key, prefix in ((campaigns, "campaignid", "campaign"), (messages, "messageid", "message"), (links, "linkid", "link"), (lists, "listid", "list")):
        one = dim.withColumn(key, _long("id")).drop("id").dropDuplicates([key])
        one = one.withColumnsRenamed({c: f"{prefix}_{c}" for c in one.columns if c != key and c in rows.columns or c == "name"})
        rows = rows.join(one, key, "left")
    return rows


def marketing_stream(catalog: Catalog, tables: Mapping[str, DataFrame], mapped: DataFrame) -> DataFrame:
    """Builds and writes the plain stream and the enriched one."""
    plain = build(events(tables["logs"], tables["linkData"], tables["mppLinkData"], tables["bounceLogs"], tables["contactLists"]), mapped)
    catalog.overwrite("marketing_stream", plain)
    return catalog.overwrite("marketing_stream_enriched", enrich(catalog.read("marketing_stream"), tables["campaigns"], tables["messages"], tables["links"], tables["lists"]))


def orphans(contacts: DataFrame, field_values: DataFrame, contact_lists: DataFrame, households: DataFrame, primary_emails: DataFrame) -> DataFrame:
    """Active list members with a customer number whose e-mail isn't a primary one of the household."""
    active = contact_lists.where("status = '1'").select(_long("contact").alias("id")).distinct()
    told = field_values.where(F.col("field") == CUSTOMER_FIELD).select(_long("contact").alias("id"), F.col("value").cast("string").try_cast("int").alias("customer_no"))
    home = households.select(F.col("customer_no").cast("int").alias("customer_no"), "group_customer_no").distinct()
    rows = contacts.select(_long("id").alias("id"), _mail("email").alias("address")).join(active, "id").join(told, "id").join(home, "customer_no").distinct()
    known = primary_emails.select(_mail("address").alias("address"), "group_customer_no").distinct()
    return rows.join(known, ["address", "group_customer_no"], "left_anti").select("id", "address", "customer_no", "group_customer_no")


def changed_emails(history: DataFrame, since: object, now: object) -> DataFrame:
    """from, to, timestamp, last_updated_by: each primary address that gave way to another after since.

    history: states of e-mail records (group_customer_no, customer_no, eaddress_no, timestamp, primary_ind, inactive,
    address, last_updated_by); those without a customer or an address are left out before all else. A primary state lasts until its record's next state, which says who changed it; its successor
    is the primary state of the customer begun last by that end, or, if none is, the one that ended last before it."""
    w = Window.partitionBy("eaddress_no").orderBy("timestamp", "address")
    far = F.lit(now).cast("timestamp_ntz") + F.expr("INTERVAL 36525 DAYS")
    told = history.where("customer_no is not null and address is not null")
    rows = told.withColumns({"end": F.lead("timestamp", 1).over(w), "by": F.lead("last_updated_by", 1).over(w), "address": _mail("address")})
    rows = rows.withColumn("end", F.coalesce("end", far))
    primary = rows.where("primary_ind = 'Y'")
    starts = primary.select("customer_no", F.col("timestamp").alias("start"), F.col("address").alias("to"), "eaddress_no")
    pairs = asof_join(primary.select("customer_no", "group_customer_no", F.col("address").alias("from"), "timestamp", "end", "by"), starts, ["customer_no"], "end", "start", ["to"], tie=["eaddress_no"])
    earlier = primary.select("customer_no", (F.col("end") - F.expr("INTERVAL 0.001 SECOND")).alias("stop"), F.col("address").alias("before"), "eaddress_no")
    pairs = asof_join(pairs, earlier, ["customer_no"], "end", "stop", ["before"], tie=["eaddress_no"])
    pairs = pairs.withColumn("to", F.coalesce("to", "before")).where((F.col("to") != F.col("from")) & (F.col("end") > F.lit(since).cast("timestamp_ntz")))
    pairs = pairs.select("customer_no", "group_customer_no", "from", "to", F.col("end").alias("timestamp"), F.col("by").alias("last_updated_by"))
    return debounce(pairs, ["from"], ["timestamp", "to"])


def resolve(from_known: bool, to_free: bool, customer_matches: bool) -> str:
    """What to do with an orphan: update (its address is in the service, the new one isn't, and the customer number there is
    one of those given), tag (the new one is in use, or there is none) or nothing."""
    if not (from_known and customer_matches):
        return "nothing"
    return "update" if to_free else "tag"


def resolutions(changes: DataFrame, contacts: DataFrame, field_values: DataFrame) -> DataFrame:
    """changes (from, to, customer_no) with id, the contact of from, and action: update, tag or nothing, as `resolve` has it.

    The three tests are looked up in the service's tables; a `to` that is null or empty is never free. Of several contacts
    of an address the smallest id counts."""
    told = field_values.where(F.col("field") == CUSTOMER_FIELD).groupBy(_long("contact").alias("id")).agg(F.collect_set(F.col("value").cast("string").try_cast("bigint")).alias("_numbers"))
    known = contacts.groupBy(_mail("email").alias("_mail")).agg(F.min(_long("id")).alias("id"))
    used = known.select(F.col("_mail").alias("_to"), F.lit(True).alias("_used"))
    rows = changes.join(known, _mail("from") == F.col("_mail"), "left").join(told, "id", "left").join(used, _mail("to") == F.col("_to"), "left")
    matches = F.coalesce(F.array_contains("_numbers", F.col("customer_no").cast("long")), F.lit(False))
    free = F.coalesce(F.trim("to") != "", F.lit(False)) & F.col("_used").isNull()
    action = F.when(F.col("id").isNull() | ~matches, "nothing").when(free, "update").otherwise("tag")
    return rows.select(*(F.col(f"`{c}`") for c in changes.columns), "id", action.alias("action"))


def merge_contacts(known: DataFrame, new: DataFrame) -> DataFrame:
    """known contacts with new ones in their place."""
    return upsert(known, new, ["id"])
