"""Customers that are the same person."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.functions.text import blank_to_null
from rivulet.operators.dedup import adjacent_pairs, drop_related, keep_delete

MATCH = ("email", "house_number", "road", "unit", "city", "state", "fname", "lname")
#: E-mail types kept by an assistant.
ASSISTANT = (6, 7)
#: What decides which of two is kept, in order, and how it is told.
CRITERIA = (
    ("in_household", "In household"),
    ("is_member", "Current membership"),
    ("last_login_dt", "Last login date"),
    ("last_activity_dt", "Last activity date"),
    ("last_update_dt", "Last update date"),
)


def load(customers: DataFrame, addresses: DataFrame, phones: DataFrame, emails: DataFrame) -> DataFrame:
    """Active individuals with names, times all past and present addresses, phones and e-mails of their household; an assistant's
    e-mails left out. Text lower case and trimmed, empty as null.

    addresses: group_customer_no and parsed columns; phones: group_customer_no, phone; emails: group_customer_no, address,
    eaddress_type. Rows of a household multiply; a household is small."""
    house = "group_customer_no"
    named = lambda c: F.col(c).isNotNull() & (F.col(c) != "")
    people = customers.where((F.col("cust_type_desc") == "Individual") & (F.col("inactive_desc") == "Active") & named("fname") & named("lname"))
    own = ~F.coalesce(F.col("eaddress_type").isin(*ASSISTANT), F.lit(False))
    places = addresses.where(F.col(house).isNotNull()).select(house, "house_number", "road", "unit", "city", "state").distinct()
    calls = phones.where(F.col("phone").isNotNull()).select(house, "phone").distinct()
    mails = emails.where(F.col("address").isNotNull() & own).select(house, F.col("address").alias("email")).distinct()
    df = people.select("fname", "lname", "customer_no", house)
    for more in (places, calls, mails):
        df = df.join(more, house, "left")
    return df.withColumns({f.name: blank_to_null(F.col(f.name)) for f in df.schema.fields if f.dataType.typeName() == "string"})


def facts(customers: DataFrame, memberships: DataFrame, logins: DataFrame) -> DataFrame:
    """Per customer the columns of CRITERIA. customers: customer_no, group_customer_no, inactive_desc, last_activity_dt,
    last_update_dt, of which the active count; in_household: the household has another number. is_member: a current
    membership whose level is known (the one of the greatest amount)."""
    member = memberships.where("cur_record_ind = 'Y'").groupBy("customer_no").agg(F.max_by("memb_level", F.struct("memb_amt", "memb_level")).alias("memb_level"))
    login = logins.where("inactive = 'N'").groupBy("customer_no").agg(F.max("last_login_dt").alias("last_login_dt"))
    base = customers.where("inactive_desc = 'Active'").select("customer_no", "last_activity_dt", "last_update_dt", (F.col("customer_no") != F.col("group_customer_no")).cast("int").alias("in_household"))
    df = member.join(login, "customer_no", "outer").join(base, "customer_no", "outer")
    return df.withColumn("is_member", F.col("memb_level").isNotNull().cast("int"))


def duplicates_stream(data: DataFrame, households: DataFrame, associations: DataFrame, known: DataFrame, match: tuple[str, ...] = MATCH) -> DataFrame:
    """Pairs that agree in match (no unit counts as an empty one) and aren't related, and which of them to keep."""
    if "unit" in data.columns:
        data = data.withColumn("unit", F.coalesce("unit", F.lit("")))
    pairs = drop_related(adjacent_pairs(data, "customer_no", list(match)), households, associations)
    # a customer of whom nothing is known is no member
    return keep_delete(pairs, known, [c for c in CRITERIA if c[0] in known.columns], unknown={"is_member": 0})
