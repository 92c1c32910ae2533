"""Payments with running features, and how each repeats the one before."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.operators.matching import greedy_match
from rivulet.operators.running import repeat_kind, running_counts, running_totals


def load(contributions: DataFrame, membership_links: DataFrame, creditees: DataFrame, memberships: DataFrame, campaigns: DataFrame, levels: DataFrame, customers: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(payments, memberships): a payment has its membership, and its creditee in place of its customer where the creditee has
    a household, which counts then;
    memberships that were cancelled or deactivated are left out, the others have their campaign and level."""
    c = contributions.join(membership_links.select("ref_no", "cust_memb_no"), "ref_no", "left")
    credit = creditees.select("ref_no", F.col("creditee_no").alias("_credit"))
    homes = customers.select(F.col("customer_no").alias("_credit"), F.col("group_customer_no").alias("_home"))
    c = c.join(credit.join(homes, "_credit", "left"), "ref_no", "left")
    c = c.withColumns({"group_customer_no": F.coalesce("_home", "group_customer_no"), "customer_no": F.when(F.col("_home").isNotNull(), F.col("_credit")).otherwise(F.col("customer_no"))}).drop("_credit", "_home")
    c = c.join(campaigns, "campaign_no", "left")
    gone = F.coalesce(F.col("current_status_desc").isin("Cancelled", "Deactivated"), F.lit(False))
    m = memberships.where(~gone).join(campaigns, "campaign_no", "left").join(levels, "memb_level", "left")
    return c, m


def features(rows: DataFrame, subtypes: Sequence[tuple[str, Column]], by: str = "group_customer_no", time: str = "cont_dt", amount: str = "cont_amt", number: str = "ref_no", again: str = "cust_memb_no", campaign: str = "campaign_no") -> DataFrame:
    """Payments above 0 with event_subtype (the name of the first condition that holds), running sums, maxima, first, own and
    previous times, contribution_{subtype}_count (the name as it is), and event_subtype2 (New, Upgrade, Renew,
    Reinstate) within the subtype: Upgrade if the membership occurred before there, or, of a payment without one,
    if the campaign did, with or without a membership."""
    kind = None
    for name, condition in subtypes:
        kind = F.when(condition, name) if kind is None else kind.when(condition, name)
    rows = rows.where(F.col(amount) > 0).withColumn("event_subtype", kind)
    rows = running_totals(rows, [by], [time, number], amount, time, "contribution").withColumn("contribution_timestamp_max", F.col(time))
    rows = running_counts(rows, [by], [time, number], "event_subtype", [n for n, _ in subtypes], "contribution", slugs=False)
    rows = repeat_kind(rows, [by, "event_subtype"], [time, number], time, again, "event_subtype2", other=campaign)
    return rows.withColumns({"timestamp": F.col(time), "event_type": F.lit("Contribution")})


def contribution_stream(contributions: DataFrame, memberships: DataFrame, subtypes: Sequence[tuple[str, Column]]) -> DataFrame:
    """Payments matched to memberships, then their features."""
    return features(greedy_match(contributions, memberships), subtypes)
