"""As-of joins: the last row at or before, the first at or after, or the nearest.

Both sides go into one window per key, tagged by side, so a join is one shuffle and one sort, whatever the number of
matches; no inequality join, no cross product.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rivulet.contracts import as_columns, need
from rivulet.operators.ordered import fill_spread


def asof_join(
    left: DataFrame,
    right: DataFrame,
    by: Sequence[str],
    left_time: str,
    right_time: str,
    take: Sequence[str],
    direction: str = "backward",
    tie: Sequence[str] = (),
    suffix: str = "",
    spread: bool = False,
) -> DataFrame:
    """left with the columns take of the row of right with equal by (null equals null) whose right_time is the last <=
    (backward), the first >= (forward) or the nearest to left_time; null if there is none.

    Among right's rows of one time the largest tie wins backward, the smallest forward. At equal distances the
    earlier row is nearest. Rows of right without a time match nothing, nor do rows of left.

    spread: a key may have more rows than a task holds (half of all, say, or those without a key): rows are dealt to ranges of
    key and time, and each range gets the row of right that the one before carries. That stores the rows on the way.
    """
    if direction not in ("backward", "forward", "nearest"):
        raise ValueError(f"no such direction: {direction}")
    need(left, [*by, left_time])
    need(right, [*by, right_time, *take, *tie])
    key = F.struct(*(F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(by)))
    payload = F.struct(F.col(f"`{right_time}`").alias("_at"), *(F.col(f"`{c}`").alias(f"v{i}") for i, c in enumerate(take)))
    ties = F.struct(F.lit(0).alias("_"), *(F.col(f"`{c}`").alias(f"t{i}") for i, c in enumerate(tie)))
    at_type = left.schema[left_time].dataType
    whole = F.struct(*as_columns(left.columns))
    rows = left.select(key.alias("_key"), F.col(f"`{left_time}`").alias("_time"), whole.alias("_left"))
    facts = right.where(F.col(f"`{right_time}`").isNotNull()).select(key.alias("_key"), F.col(f"`{right_time}`").cast(at_type).alias("_time"), ties.alias("_tie"), payload.alias("_right"))
    both = rows.unionByName(facts, allowMissingColumns=True)
    is_left = F.col("_left").isNotNull().cast("int")
    parts = Window.partitionBy("_key")
    picked: dict[str, Column] = {}
    if spread:
        both = both.withColumn("_side", is_left)
        if direction != "forward":
            both = fill_spread(both.withColumn("_b", F.col("_right")), "locf", ["_b"], ["_key"], ["_time", "_side", "_tie"])
        if direction != "backward":
            both = fill_spread(both.withColumn("_f", F.col("_right")), "nocb", ["_f"], ["_key"], ["_time", F.col("_side").desc(), "_tie"])
    elif direction != "forward":
        picked["_b"] = F.last("_right", ignorenulls=True).over(parts.orderBy("_time", is_left, "_tie").rowsBetween(Window.unboundedPreceding, 0))
    if not spread and direction != "backward":
        picked["_f"] = F.last("_right", ignorenulls=True).over(parts.orderBy(F.desc("_time"), is_left, F.desc("_tie")).rowsBetween(Window.unboundedPreceding, 0))
    out = both.withColumns(picked).where("_left is not null")
    if direction == "nearest":
        back, ahead = (F.unix_micros(F.col("_time").cast("timestamp")) - F.unix_micros(F.col("_b._at").cast("timestamp")), F.unix_micros(F.col("_f._at").cast("timestamp")) - F.unix_micros(F.col("_time").cast("timestamp")))
        found = F.when(F.col("_f").isNull() | (back <= ahead), F.col("_b")).otherwise(F.col("_f"))
    else:
        found = F.col("_b" if direction == "backward" else "_f")
    out = out.withColumn("_found", F.when(F.col("_time").isNotNull(), found))
    return out.select("_left.*", *(F.col(f"_found.v{i}").alias(c + suffix) for i, c in enumerate(take)))


def nearest_number(left: DataFrame, right: DataFrame, by: Sequence[str], left_at: str, right_at: str, take: Sequence[str]) -> DataFrame:
    """left with the columns take of right's row of equal by whose number is nearest; the smaller number at equal distances.

    For sides with few numbers a key, such as years: right becomes one row a key, which holds an array of its numbers; a row
    of left picks from that, so only right is grouped. Of right's rows with the same number the least by take counts."""
    need(left, [*by, left_at])
    need(right, [*by, right_at, *take])
    one = F.struct(F.col(f"`{right_at}`").alias("at"), F.struct(*(F.col(f"`{c}`").alias(f"v{i}") for i, c in enumerate(take))).alias("take"))
    facts = right.where(F.col(f"`{right_at}`").isNotNull()).groupBy(*(F.col(f"`{c}`").alias(f"_k{i}") for i, c in enumerate(by))).agg(F.collect_set(one).alias("_all"))
    on = reduce(lambda a, b: a & b, (F.col(f"`{c}`").eqNullSafe(F.col(f"_k{i}")) for i, c in enumerate(by)))
    at = F.col(f"`{left_at}`")
    best = F.array_min(F.transform("_all", lambda x: F.struct(F.abs(at - x["at"]).alias("gap"), x["at"].alias("at"), x["take"].alias("take"))))
    out = left.join(facts, on, "left").withColumn("_best", F.when(at.isNotNull(), best))
    return out.select(*as_columns(left.columns), *(F.col(f"_best.take.v{i}").alias(c) for i, c in enumerate(take)))
