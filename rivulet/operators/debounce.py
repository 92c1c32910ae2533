"""One row per key: the last, or the last before a time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.contracts import TIME, as_columns, matching, need, window


def debounce(df: DataFrame, by: Sequence[str], order_by: Sequence[str | Column], keep: str = "last") -> DataFrame:
    """The last (or first) row of each group by, in order_by; add a unique column to order_by to settle ties."""
    need(df, by)
    order = [c.desc_nulls_last() if keep == "last" else c.asc_nulls_first() for c in as_columns(order_by)]
    return df.withColumn("_place", F.row_number().over(window(by, order))).where("_place = 1").drop("_place")


def last_state(df: DataFrame, by: Sequence[str], before: object = "2100-01-01", time: str = TIME, tie: Sequence[str] = (), patterns: Sequence[str] = (".",)) -> DataFrame:
    """by, time and the columns that match any pattern, of each group's last row with time < before; one row a group."""
    need(df, [*by, time])
    keep = list(dict.fromkeys([*by, time, *matching(df, *patterns)]))
    limit = F.lit(before).cast(df.schema[time].dataType)
    return debounce(df.where(F.col(time) < limit), by, [time, *tie]).select(*as_columns(keep))
