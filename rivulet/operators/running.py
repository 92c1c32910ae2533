"""Running features per entity: counts and times by category, sums, and coding of repeats."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rivulet.contracts import ENTITY, TIME, need, window


def slug_of(name: str) -> str:
    """Lower case, each white space an underscore."""
    return re.sub(r"\s", "_", name.lower())


def categories(df: DataFrame, col: str, most: int = 1000) -> list[str]:
    """The distinct values of a small domain, in order; raises beyond most."""
    found = [r[0] for r in df.select(col).where(F.col(col).isNotNull()).distinct().orderBy(col).limit(most + 1).collect()]
    if len(found) > most:
        raise ValueError(f"{col} has more than {most} values; give them")
    return found


def category_features(df: DataFrame, col: str, values: Sequence[str], by: Sequence[str] = (ENTITY,), time: str = TIME, prefix: str = "") -> DataFrame:
    """Per value: {prefix}{slug}_count, _timestamp_min and _timestamp_max of the entity's rows up to the row's time; rows
    of one time share what they have come to. One window for all values."""
    need(df, [*by, time, col])
    w = Window.partitionBy(*by).orderBy(time).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    out: dict[str, Column] = {}
    for v in values:
        name = f"{prefix}{slug_of(v)}"
        at = F.when(F.col(col) == v, F.col(time))
        out |= {f"{name}_timestamp_min": F.min(at).over(w), f"{name}_timestamp_max": F.max(at).over(w), f"{name}_count": F.count(at).over(w)}
    return df.withColumns(out)


def previous_other(df: DataFrame, value: str, by: Sequence[str], out: str) -> DataFrame:
    """Adds out: the greatest value of the entity's rows that is less than the row's, e.g. the date before this one."""
    keys = ", ".join(f"`{b}`" for b in by)
    step = "INTERVAL 1 DAY" if dict(df.dtypes)[value] == "date" else "INTERVAL 0.000001 SECOND"
    return df.withColumn(out, F.expr(f"max(`{value}`) OVER (PARTITION BY {keys} ORDER BY `{value}` RANGE BETWEEN UNBOUNDED PRECEDING AND {step} PRECEDING)"))


def running_totals(df: DataFrame, by: Sequence[str], order: Sequence[str], amount: str, time: str, prefix: str) -> DataFrame:
    """{prefix}amt (running sum), _max (running maximum), _timestamp_min (first time), _timestamp_last (time before this one)."""
    w = window(by, order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    df = df.withColumns({f"{prefix}_amt": F.sum(amount).over(w), f"{prefix}_max": F.max(amount).over(w), f"{prefix}_timestamp_min": F.min(time).over(Window.partitionBy(*by))})
    return previous_other(df, time, by, f"{prefix}_timestamp_last")


def running_counts(df: DataFrame, by: Sequence[str], order: Sequence[str], col: str, values: Sequence[str], prefix: str, slugs: bool = True) -> DataFrame:
    """{prefix}_{slug}_count (or the value itself): rows of the value so far, in order."""
    w = window(by, order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumns({f"{prefix}_{slug_of(v) if slugs else v}_count": F.sum(F.when(F.col(col) == v, 1).otherwise(0)).over(w) for v in values})


def repeat_kind(df: DataFrame, by: Sequence[str], order: Sequence[str], time: str, again: str, out: str, days: float = 365, other: str | None = None) -> DataFrame:
    """Adds out: New for a group's first row, Upgrade if the row's `again` (a membership or campaign) has occurred in the
    group, or, where it is null and there is an `other` column, if that has, Renew if the row before is at most days older, else Reinstate."""
    w = window(by, order)
    seen = F.row_number().over(window([*by, again], order)) > 1
    if other is not None:
        seen = F.when(F.col(again).isNotNull(), seen).otherwise(F.row_number().over(window([*by, other], order)) > 1)
    gap = F.unix_micros(F.col(time).cast("timestamp")) - F.unix_micros(F.lag(time).over(w).cast("timestamp"))
    kind = F.when(F.row_number().over(w) == 1, "New").when(seen, "Upgrade").when(gap <= int(days * 86400 * 1_000_000), "Renew").otherwise("Reinstate")
    return df.withColumn(out, kind)
