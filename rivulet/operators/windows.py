"""Look-back window features of running quantities."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.contracts import ENTITY, TIME, need


def _quoted(names: Sequence[str]) -> str:
    return ", ".join(f"`{n}`" for n in names)


def lookback_values(df: DataFrame, cols: Sequence[str], days: float, by: Sequence[str], time: str, tie: Sequence[str], out: str) -> DataFrame:
    """Adds out: a struct of cols as of `days` before each row (the last row at or before then; null if none).

    A range frame over (by, time): several offsets share one shuffle and one sort, and no join is made."""
    fields = ", ".join([f"`{time}` AS _time", *(f"`{t}` AS _tie{i}" for i, t in enumerate(tie)), *(f"`{c}`" for c in cols)])
    span = f"INTERVAL {round(days * 86400)} SECOND"
    frame = f"OVER (PARTITION BY {_quoted(by)} ORDER BY `{time}` RANGE BETWEEN UNBOUNDED PRECEDING AND {span} PRECEDING)"
    return df.withColumn(out, F.expr(f"max(struct({fields})) {frame}"))


def window_features(
    df: DataFrame,
    cols: Sequence[str],
    windows: Sequence[float] = (1, 7, 30, 90, 365),
    by: Sequence[str] = (ENTITY,),
    time: str = TIME,
    tie: Sequence[str] = (),
    since: object = None,
    name: str = "{col}.-{days}",
) -> DataFrame:
    """df with, for each col and window, the change between that window's start and the next shorter window's start
    (for the shortest: the row itself), so the features don't overlap. Null where there is no row that early.

    windows are days, in any order; tie orders rows of one time, of which the last counts as the earlier state.
    Rows before since are history only."""
    need(df, [*cols, *by, time, *tie])
    order = sorted(set(windows))
    for i, d in enumerate(order):
        df = lookback_values(df, cols, d, by, time, tie, f"_w{i}")
    for c in cols:
        change = [F.col(f"`{c}`") - F.col(f"_w{i}.`{c}`") for i in range(len(order))]
        for i, d in enumerate(order):
            df = df.withColumn(name.format(col=c, days=f"{d:g}"), change[i] - change[i - 1] if i else change[i])
    df = df.drop(*(f"_w{i}" for i in range(len(order))))
    return df if since is None else df.where(F.col(time) >= F.lit(since).cast(df.schema[time].dataType))
