"""Filling nulls: by a constant, by the last value before, by the next value after."""

from __future__ import annotations

import warnings
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from rivulet.contracts import as_columns, from_end, need, window
from rivulet.operators.ordered import fill_spread


def fill_nulls(
    df: DataFrame,
    kind: str,
    cols: Sequence[str | int] | None = None,
    by: Sequence[str] = (),
    order_by: Sequence[str | Column] = (),
    value: object = None,
    spread: bool = False,
) -> DataFrame:
    """df with nulls of cols (names or positions; all but by if None) filled.

    kind: const (by value; by is ignored, with a warning), locf (last before, in order_by, within by) or nocb (next
    after); for these value is ignored, with a warning. All columns share one window, so one shuffle.
    spread: groups may be larger than a task; a fill without by always is spread. That stores the rows twice on the way.
    """
    if not isinstance(df, DataFrame):
        raise TypeError("a DataFrame is needed")
    if kind not in ("const", "locf", "nocb"):
        raise ValueError(f"no such kind of fill: {kind}")
    names = [df.columns[c] if isinstance(c, int) else c for c in cols] if cols is not None else [c for c in df.columns if c not in by]
    need(df, [*names, *by])
    if kind == "const":
        if by:
            warnings.warn("a constant fill has no groups; by is ignored", stacklevel=2)
        return df.withColumns({c: F.coalesce(F.col(f"`{c}`"), F.lit(value).cast(df.schema[c].dataType)) for c in names})
    if value is not None:
        warnings.warn("only a constant fill has a value; it is ignored", stacklevel=2)
    if not order_by:
        raise ValueError("rows have no order of their own: order_by is needed")
    if spread or not by:
        return fill_spread(df, kind, names, by, order_by)
    w = window(by, order_by)
    if kind == "locf":
        w = w.rowsBetween(Window.unboundedPreceding, 0)
    elif all(isinstance(c, str) for c in order_by):
        w = from_end(by, order_by)
    else:  # an order of columns can't be turned round, places in it can
        columns, df, w = df.columns, df.withColumn("_at", F.row_number().over(w)), from_end(by, ["_at"])
        return df.withColumns(_last(names, w)).select(*as_columns(columns))
    return df.withColumns(_last(names, w))


def _last(names: Sequence[str], w: WindowSpec) -> dict[str, Column]:
    return {c: F.last(col, ignorenulls=True).over(w) for c, col in zip(names, as_columns(names))}
