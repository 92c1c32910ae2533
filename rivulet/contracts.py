"""What a stream is, and the checks that operators make of their input."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

#: A stream has at least an entity and a time.
ENTITY, TIME = "group_customer_no", "timestamp"


def need(df: DataFrame, columns: Iterable[str]) -> None:
    """Raises unless df has the columns."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"no such columns: {', '.join(missing)}")


def check_stream(df: DataFrame, entity: str = ENTITY, time: str = TIME) -> DataFrame:
    """df, if it is a stream."""
    need(df, [entity, time])
    if dict(df.dtypes)[time] not in ("timestamp", "timestamp_ntz", "date"):
        raise TypeError(f"{time} is a {dict(df.dtypes)[time]}, not a time")
    return df


def matching(df: DataFrame, *patterns: str) -> list[str]:
    """Columns whose name any of the patterns is found in, letters of either case."""
    return [c for c in df.columns if any(re.search(p, c, re.IGNORECASE) for p in patterns)]


def as_columns(names: str | Column | Sequence[str | Column]) -> list[Column]:
    """One or more names or columns as columns."""
    if isinstance(names, (str, Column)):
        names = [names]
    return [F.col(f"`{c}`") if isinstance(c, str) else c for c in names]


def window(by: Sequence[str], order: Sequence[str | Column]) -> WindowSpec:
    """Partitions by the columns, in the order; nulls first, as in the order of a sorted table."""
    return Window.partitionBy(*as_columns(by)).orderBy(*as_columns(order))


def from_end(by: Sequence[str], order: Sequence[str]) -> WindowSpec:
    """The rows from the one at hand to the last in the order of these columns, gone through from the end: a frame that begins at
    the row would be gone through anew for each, which takes the square of a partition's rows. The last value in it is the first in the order."""
    return window(by, [c.desc() for c in as_columns(order)]).rowsBetween(Window.unboundedPreceding, 0)
