"""Merging rows into a table by key."""

from __future__ import annotations

import warnings
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.contracts import as_columns, need
from rivulet.operators.debounce import debounce


def upsert(table: DataFrame, rows: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column] | None = None) -> DataFrame:
    """table with rows put in place of those of equal keys, or added. Columns that table lacks are dropped with a warning;
    those that rows lacks are null in what is added and keep their value in what is replaced.

    Several rows of a key: the last in order_by counts (by all columns, if None). Raises without keys."""
    if not keys:
        raise ValueError("a table without a key can't be merged into")
    need(table, keys)
    need(rows, keys)
    extra = [c for c in rows.columns if c not in table.columns]
    if extra:
        warnings.warn(f"not in the table, dropped: {', '.join(extra)}", stacklevel=2)
    given = [c for c in rows.columns if c in table.columns]
    rows = debounce(rows.select(*as_columns(given)), keys, order_by or given)
    new = rows.select(*(F.col(f"`{c}`").cast(table.schema[c].dataType).alias(c) for c in given))
    kept = [c for c in table.columns if c not in given]
    if kept:
        new = new.join(table.select(*as_columns([*keys, *kept])), list(keys), "left")
    return table.join(new.select(*keys), list(keys), "left_anti").unionByName(new.select(*as_columns(table.columns)))
