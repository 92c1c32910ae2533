"""Work along one order of all rows, or of a group too large for a task.

Rows are dealt to ranges of the order, so that a range holds its share of them, whatever their keys; what a range needs of those
before it is a row or a number per range, which is small. Ties are split too: after the columns of the order come a digest
of the row and a number that each row is given when it is first stored, so ranges differ in size by sampling alone.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from rivulet.contracts import as_columns, need
from rivulet.durable import discard, reading, stored

#: Bits of the row's number within its range; monotonically_increasing_id() has the range above them.
_WITHIN = 33


def _digest(df: DataFrame) -> Column:
    """A digest of the columns that have one (maps don't)."""
    some = [F.col(f"`{f.name}`") for f in df.schema.fields if "map<" not in f.dataType.simpleString() and "variant" not in f.dataType.simpleString()]
    return F.xxhash64(*some) if some else F.lit(0).cast("long")


def ranged(df: DataFrame, order_by: Sequence[str | Column], ranges: int | None = None) -> DataFrame:
    """df, stored in order, with `_at`: range << 33 | place in the range. Ranges follow the order, and so do places.

    ranges: how many; as many as the session has shuffle partitions by default."""
    n = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    held = stored(df.withColumns({"_digest": _digest(df), "_copy": F.monotonically_increasing_id()}), "ordered-rows")
    order = [*as_columns(order_by), F.col("_digest"), F.col("_copy")]
    dealt = held.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    out = stored(dealt.drop("_digest", "_copy"), "ordered-ranges")
    discard(held)
    return out


def _range() -> Column:
    return F.shiftright("_at", _WITHIN)


def numbered(df: DataFrame, order_by: Sequence[str | Column], name: str = "rowid", start: int = 0, ranges: int | None = None) -> DataFrame:
    """df with name: start + 1, start + 2, ... in the order, over all rows; rows that tie are numbered by a digest.

    Each range is counted, and a row's number is its place in its range after all rows of ranges before: no task sees
    more than a range. An empty table stays empty; nulls come first. `discard` deletes what the result is read from."""
    rows = ranged(df, order_by, ranges)
    sizes = sorted(rows.groupBy(_range().alias("r")).count().collect())  # a row per range
    before, offsets = start, []
    for r, n in sizes:
        offsets.append((r, before + 1))
        before += n
    schema = StructType([StructField("_r", LongType()), StructField("_first", LongType())])
    first = F.broadcast(rows.sparkSession.createDataFrame(offsets, schema))
    within = F.col("_at").bitwiseAND((1 << _WITHIN) - 1)
    out = rows.join(first, _range() == F.col("_r"), "left").withColumn(name, F.col("_first") + within).drop("_at", "_r", "_first")
    return reading(out, rows)


def fill_spread(df: DataFrame, kind: str, cols: Sequence[str], by: Sequence[str], order_by: Sequence[str | Column], ranges: int | None = None) -> DataFrame:
    """df with nulls of cols filled within by from the last value before (locf) or the next after (nocb) in the order, for
    groups of any size, and for one group of all rows (no by).

    Two passes: rows are dealt to ranges of (by, order); each range is filled alone, and what its first group (for nocb:
    its last) misses is the value that the nearest range with one has at its end. Only the groups at the edges of ranges are
    looked at for that, two a range. Rows that tie on the order and differ are ordered by a digest."""
    need(df, [*cols, *by])
    if kind not in ("locf", "nocb"):
        raise ValueError(f"no such kind of fill: {kind}")
    forward = kind == "locf"
    keys, values = as_columns(by), as_columns(cols)
    rows = ranged(df, [*keys, *as_columns(order_by)], ranges).withColumn("_r", _range())
    pick = F.max_by if forward else F.min_by
    ends = [pick(v, F.when(v.isNotNull(), F.col("_at"))).alias(f"v{i}") for i, v in enumerate(values)]
    key = F.struct(F.lit(0).alias("_"), *(k.alias(f"k{i}") for i, k in enumerate(keys)))
    groups = rows.groupBy("_r", key.alias("key")).agg(F.max("_at").alias("_top"), *ends)
    whole = F.struct("key", *(f"v{i}" for i in range(len(cols))))
    edges = groups.groupBy("_r").agg(F.min_by(whole, "_top").alias("first"), F.max_by(whole, "_top").alias("last")).orderBy("_r").collect()  # a row per range
    carried, key_now, now = [], None, [None] * len(cols)
    for e in edges if forward else reversed(edges):
        near, far = (e["first"], e["last"]) if forward else (e["last"], e["first"])
        if near["key"] == key_now:
            carried.append((e["_r"], near["key"], *now))
        else:
            key_now, now = near["key"], [None] * len(cols)
        if far["key"] != key_now:
            key_now, now = far["key"], [None] * len(cols)
        now = [old if far[f"v{i}"] is None else far[f"v{i}"] for i, old in enumerate(now)]
    schema = StructType([StructField("_cr", LongType()), StructField("_ckey", groups.schema["key"].dataType), *(StructField(f"_c{i}", df.schema[c].dataType) for i, c in enumerate(cols))])
    extra = F.broadcast(rows.sparkSession.createDataFrame(carried, schema))
    # a frame that ends at the row grows by one; one that begins there would be gone through anew for each row
    w = Window.partitionBy("_r", *keys).orderBy(F.col("_at") if forward else F.col("_at").desc()).rowsBetween(Window.unboundedPreceding, 0)
    filled = rows.withColumns({f"_f{i}": F.last(v, ignorenulls=True).over(w) for i, v in enumerate(values)})
    out = filled.join(extra, (F.col("_r") == F.col("_cr")) & key.eqNullSafe(F.col("_ckey")), "left")
    at = {c: i for i, c in enumerate(cols)}
    return out.select(*(F.coalesce(f"_f{at[c]}", f"_c{at[c]}").alias(c) if c in at else F.col(f"`{c}`") for c in df.columns))


#: Cells of a histogram, in bits.
_CELLS = 14


def order_statistics(df: DataFrame, column: str, places: Sequence[int]) -> list[int | None]:
    """The values of a column of longs at places (from 1) of its ascending order, nulls left out; None beyond the end.

    Exact, without a sort: a histogram over the column's whole span tells in which cells the places lie, further ones over these cells
    alone narrow them down, until a cell is one value. A pass is an aggregation of at most 2^14 cells, or two for each place."""
    v = F.col(f"`{column}`").cast("long")
    low, high, n = df.agg(F.min(v), F.max(v), F.count(v)).first()
    wanted = sorted({p for p in places if 1 <= p <= (n or 0)})
    found: dict[int, int] = {}
    if wanted:
        rows = df.where(v.isNotNull()).select((v - F.lit(low)).alias("_v"))
        shift = max(0, (high - low).bit_length() - _CELLS)
        # cell: how many rows lie in cells before it
        cells, inside = None, {0: wanted}
        base = {0: 0}
        last_shift = 64
        while True:
            part = rows
            if cells is not None:
                known = F.broadcast(rows.sparkSession.createDataFrame([(c,) for c in cells], "_cell long"))
                part = rows.join(known, F.shiftright("_v", last_shift) == F.col("_cell"), "left_semi")
            counts = {r["c"]: r["count"] for r in part.groupBy(F.shiftright("_v", shift).alias("c")).count().collect()}
            narrowed: dict[int, list[int]] = {}
            new_base: dict[int, int] = {}
            by_parent: dict[int, list[int]] = {}
            for c in sorted(counts):
                by_parent.setdefault(c >> (last_shift - shift) if cells is not None else 0, []).append(c)
            for parent, some in inside.items():
                before, todo = base[parent], iter(some)
                p = next(todo, None)
                for c in by_parent[parent]:
                    while p is not None and p <= before + counts[c]:
                        narrowed.setdefault(c, []).append(p)
                        new_base[c] = before
                        p = next(todo, None)
                    before += counts[c]
            inside, base, cells, last_shift = narrowed, new_base, list(narrowed), shift
            if shift == 0:
                break
            shift = max(0, shift - max(1, _CELLS - len(cells).bit_length()))
        found = {p: low + c for c, some in inside.items() for p in some}
    return [found.get(p) for p in places]


def chunk_bounds(df: DataFrame, time: str, size: int) -> list[int]:
    """The last time, in microseconds, of every chunk of so many rows in the order of time; the last chunk ends at the greatest.

    Rows of one time stay together, in the first chunk that ends with that time: chunks differ from size by ties alone.
    Null times are in no chunk."""
    if size < 1:
        raise ValueError("a chunk has at least one row")
    micros = df.select(F.unix_micros(F.col(f"`{time}`").cast("timestamp")).alias("t"))
    n = micros.agg(F.count("t")).first()[0]
    return order_statistics(micros, "t", [*range(size, n, size), n] if n else [])  # type: ignore[return-value]


def with_chunk(df: DataFrame, time: str, bounds: Sequence[int], name: str = "partition") -> DataFrame:
    """df with the number (from 1) of the first chunk that doesn't end before the row's time; times after all bounds have the
    number after the last, null times none.

    Bounds are searched by halves, so a row's time grows with the logarithm of their number."""
    ends = np.asarray(bounds, dtype="int64")

    @F.pandas_udf("long")
    def number(t: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(ends, t.to_numpy()) + 1)

    t = F.unix_micros(F.col(f"`{time}`").cast("timestamp"))
    return df.withColumn(name, F.when(t.isNotNull(), number(F.coalesce(t, F.lit(0)))))
