"""Many streams as one: united, filled, windowed, written by increments."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.catalog import Catalog
from rivulet.contracts import ENTITY, TIME, check_stream, matching
from rivulet.operators.debounce import debounce
from rivulet.operators.fill import fill_nulls
from rivulet.operators.ordered import chunk_bounds, numbered, with_chunk
from rivulet.operators.windows import window_features

WINDOWS = (1, 7, 30, 90, 365)
#: Streams that are united by default, columns that are filled, and those of them that get look-back features.
STREAMS = ("email_stream", "ticket_stream", "contribution_stream", "membership_stream", "ticket_future_stream", "address_stream")
FILL_MATCH = ("^(email|ticket|contribution|membership|ticket|address).+(amt|level|count|max|min|last)",)
WINDOW_MATCH = ("^(email|ticket|contribution|membership|ticket|address).+(count|amt)$",)


def united(streams: Mapping[str, DataFrame], after: object = None) -> DataFrame:
    """Rows of all streams, missing columns null, with stream (the name), timestamp_id (microseconds) and times as
    timestamps, dates too. Rows without a time, and those not later than after, are left out."""
    parts = []
    for name, df in streams.items():
        check_stream(df)
        df = df.withColumn(TIME, F.col(TIME).cast("timestamp_ntz")).where(F.col(TIME).isNotNull())
        if after is not None:
            df = df.where(F.col(TIME) > F.lit(after).cast("timestamp_ntz"))
        parts.append(df.withColumn("stream", F.lit(name)))
    out = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return out.withColumn("timestamp_id", F.unix_micros(F.col(TIME).cast("timestamp")))


def enriched(rows: DataFrame, fill_match: Sequence[str] = (), window_match: Sequence[str] = (), windows: Sequence[float] = WINDOWS, by: str = ENTITY, tie: Sequence[str] = ("stream",), since: object = None) -> DataFrame:
    """rows with the columns that match filled forward within the entity, and look-back features of those that match
    window_match as well. Fill and windows share one shuffle."""
    fill = [c for c in matching(rows, *fill_match) if c not in (by, TIME)] if fill_match else []
    wide = [c for c in fill if c in matching(rows, *window_match)] if window_match else []
    if fill:
        rows = fill_nulls(rows, "locf", fill, [by], [TIME, *tie])
    if wide:
        rows = window_features(rows, wide, windows, [by], TIME, tie, since)
    elif since is not None:
        rows = rows.where(F.col(TIME) >= F.lit(since).cast("timestamp_ntz"))
    return rows


def seeds(history: DataFrame, before: object, days: float, by: str = ENTITY, tie: Sequence[str] = ("stream",)) -> DataFrame:
    """What an increment from `before` on needs of the rows before: those of the last days and each entity's last row
    earlier than these."""
    old = history.where(F.col(TIME) < F.lit(before).cast("timestamp_ntz"))
    edge = F.lit(before).cast("timestamp_ntz") - F.expr(f"INTERVAL {round(days * 86400)} SECOND")
    recent = old.where(F.col(TIME) >= edge)
    last = debounce(old.where(F.col(TIME) < edge), [by], [TIME, *tie])
    return recent.unionByName(last)


def stream(
    catalog: Catalog,
    names: Sequence[str] = STREAMS,
    out: str = "stream",
    fill_match: Sequence[str] = FILL_MATCH,
    window_match: Sequence[str] = WINDOW_MATCH,
    windows: Sequence[float] = WINDOWS,
    rebuild: bool = False,
    by: str = ENTITY,
    tie: Sequence[str] = ("stream",),
    chunk_size: int = 10_000_000,
) -> DataFrame:
    """Builds or extends the dataset `out` from the catalog's streams.

    Rows have a partition, by which they are stored: the number of their chunk of chunk_size rows in the order of time of all
    streams' rows (rows of one time stay together), and a rowid, which runs over all increments in the order of time and tie.

    Increments take rows later than the dataset's last time; late rows wait for a rebuild. An increment sees the look-back
    span and the last state before it, so it gives what a full build gives."""
    mark = None if rebuild else catalog.high_water(out, TIME)
    inputs_of = {n: catalog.read(n) for n in names}
    bounds = chunk_bounds(united({n: df.select(ENTITY, TIME) for n, df in inputs_of.items()}), TIME, chunk_size)
    rows = united(inputs_of, mark)
    since, first_id = None, 0
    if mark is not None:
        if rows.isEmpty():
            return catalog.read(out)
        since = rows.agg(F.min(TIME)).first()[0]
        first_id = catalog.high_water(out, "rowid") or 0
        inputs = list(dict.fromkeys(c for df in inputs_of.values() for c in df.columns))
        old = catalog.read(out)
        keep = [c for c in old.columns if c in inputs or c in ("stream", "timestamp_id")]
        rows = seeds(old.select(*keep), since, max(windows), by, tie).unionByName(rows, allowMissingColumns=True)
    done = enriched(rows, fill_match, window_match, windows, by, tie, since)
    done = with_chunk(numbered(done, [TIME, *tie], "rowid", first_id), TIME, bounds, "partition")
    return catalog.overwrite(out, done, ["partition"]) if mark is None else catalog.replace_range(out, done, TIME, ["partition"])
