"""Running an expensive function for unseen keys only."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rivulet.catalog import VERSIONS, Catalog
from rivulet.contracts import as_columns, need


def _same(left: Sequence[str], right: Sequence[str]):
    return reduce(lambda a, b: a & b, (F.col(x).eqNullSafe(F.col(y)) for x, y in zip(left, right)))


def memoised(
    df: DataFrame,
    keys: Sequence[str],
    function: Callable[[pd.DataFrame], pd.DataFrame],
    schema: str | StructType,
    catalog: Catalog,
    name: str,
    chunk: int = 1000,
    parallel: int | None = None,
) -> DataFrame:
    """Every row of df with function's columns (schema) for its keys.

    Distinct keys that the cache lacks (null equals null) go to function in chunks, on `parallel` tasks (few, for
    services that limit rates); what it gives is added to the cache, whose schema may grow by columns. function gets
    a frame of keys and gives a frame of as many rows, in order. Only misses are computed; without rows nothing is."""
    out = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    full = StructType([*(df.schema[k] for k in keys), *out.fields])
    names = full.names

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), chunk):
                part = batch.iloc[at : at + chunk].reset_index(drop=True)
                yield pd.concat([part, function(part.copy()).reset_index(drop=True)], axis=1)[names]

    def computed(missing: DataFrame) -> DataFrame:
        return (missing.repartition(parallel) if parallel else missing).mapInPandas(run, full)

    return memoised_frame(df, keys, computed, out, catalog, name)


def memoised_frame(df: DataFrame, keys: Sequence[str], function: Callable[[DataFrame], DataFrame], out: StructType, catalog: Catalog, name: str, along: Sequence[str] = ()) -> DataFrame:
    """As `memoised`, with a function of a frame: it gets a row for each missing key, with the columns along (one row's, where a
    key has several), and gives keys and the columns of out, a row for each key."""
    need(df, [*keys, *along])
    wanted = df.select(*keys, *as_columns(along))
    if along:
        low = F.min(F.struct(*as_columns(along))).alias("_along")
        wanted = wanted.groupBy(*keys).agg(low).select(*keys, "_along.*")
    else:
        wanted = wanted.distinct()
    names = [*keys, *out.names]
    renamed = {k: f"_k{i}" for i, k in enumerate(keys)}
    if catalog.exists(name):
        have = catalog.read(name)
        if all(k in have.columns for k in keys):
            seen = have.select(*keys).withColumnsRenamed(renamed)
            wanted = wanted.join(seen, _same(keys, list(renamed.values())), "left_anti")
    if not catalog.exists(name) or not wanted.isEmpty():
        catalog.append(name, function(wanted).select(*names))
        if catalog.versions(name) > VERSIONS:
            catalog.compact(name)
    cache = catalog.read(name).select(*names).dropDuplicates(list(keys)).withColumnsRenamed(renamed)
    return df.join(cache, _same(keys, list(renamed.values())), "left").drop(*renamed.values())
