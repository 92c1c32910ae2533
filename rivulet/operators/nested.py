"""Nested service answers as flat tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType

from rivulet.operators.running import categories


def widen(df: DataFrame, col: str, keys: Sequence[str] | None = None, size: int | None = None) -> DataFrame:
    """df with a nested column spread: a struct to col.field, a map to col.key, an array to col.1 ... col.n, padded with
    null; an array of at most one element to col itself, and null where it is empty. Other columns stay.

    keys and size fix a map's keys and an array's length; where they are None one small aggregate finds them, and
    raises beyond 1000 keys."""
    kind = df.schema[col].dataType
    rest = [F.col(f"`{c}`") for c in df.columns if c != col]
    c = F.col(f"`{col}`")
    if isinstance(kind, StructType):
        return df.select(*rest, *(c.getField(f).alias(f"{col}.{f}") for f in kind.names))
    if isinstance(kind, MapType):
        if keys is None:
            keys = categories(df.select(F.explode(F.map_keys(c)).alias(col)), f"`{col}`")
        return df.select(*rest, *(F.try_element_at(c, F.lit(k)).alias(f"{col}.{k}") for k in keys))
    if isinstance(kind, ArrayType):
        if size is None:
            size = df.agg(F.max(F.size(c))).first()[0] or 0
        if size <= 1:
            return df.select(*rest, F.get(c, F.lit(0)).alias(col))
        return df.select(*rest, *(F.get(c, F.lit(i)).alias(f"{col}.{i + 1}") for i in range(size)))
    return df


def widen_all(df: DataFrame) -> DataFrame:
    """All nested columns spread, one level."""
    return reduce(widen, [f.name for f in df.schema.fields if isinstance(f.dataType, (StructType, MapType, ArrayType))], df)


def combine_pages(pages: Sequence[Mapping[str, DataFrame]]) -> dict[str, DataFrame] | None:
    """Per name the pages' tables one under the other, missing columns null; None if nothing has a name."""
    names = dict.fromkeys(n for p in pages for n in p if n)
    if not names:
        return None
    return {n: reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [p[n].select("*") for p in pages if n in p]) for n in names}


def from_json_text(spark: SparkSession, texts: DataFrame, col: str, schema: str | None = None) -> DataFrame | None:
    """A table of JSON objects or arrays of objects held as text; None if there are none. Give the schema where it is known."""
    text = texts.select(F.col(col).alias("value")).where(F.trim("value").rlike(r"^[\[{]"))
    if schema is not None:
        return text.select(F.from_json("value", schema).alias("x")).select("x.*")
    if text.isEmpty():
        return None
    # the reader's own inference over a column of text, within the JVM
    strings = getattr(text._jdf, "as")(spark._jvm.org.apache.spark.sql.Encoders.STRING())
    found = DataFrame(spark._jsparkSession.read().json(strings), spark)
    return found if found.columns else None
