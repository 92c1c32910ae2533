"""Increments by Structured Streaming: new files of a stream go through the same merge as a batch."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from rivulet.catalog import Catalog
from rivulet.contracts import TIME
from rivulet.durable import discard, shared_dir, stored
from rivulet.sources.rest import PagedSource


def follow(spark: SparkSession, path: str, schema: StructType, catalog: Catalog, out: str, build: Callable[[DataFrame], DataFrame] = lambda df: df, date_column: str = TIME, query: str | None = None) -> StreamingQuery:
    """Starts a query that, whenever files have come to path, builds their rows and adds them to the dataset out, late ones too.

    One micro-batch at a time; its progress is kept in the shared folder, so a restart goes on where it stopped. A
    batch's write is named by the query and the batch, so one that ran twice is there once. Rows without a date in
    date_column are left out."""
    name = query or out

    def write(batch: DataFrame, number: int) -> None:
        if not batch.isEmpty():
            catalog.append(out, build(batch).where(F.col(date_column).isNotNull()), tag=f"{name}-{number}")

    source = spark.readStream.schema(schema).parquet(path)
    return source.writeStream.foreachBatch(write).option("checkpointLocation", f"{shared_dir(spark)}/streams/{name}").trigger(availableNow=True).start()


def follow_service(spark: SparkSession, options: dict[str, str], schema: str, catalog: Catalog, out: str, keys: Sequence[str] = (), build: Callable[[DataFrame], DataFrame] = lambda df: df, query: str | None = None) -> StreamingQuery:
    """Starts a query that brings the dataset out up to a paged service (options of `PagedSource`): what is new is added, each row
    once, or merged by keys where rows change. How far it is stays in the shared folder, by the query's name."""
    name = query or out
    spark.dataSource.register(PagedSource)

    def write(batch: DataFrame, number: int) -> None:
        if not batch.isEmpty():
            if keys:  # a merge reads its rows several times, the service is asked once
                rows = stored(build(batch), "service-batch")
                catalog.merge(out, rows, keys)
                discard(rows)
            else:
                catalog.append(out, build(batch), tag=f"{name}-{number}")

    source = spark.readStream.format("paged_rest").options(**options).schema(schema).load()
    return source.writeStream.foreachBatch(write).option("checkpointLocation", f"{shared_dir(spark)}/streams/{name}").trigger(availableNow=True).start()


def late_counts(rows: DataFrame, by: str, time: str = TIME, lateness: str = "1 day", span: str = "1 day") -> DataFrame:
    """Rows per key and span of a streaming frame; a span is final once the watermark has passed it."""
    stamped = rows.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, lateness)
    return stamped.groupBy(F.window(time, span).alias("span"), by).agg(F.count("*").alias("n"))
