"""Named tables behind one function: Parquet directories, or a database by JDBC."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


class Tables:
    """Tables of a customer database by name; a query where the name is one."""

    def __init__(self, spark: SparkSession, root: str | None = None, jdbc: Mapping[str, str] | None = None) -> None:
        self.spark, self.root, self.jdbc = spark, root, dict(jdbc or {})

    def table(self, name: str, select: list[str] | None = None) -> DataFrame:
        if self.jdbc:
            df = self.spark.read.format("jdbc").options(**self.jdbc).option("dbtable", name).load()
        else:
            df = self.spark.read.parquet(f"{self.root}/{name}.parquet")
        return df.select(*select) if select else df

    def sql(self, query: str) -> DataFrame:
        """A query of the database, or over the Parquet tables registered as views."""
        if self.jdbc:
            return self.spark.read.format("jdbc").options(**self.jdbc).option("query", query).load()
        return self.spark.sql(query)

    def register(self, *names: str) -> None:
        for n in names:
            self.table(n).createOrReplaceTempView(n)
