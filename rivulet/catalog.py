"""Named datasets as Parquet directories: read, overwrite, append, replace a range of dates, merge by key.

A dataset is a directory of versions; numbered text files name the live ones, and the highest number counts. A write makes a
new version, then a file of the next number, which is renamed into place whole; older files go only after that.
So readers never see half a write, a crash at any point leaves the state before or after it, and a path being read is
never overwritten. Files are written through Hadoop's file system, so any store that Spark writes to will do.
One writer at a time: of two that write the same number the second fails.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.operators.upsert import upsert

#: Increments after which a dataset is written as one version.
VERSIONS = 16


class Catalog:
    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")

    def _fs(self, path: str):
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), p

    def _states(self, name: str) -> list[tuple[int, str]]:
        """(number, path) of the files that name live versions, in order."""
        fs, p = self._fs(f"{self.root}/{name}")
        if not fs.exists(p):
            return []
        paths = [x.getPath() for x in fs.listStatus(p)]
        return sorted((int(m[1]), x.toString()) for x in paths if (m := re.fullmatch(r"_live\.(\d+)\.json", x.getName())))

    def _live(self, name: str) -> list[dict]:
        states = self._states(name)
        if not states:
            return []
        fs, p = self._fs(states[-1][1])
        stream = fs.open(p)
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def _swap(self, name: str, versions: list[dict]) -> None:
        states = self._states(name)
        fs, new = self._fs(f"{self.root}/{name}/_new.{uuid.uuid4().hex}")
        _, p = self._fs(f"{self.root}/{name}/_live.{states[-1][0] + 1 if states else 1:012d}.json")
        stream = fs.create(new, True)
        stream.write(bytearray(json.dumps(versions).encode()))
        stream.close()
        if not fs.rename(new, p):
            raise RuntimeError(f"another writer of {name} was faster")
        for _, old in states[:-1]:  # the one before stays for readers that have listed it
            fs.delete(self._fs(old)[1], False)

    def _write(self, name: str, df: DataFrame, partition_by: Sequence[str], tag: str | None = None) -> dict:
        version = tag or uuid.uuid4().hex
        # what a tag's earlier try has left isn't live
        writer = df.write.mode("overwrite" if tag else "errorifexists")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(f"{self.root}/{name}/{version}")
        return {"version": version, "partition_by": list(partition_by)}

    def exists(self, name: str) -> bool:
        return bool(self._live(name))

    def read(self, name: str) -> DataFrame:
        """The dataset; versions' columns are united."""
        live = self._live(name)
        if not live:
            raise FileNotFoundError(f"no such dataset: {name}")
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), (self._part(name, v) for v in live))

    def _part(self, name: str, version: dict) -> DataFrame:
        """A version's rows, without the partitions that a later one has taken over."""
        df = self.spark.read.parquet(f"{self.root}/{name}/{version['version']}")
        gone = version.get("without")
        return df.where(F.col(version["partition_by"][0]).isNull() | ~F.col(version["partition_by"][0]).isin(*gone)) if gone else df

    def overwrite(self, name: str, df: DataFrame, partition_by: Sequence[str] = ()) -> DataFrame:
        self._swap(name, [self._write(name, df, partition_by)])
        return self.read(name)

    def append(self, name: str, df: DataFrame, partition_by: Sequence[str] = (), tag: str | None = None) -> DataFrame:
        """Adds df's rows. A tag names the write: one that is live already isn't made again."""
        live = self._live(name)
        if tag is None or all(v["version"] != tag for v in live):
            self._swap(name, [*live, self._write(name, df, partition_by, tag)])
        return self.read(name)

    def replace_range(self, name: str, df: DataFrame, date_column: str, partition_by: Sequence[str] = ()) -> DataFrame:
        """Incremental write: rows of the dataset from df's first to its last date give way to df; earlier, later and
        undated ones stay. Nothing if df is empty.

        With one partition column, a function of the date such as the year, only partitions that df or the rows it
        replaces lie in are written again; the others stay where they are. After `VERSIONS` increments all is written once."""
        if not self.exists(name):
            return self.overwrite(name, df, partition_by)
        first, last = df.agg(F.min(date_column), F.max(date_column)).first()
        if first is None:
            return self.read(name)
        live, old = self._live(name), self.read(name)
        at, kind = F.col(date_column), old.schema[date_column].dataType
        inside = F.coalesce((at >= F.lit(first).cast(kind)) & (at <= F.lit(last).cast(kind)), F.lit(False))
        same = len(partition_by) == 1 and all(v["partition_by"] == list(partition_by) for v in live)
        if not same or len(live) >= VERSIONS:
            return self.overwrite(name, old.where(~inside).unionByName(df, allowMissingColumns=True), partition_by)
        key = partition_by[0]
        keys = df.select(key).unionByName(old.where(inside).select(key)).where(F.col(key).isNotNull()).distinct()
        touched = sorted(r[0] for r in keys.collect())  # a value per year
        kept = old.where(F.col(key).isin(*touched) & ~inside)
        new = self._write(name, kept.unionByName(df, allowMissingColumns=True), partition_by)
        self._swap(name, [*(v | {"without": sorted({*v.get("without", []), *touched})} for v in live), new])
        return self.read(name)

    def compact(self, name: str) -> DataFrame:
        """The dataset written as one version."""
        return self.overwrite(name, self.read(name), self._live(name)[-1]["partition_by"])

    def versions(self, name: str) -> int:
        return len(self._live(name))

    def merge(self, name: str, df: DataFrame, keys: Sequence[str], partition_by: Sequence[str] = ()) -> DataFrame:
        """Merge by key; a column that is new to the dataset is added to it."""
        if not self.exists(name):
            return self.overwrite(name, df, partition_by)
        old = self.read(name)
        for c in df.columns:
            if c not in old.columns:
                old = old.withColumn(c, F.lit(None).cast(df.schema[c].dataType))
        return self.overwrite(name, upsert(old, df, keys), partition_by)

    def high_water(self, name: str, column: str) -> object:
        """The dataset's greatest value of a column; None if there is none."""
        return self.read(name).agg(F.max(column)).first()[0] if self.exists(name) else None

    def copy(self, name: str, to: Catalog, columns: Sequence[str] | None = None) -> DataFrame:
        """The dataset, or some of its columns, published in another catalog."""
        df = self.read(name)
        return to.overwrite(name, df.select(*columns) if columns else df)
