"""Points in a region of many corners: several polygons, with holes.

The region lies under a grid. A cell that no edge touches is inside or outside as a whole. A cell on the border has the edges
that touch it, and knows whether its lower right corner is inside; from there a point is reached along the cell's right
side and then along the point's latitude, and every edge crossed on the way changes the answer. Points find their cell by a join on
its number, so a point is compared with the edges of its cell, not with all corners.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: (latitude, longitude) corners.
Ring = Sequence[tuple[float, float]]
#: Edges that cells hold in all up to which they are broadcast; beyond, cells and points are joined by a shuffle.
BROADCAST_EDGES = 2_000_000


class Region:
    """Rings of outlines and holes, in any order and direction: what an odd number of rings encloses is inside.

    cells: strips of the grid, and cells in a strip. The grid is built on the driver; its size is that of the rings. A point
    within rounding of an edge may fall to either side of it."""

    def __init__(self, rings: Sequence[Ring], cells: int | None = None) -> None:
        rows = [(a, b, c, d) if a < c else (c, d, a, b) for ring in rings for (a, b), (c, d) in zip(ring, [*ring[1:], ring[0]]) if (a, b) != (c, d)]
        if len(rows) < 3:
            raise ValueError("a region has a ring of three corners at least")
        low, low_lon, top, top_lon = e = np.array(rows, np.float64).T
        self.n = n = cells or max(1, min(512, math.isqrt(len(rows))))
        # lines of the grid lie off the corners' (mostly round) numbers
        self.high, self.wide = (top.max() - low.min()) / (n - 0.5), (e[[1, 3]].max() - e[[1, 3]].min()) / (n - 0.5) or 1.0
        self.lat, self.lon = low.min() - self.high * 0.2371, e[[1, 3]].min() - self.wide * 0.2371
        flat = top == low
        slope = (top_lon - low_lon) / np.where(flat, 1.0, top - low)
        near, owners, members, inside = 1e-9, [], [], np.zeros(n * n, bool)
        right = self.lon + np.arange(1, n + 1) * self.wide
        for i in range(n):
            base = self.lat + i * self.high
            met = (low <= base) & (base < top)
            seen = np.sort((base - low[met]) * slope[met] + low_lon[met])
            inside[i * n : (i + 1) * n] = (len(seen) - np.searchsorted(seen, right, side="right")) % 2 == 1
            some = np.flatnonzero((low <= base + (1 + near) * self.high) & (top >= base - near * self.high))
            ends = [low_lon[some] + (np.clip(y, low[some], top[some]) - low[some]) * slope[some] for y in (base - near * self.high, base + (1 + near) * self.high)]
            ends[1] = np.where(flat[some], top_lon[some], ends[1])
            first = np.clip(np.floor((np.minimum(*ends) - self.lon) / self.wide - near), 0, n - 1).astype(np.int64)
            last = np.clip(np.floor((np.maximum(*ends) - self.lon) / self.wide + near), 0, n - 1).astype(np.int64)
            times = last - first + 1
            owners.append(i * n + np.repeat(first, times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times))
            members.append(np.repeat(some, times))
        owner, member = np.concatenate(owners), np.concatenate(members)
        order = np.argsort(owner, kind="stable")
        owner, member = owner[order], member[order]
        kept = np.flatnonzero(inside | np.isin(np.arange(n * n), owner))
        edges = pa.StructArray.from_arrays([pa.array(x[member]) for x in (low, low_lon, top, top_lon)], ["a", "b", "c", "d"])
        offsets = np.searchsorted(owner, np.append(kept, n * n)).astype(np.int32)
        self.size = len(owner)
        self.table = pa.table({"_cell": pa.array(kept), "_corner": pa.array(inside[kept]), "_edges": pa.ListArray.from_arrays(pa.array(offsets), edges)})

    def _place(self, x: Column, low: float, size: float) -> Column:
        return F.floor((x - F.lit(float(low))) / F.lit(float(size)))

    def with_inside(self, df: DataFrame, lat: str, lon: str, name: str = "inside") -> DataFrame:
        """df with whether each point lies in the region; null where a coordinate is null, false where one isn't finite."""
        cells = df.sparkSession.createDataFrame(self.table)
        if self.size <= BROADCAST_EDGES:
            cells = F.broadcast(cells)
        y, x = F.col(f"`{lat}`").cast("double"), F.col(f"`{lon}`").cast("double")
        fits = y.between(float(self.lat), float(self.lat + self.high * self.n)) & x.between(float(self.lon), float(self.lon + self.wide * self.n))
        i, j = self._place(y, self.lat, self.high), self._place(x, self.lon, self.wide)
        placed = df.withColumn("_at", F.when(fits & (i < self.n) & (j < self.n), i * self.n + j)).join(cells, F.col("_at") == F.col("_cell"), "left")
        bottom = F.lit(float(self.lat)) + i * F.lit(float(self.high))
        side = F.lit(float(self.lon)) + (j + 1) * F.lit(float(self.wide))

        def crossed(e: Column) -> Column:
            # where the edge meets the cell's right side, and the point's latitude
            up = F.when(e["b"] != e["d"], e["a"] + (side - e["b"]) * ((e["c"] - e["a"]) / (e["d"] - e["b"])))
            at = F.when(e["a"] != e["c"], e["b"] + (y - e["a"]) * ((e["d"] - e["b"]) / (e["c"] - e["a"])))
            on_side = (F.least(e["b"], e["d"]) < side) & (side <= F.greatest(e["b"], e["d"])) & (bottom < up) & (up <= y)
            across = (e["a"] <= y) & (y < e["c"]) & (x < at) & (at <= side)
            return F.coalesce(on_side.cast("int"), F.lit(0)) + F.coalesce(across.cast("int"), F.lit(0))

        count = F.aggregate("_edges", F.lit(0), lambda n, e: n + crossed(e))
        inside = F.when(F.col("_cell").isNull(), False).otherwise(F.col("_corner") != (count % 2 == 1))
        return placed.withColumn(name, F.when(y.isNotNull() & x.isNotNull(), inside)).drop("_at", "_cell", "_corner", "_edges")
