"""Exact top-k inner products by norm-bucketed retrieval.

Candidates are dealt to ranges of their length, longest first, and stored so; a range is cut into tiles of at most `CHUNK`
vectors and `FLOATS` components. Queries are dealt to blocks of at most `BLOCK` vectors and as many components. Every query
meets the tile of the longest candidates first, and the k-th best score found there is its threshold from then on: it is
sent to the other tiles whose greatest length can reach that (length pruning), and to no others. A tile and a block that
have anything to do with each other meet in one task; what a task holds is bounded by the two sizes, whatever the table's.
No vector goes through the driver.

Within a tile, buckets of lengths that differ by a tenth at most are gone through from the longest. For a query and a
bucket, the k-th best score over the product of the lengths is the local cosine threshold that a candidate has to reach.
A threshold above 1 skips the bucket and, as buckets get shorter, all after it. A threshold above `COORDINATE` makes the
bucket be judged by the query's heaviest coordinates alone, the rest bounded by Cauchy-Schwarz (coordinate pruning). What is
left is verified by full products. Where no squared length reaches 2^53, products in doubles are exact (no partial sum passes
the product of two lengths); else what passes the pruning, with room for rounding, is verified in whole numbers of any size.

Defined results
- a row whose vector is null or holds null or non-finite components takes no part, nor does one with a null id. Vectors of
  different dimension aren't compared: each query meets the candidates of its own.
- a finite component that the scale takes beyond doubles raises, and so does a score met that doesn't fit 64 bits
  (OverflowError).
- "the query's own" row is every row of the query's id. Equal scores: the smaller id first, then repeated rows.
- rows repeated exactly count once as queries, each as a candidate. Empty table: empty result.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rivulet.durable import discard, stored
from rivulet.operators.ordered import numbered

#: Queries in a block; components in a block or tile; candidates in a tile.
BLOCK, FLOATS, CHUNK = 16384, 8_000_000, 16384
#: Cosine threshold from which coordinate pruning is tried, and coordinates it uses.
COORDINATE, HEAVIEST = 0.6, 16
#: Lengths within a bucket: the shortest over the longest.
RATIO, FEWEST = 0.9, 64


def floored(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 1024) -> DataFrame:
    """vec_id, v array<double> of floor(scale * x); only the rows that take part."""
    v = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    df = vectors.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v")).where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & fine)
    beyond = F.raise_error("a scaled component does not fit a double").cast("double")
    # from 2^52 on a double has no fraction
    whole = lambda x: F.when(F.abs(x) < float(1 << 52), F.floor(x).cast("double")).when(F.abs(x) < float("inf"), x).otherwise(beyond)
    return df.select("vec_id", F.transform("v", lambda x: whole(x * scale)).alias("v"))


def _best(rows: list, k: int) -> list:
    return heapq.nsmallest(k, rows, key=lambda r: (-r[1], r[0]))


def _product(a: np.ndarray, b: np.ndarray) -> int:
    """The inner product in whole numbers."""
    found = sum(int(x) * int(y) for x, y in zip(a.tolist(), b.tolist()))
    if not -(1 << 63) <= found < 1 << 63:
        raise OverflowError(f"a score does not fit 64 bits: {found}")
    return found


class Block:
    """A block of queries of one dimension with what the pruning needs. exact: products in doubles are; kth: the k-th best
    score that each query has elsewhere, -inf if it hasn't k."""

    def __init__(self, ids: np.ndarray, q: np.ndarray, k: int, exact: bool, kth: np.ndarray) -> None:
        self.ids, self.q, self.k, self.exact = ids, q, k, exact
        self.norms = np.sqrt((q * q).sum(1))
        self.heavy = np.argsort(-np.abs(q), axis=1, kind="stable")[:, : min(HEAVIEST, q.shape[1])]
        self.light = np.sqrt(np.maximum(self.norms**2 - (np.take_along_axis(q, self.heavy, 1) ** 2).sum(1), 0))
        self.found: list[list[tuple[int, int]]] = [[] for _ in ids]
        self.kth = kth.copy()

    def _add(self, j: int, ids: np.ndarray, vectors: np.ndarray, scores: np.ndarray) -> None:
        other = ids != self.ids[j]
        ids, vectors, scores = ids[other], vectors[other], scores[other]
        if self.exact and len(scores) > self.k:
            least = np.partition(scores, len(scores) - self.k)[len(scores) - self.k]
            ids, scores = ids[scores >= least], scores[scores >= least]
        if len(ids):
            whole = scores.astype(np.int64).tolist() if self.exact else [_product(self.q[j], v) for v in vectors]
            self.found[j] = _best([*self.found[j], *zip(ids.tolist(), whole)], self.k)
            if len(self.found[j]) == self.k:
                self.kth[j] = max(self.kth[j], self.found[j][-1][1])

    def see(self, ids: np.ndarray, p: np.ndarray) -> None:
        """Takes a tile of candidates into account."""
        norms = np.sqrt((p * p).sum(1))
        order = np.argsort(-norms, kind="stable")
        ids, p, norms = ids[order], p[order], norms[order]
        live, at = np.arange(len(self.ids)), 0
        while at < len(ids) and len(live):
            end = max(int(np.searchsorted(-norms, -norms[at] * RATIO, side="right")), min(at + FEWEST, len(ids)))
            if not np.isfinite(self.kth[live]).all():
                end = min(end, at + FEWEST)  # a first few candidates give a threshold
            bucket, of, size = p[at:end], ids[at:end], norms[at:end]
            reach = self.norms[live] * size[0]
            # lengths are rounded: allow for it, whole scores differ by 1 at least; so are products that aren't exact
            room = 0.5 + 1e-10 * self.norms * size[0]
            live = live[self.kth[live] <= reach + room[live]]
            need = self.kth if self.exact else self.kth - room
            with np.errstate(divide="ignore", invalid="ignore"):
                threshold = self.kth[live] / (self.norms[live] * size[0])
            near = threshold >= COORDINATE
            for part in np.array_split(live[~near], max(1, len(live) * len(of) // 4_000_000)):
                if len(part):
                    scores = self.q[part] @ bucket.T
                    for j in part[(scores >= need[part][:, None]).any(1)]:
                        s = scores[np.searchsorted(part, j)]
                        self._add(j, of[s >= need[j]], bucket[s >= need[j]], s[s >= need[j]])
            for j in live[near]:
                h = self.heavy[j]
                some = bucket[:, h]
                rest = np.sqrt(np.maximum(size**2 - (some * some).sum(1), 0))
                able = some @ self.q[j, h] + rest * self.light[j] + room[j] >= self.kth[j]
                if able.any():
                    s = bucket[able] @ self.q[j]
                    self._add(j, of[able][s >= need[j]], bucket[able][s >= need[j]], s[s >= need[j]])
            at = end

    def rows(self) -> tuple[list[int], list[int], list[int]]:
        """Of all queries: query, candidate, score."""
        got = [(int(q), i, s) for q, found in zip(self.ids, self.found) for i, s in found]
        return [q for q, _, _ in got], [i for _, i, _ in got], [s for _, _, s in got]


_FOUND = "query_id long, vec_id long, score long"
_KEY = ["n", "tile", "block"]


def _dealt(held: DataFrame, name: str, most: int) -> DataFrame:
    """held, stored, with its group in a column `name`: runs of at most `most` vectors of one dimension, longest first, and of
    at most FLOATS components (or one vector). Equal lengths and ids are split, too."""
    rows, floats = held.agg(F.count("*"), F.sum("n")).first()
    few = min(held.sparkSession.sparkContext.defaultParallelism, rows // 2048)  # small tables are dealt out, too
    parts = max(1, few, -(-rows // most), -(-(floats or 0) // FLOATS))
    # numbers run over all ranges, so how many groups there are doesn't depend on the ranges that Spark deals
    placed = numbered(held, [F.col("n"), F.col("square").desc(), F.col("vec_id")], "_place", ranges=parts)
    size = F.greatest(F.lit(1), F.least(F.lit(most), F.floor(F.lit(FLOATS) / F.greatest(F.col("n"), F.lit(1)))))
    out = stored(placed.withColumn(name, F.floor((F.col("_place") - 1) / size)).drop("_place"), f"topk-{name}s")
    discard(placed)
    return out


def _matrix(of: pa.Table, column: str, n: int) -> np.ndarray:
    flat = of[column].combine_chunks()
    flat = pa.concat_arrays(flat.chunks) if isinstance(flat, pa.ChunkedArray) else flat
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(len(of), n)


def _meet(candidates: DataFrame, routed: DataFrame, k: int, exact: bool) -> DataFrame:
    """query_id, vec_id, score: what the queries of each tile and block have in that tile among their k best. routed: n, tile,
    block, query_id, q, kth (null: none)."""

    def run(key: tuple, tile: pa.Table, block: pa.Table) -> pa.Table:
        n = key[0].as_py()
        state = None
        if len(tile) and len(block):
            kth = np.array([-np.inf if x is None else float(x) for x in block["kth"].to_pylist()])
            state = Block(block["query_id"].to_numpy(), _matrix(block, "q", n), k, exact, kth)
            state.see(tile["vec_id"].to_numpy(), _matrix(tile, "v", n))
        columns = state.rows() if state else ([], [], [])
        return pa.table([pa.array(c, pa.int64()) for c in columns], names=["query_id", "vec_id", "score"])

    # names of their own, as both sides come from one frame
    pairs = routed.select(*(F.col(c).alias(f"to_{c}") for c in _KEY)).distinct()
    met = candidates.select("n", "tile", "vec_id", "v").join(pairs, (F.col("n") == F.col("to_n")) & (F.col("tile") == F.col("to_tile")))
    met = met.select("to_n", "to_tile", "to_block", "vec_id", "v")
    return met.groupBy("to_n", "to_tile", "to_block").cogroup(routed.groupBy(*_KEY)).applyInArrow(run, _FOUND)


def _ranked(found: DataFrame) -> DataFrame:
    return found.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")))


def search(vectors: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 1024) -> DataFrame:
    """query_id, rank (from 1), vec_id, score of each query's k best. is_query is over vec_id."""
    square = F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)
    held = stored(floored(vectors, id_col, vector_col, scale).withColumns({"n": F.size("v"), "square": square}), "topk-vectors")
    exact = (held.agg(F.max("square")).first()[0] or 0.0) < float(1 << 53)
    candidates = _dealt(held, "tile", CHUNK)
    asked = stored(held.where(is_query).distinct(), "topk-asked")
    queries = _dealt(asked, "block", BLOCK)
    tiles = stored(candidates.groupBy("n", "tile").agg(F.sqrt(F.max("square")).alias("longest")), "topk-lengths")
    longest = tiles.groupBy("n").agg(F.min("tile").alias("tile"))

    sent = queries.select("n", "block", F.col("vec_id").alias("query_id"), F.col("v").alias("q"), F.sqrt("square").alias("length"))
    to_first = sent.join(longest, "n").withColumn("kth", F.lit(None).cast("long"))
    first = stored(_meet(candidates, to_first, k, exact), "topk-first")
    kth = _ranked(first).where(F.col("rank") == k).select("query_id", F.col("score").alias("kth"))
    others = tiles.join(longest, ["n", "tile"], "left_anti")
    # room for rounding, as within a tile
    reach = F.col("length") * F.col("longest") * (1 + 1e-10) + 0.5
    to_others = sent.join(kth, "query_id", "left").join(others, "n").where(F.col("kth").isNull() | (F.col("kth") <= reach))
    rest = stored(_meet(candidates, to_others, k, exact), "topk-rest")
    best = _ranked(first.unionByName(rest)).where(F.col("rank") <= k)
    out = stored(best.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"), "topk-best")
    for used in (held, candidates, asked, queries, tiles, first, rest):
        discard(used)
    return out
