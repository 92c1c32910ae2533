"""Exact duplicates as adjacent pairs, and which of a pair to keep."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rivulet.contracts import need


def adjacent_pairs(df: DataFrame, id_col: str, match_cols: Sequence[str]) -> DataFrame:
    """Distinct pairs (id_col, i.id_col): each id with the next smaller one that shares all match_cols, none null.

    A group of n equal rows gives n - 1 pairs, never all. Pairs come from a sort within equal match_cols."""
    need(df, [id_col, *match_cols])
    rows = df.select(id_col, *match_cols).dropna(subset=[id_col, *match_cols]).distinct()
    before = F.lag(id_col).over(Window.partitionBy(*match_cols).orderBy(id_col))
    return rows.select(F.col(id_col), before.alias(f"i.{id_col}")).where(F.col(f"`i.{id_col}`").isNotNull()).distinct()


def drop_related(pairs: DataFrame, households: DataFrame, associations: DataFrame, id_col: str = "customer_no", group_col: str = "group_customer_no", other_col: str = "associated_customer_no", both_ways: bool = False) -> DataFrame:
    """pairs without those of one household and those recorded as associated (as stored; both_ways: mirrored too)."""
    a, b = F.col(id_col), F.col(f"`i.{id_col}`")
    group = households.select(id_col, group_col).distinct()
    left = group.select(F.col(id_col).alias("_a"), F.col(group_col).alias("_ga"))
    right = group.select(F.col(id_col).alias("_b"), F.col(group_col).alias("_gb"))
    same = pairs.join(left, a == F.col("_a")).join(right, b == F.col("_b")).where("_ga = _gb").select(F.col("_a").alias("_x"), F.col("_b").alias("_y"))
    known = associations.select(F.col(id_col).alias("_x"), F.col(other_col).alias("_y"))
    if both_ways:
        known = known.unionByName(known.select(F.col("_y").alias("_x"), F.col("_x").alias("_y")))
    out = same.unionByName(known).distinct()
    return pairs.join(out, (a == F.col("_x")) & (b == F.col("_y")), "left_anti")


def keep_delete(pairs: DataFrame, facts: DataFrame, criteria: Sequence[tuple[str, str]], id_col: str = "customer_no", unknown: Mapping[str, object] | None = None) -> DataFrame:
    """pairs with keep_{id}, delete_{id} and keep_reason: the first criterion (column of facts, reason) in which the two
    differ decides, the greater is kept; null on either side decides nothing, but for columns of unknown, which take its
    value. Undecided: nulls."""
    cols = [c for c, _ in criteria]
    need(facts, [id_col, *cols])
    one = facts.dropDuplicates([id_col])
    left = one.select(F.col(id_col).alias("_a"), *(F.col(c).alias(f"_l{i}") for i, c in enumerate(cols)))
    right = one.select(F.col(id_col).alias("_b"), *(F.col(c).alias(f"_r{i}") for i, c in enumerate(cols)))
    a, b = F.col(id_col), F.col(f"`i.{id_col}`")
    df = pairs.join(left, a == F.col("_a"), "left").join(right, b == F.col("_b"), "left")
    instead = {cols.index(c): v for c, v in (unknown or {}).items() if c in cols}
    df = df.withColumns({f"_{s}{i}": F.coalesce(f"_{s}{i}", F.lit(v)) for i, v in instead.items() for s in "lr"}) if instead else df

    def first(x: Column, y: Column, said: bool) -> Column:
        picks = []
        for i, (_, reason) in enumerate(criteria):
            up, down = F.col(f"_l{i}") > F.col(f"_r{i}"), F.col(f"_l{i}") < F.col(f"_r{i}")
            picks.append(F.when(up | down, F.lit(reason)) if said else F.when(up, x).when(down, y))
        return F.coalesce(*picks)

    return df.select(*(F.col(f"`{c}`") for c in pairs.columns), first(a, b, False).alias(f"keep_{id_col}"), first(b, a, False).alias(f"delete_{id_col}"), first(a, b, True).alias("keep_reason"))
