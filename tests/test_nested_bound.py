"""Spreading to columns raises where it can't hold all keys."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from rivulet.operators import nested
from rivulet.plans import census


def test_widen_keeps_or_raises(spark):
    def keyed(n):
        return spark.range(n).select("id", F.create_map(F.concat(F.lit("k"), "id"), "id").alias("a.m"))

    assert len(nested.widen_all(keyed(1000)).columns) == 1001
    with pytest.raises(ValueError, match="1000"):
        nested.widen_all(keyed(1001))
    assert nested.widen(keyed(1001), "a.m", ["k1000"]).agg(F.max("`a.m.k1000`")).first()[0] == 1000


def test_census_features_keeps_or_raises(spark):
    bands = ["Under 5 years"]

    def rows(n):
        return spark.range(n).select(F.lit(2020).alias("year"), F.lit("1").alias("GEOID"), F.lit("race").alias("type"), F.concat(F.lit("r"), "id").alias("race"), F.lit(None).cast("string").alias("sex"), F.lit(None).cast("string").alias("age"), F.lit(1.0).alias("value"), F.lit(None).cast("double").alias("moe"), F.lit(None).cast("string").alias("measure"))

    assert len(census.features(rows(500), bands).columns) == 502
    with pytest.raises(ValueError, match="500"):
        census.features(rows(501), bands)
