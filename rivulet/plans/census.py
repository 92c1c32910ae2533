"""Census tables as features of places."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Mapping, Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.functions.text import slug
from rivulet.operators.asof import nearest_number
from rivulet.operators.debounce import debounce
from rivulet.operators.running import categories

#: Families of people's features (races, sexes, ages), each of which adds up to all people.
FAMILIES = 3
#: Features of people, and those of incomes.
PEOPLE, INCOMES = r"^address_(?!median|mean)", r"^address_(median|mean)"
#: What variables' labels have to say.
COUNTED = r"(?i)^(number|estimate|total)"
AGES = r"(?i)!!\d+ (to|and) \d+ years$|!!(18|19|20|21) years$|Under 5 years|85 years and over|(fe)?male$"


def variables(labels: DataFrame) -> DataFrame:
    """year, dataset, variable, type and race, sex, age or measure of variables whose label or concept tells them; the first of
    each kind per year and dataset, by name.

    labels: year, dataset, variable, label, concept. Counts by sex and age come from tables DP and P; a race is one
    race's; incomes are medians and means of households."""
    label, concept = F.col("label"), F.coalesce("concept", F.lit(""))
    by_age = (label.rlike("(?i)sex and age") | concept.rlike(r"(?i)^sex by age( \[49|$)")) & label.rlike(AGES) & F.col("variable").rlike(r"^(DP\d|P\d)") & label.rlike(COUNTED)
    one_race = label.rlike(r"(?i)^(number|estimate|total).+one race!![^!]+$")
    income = label.rlike("(?i)(median|mean) household income") & label.rlike("(?i)number|estimate|total")
    kind = F.when(income, "income").when(one_race, "race").when(by_age, "sex_and_age")
    found = lambda pattern, i=0: F.nullif(F.regexp_extract(label, pattern, i), F.lit(""))
    df = labels.withColumn("type", kind).where("type is not null")
    is_a = lambda k: F.col("type") == k
    df = df.withColumns({
        "race": F.when(is_a("race"), found(r"(?i)([^!]+?)( alone)?$", 1)),
        "sex": F.when(is_a("sex_and_age"), F.initcap(found(r"(?i)(female|male)", 1))),
        "age": F.when(is_a("sex_and_age"), found(r"(?i)(?:!!|^)([^!]*year[^!]*)$", 1)),
        "measure": F.when(is_a("income"), F.initcap(found("(?i)(mean|median)", 1))),
    })
    df = df.where("type <> 'sex_and_age' or sex is not null or age is not null")
    df = df.withColumn("_kind", F.lower(F.concat_ws("|", F.coalesce("race", F.lit("-")), F.coalesce("sex", F.lit("-")), F.coalesce("age", F.lit("-")), F.coalesce("measure", F.lit("-")))))
    return debounce(df, ["year", "dataset", "type", "_kind"], ["variable"], keep="first").drop("_kind")


def get_all(catalogued: Mapping[tuple[int, str], DataFrame]) -> DataFrame:
    """Tables of several years and datasets, one under the other; a table that couldn't be had is left out by not being there."""
    parts = [df.withColumns({"year": F.lit(y), "dataset": F.lit(d)}) for (y, d), df in catalogued.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def download(spark: SparkSession, wanted: Sequence[tuple[int, str]], states: Sequence[str], ask: Callable[[int, str, str], list[dict] | None]) -> DataFrame:
    """Tables of every year and dataset wanted, state by state: ask(year, dataset, state) gives rows of GEOID, variable, value or
    estimate, moe. One task per few calls, on the executors; a call that fails leaves its state out."""
    calls = spark.createDataFrame([(y, d, s) for y, d in wanted for s in states], "year int, dataset string, state string")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = {"GEOID": "object", "variable": "object", "value": "float64", "estimate": "float64", "moe": "float64", "year": "int64", "dataset": "object"}
        for b in batches:
            for r in b.itertuples(index=False):
                try:
                    rows = ask(r.year, r.dataset, r.state) or []
                except Exception:  # noqa: BLE001  a provider's failure is a state not had
                    rows = []
                yield pd.DataFrame([{"year": r.year, "dataset": r.dataset} | x for x in rows], columns=list(columns)).astype(columns)

    return calls.repartition(max(1, min(len(wanted) * len(states), 64))).mapInPandas(run, "GEOID string, variable string, value double, estimate double, moe double, year int, dataset string")


def data(tables: DataFrame, known: DataFrame) -> DataFrame:
    """Values with what their variable is; value is a decennial count or a survey's estimate, moe its margin of error (null: none).
    Of 2010 only the decennial set sf1 counts for people, as it and the survey tell the same."""
    value = F.coalesce(*(F.col(c).cast("double") for c in ("value", "estimate") if c in tables.columns))
    moe = F.col("moe").cast("double") if "moe" in tables.columns else F.lit(None).cast("double")
    rows = tables.withColumns({"value": value, "moe": moe}).join(known, ["year", "dataset", "variable"])
    return rows.where("type = 'income' or year <> 2010 or dataset = 'sf1'")


def _added(rows: DataFrame, feature: F.Column) -> DataFrame:
    """year, GEOID, feature, value, moe: sums, nulls as 0."""
    sums = {c: F.coalesce(F.sum(c), F.lit(0.0)).alias(c) for c in ("value", "moe")}
    return rows.groupBy("year", "GEOID", feature.alias("feature")).agg(*sums.values())


def race_features(rows: DataFrame) -> DataFrame:
    race = F.when(F.col("race").rlike("(?i)some other"), F.lit("Other")).otherwise(F.col("race"))
    return rows.where("type = 'race'").select("year", "GEOID", race.alias("feature"), "value", "moe")


def sex_features(rows: DataFrame) -> DataFrame:
    return _added(rows.where("type = 'sex_and_age' and age is null and sex in ('Female', 'Male')"), F.col("sex"))


def band_start(text: str = "age") -> F.Column:
    """First age of a band such as 'Under 5 years', '5 to 9 years', '85 years and over', '21 years'."""
    return F.when(F.lower(text).startswith("under"), F.lit(0)).otherwise(F.regexp_extract(text, r"(\d+)", 1).try_cast("int"))


def age_features(rows: DataFrame, bands: Sequence[str]) -> DataFrame:
    """Counts per age band; bands are the coarse ones, into which finer ones and single ages are added by their start."""
    some = rows.where("type = 'sex_and_age' and age is not null").withColumn("_start", band_start())
    first = lambda band: 0 if band.lower().startswith("under") else int(re.search(r"\d+", band)[0])
    band = F.lit(None).cast("string")
    for name in sorted(bands, key=first):  # a few bands: an expression, no join
        band = F.when(F.col("_start") >= first(name), F.lit(name)).otherwise(band)
    band = F.when(F.col("age").isin(*bands), F.col("age")).otherwise(band)
    return _added(some, band)


def income_features(rows: DataFrame) -> DataFrame:
    return rows.where("type = 'income' and measure is not null").select("year", "GEOID", F.concat_ws(" ", "measure", F.lit("Income")).alias("feature"), "value", "moe")


def features(rows: DataFrame, bands: Sequence[str], domain: Sequence[str] | None = None) -> DataFrame:
    """year, GEOID and a column address_{feature}_level per feature, lower case, 0 where a place has no such value. domain: the columns;
    one small collect finds them if None, and raises beyond 500."""
    long = race_features(rows).unionByName(sex_features(rows)).unionByName(age_features(rows, bands)).unionByName(income_features(rows))
    long = long.where("feature is not null").withColumn("feature", slug(F.concat_ws(" ", F.lit("address"), "feature", F.lit("level"))))
    names = list(domain) if domain is not None else categories(long, "feature", 500)
    return long.groupBy("year", "GEOID").pivot("feature", names).agg(F.sum("value")).fillna(0.0, names)


def shares(df: DataFrame, cols: Sequence[str], families: int = FAMILIES) -> DataFrame:
    """df with each of cols as its share of their sum, times the number of families, each of which adds up to the same sum."""
    total = reduce(lambda a, b: a + b, (F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in cols))
    return df.withColumn("_total", total).withColumns({c: F.when(F.col("_total") != 0, F.col(c) / F.col("_total") * families) for c in cols}).drop("_total")


def address_census(addresses: DataFrame, table: DataFrame) -> DataFrame:
    """addresses (GEOID, timestamp) with the nearest year's features of their place: people's as shares of their sum, times three; no
    income of 0."""
    cols = [c for c in table.columns if c not in ("year", "GEOID")]
    rows = addresses.withColumn("_year", F.year("timestamp"))
    rows = nearest_number(rows, table, ["GEOID"], "_year", "year", cols).drop("_year")
    people = [c for c in cols if re.search(PEOPLE, c)]
    out = shares(rows, people) if people else rows
    return out.withColumns({c: F.when(F.col(c) != 0, F.col(c)) for c in cols if re.search(INCOMES, c)})
