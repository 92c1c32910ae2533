"""Surveys: wide sheets to long answers, without names."""

from __future__ import annotations

import warnings
from collections.abc import Callable, Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rivulet.catalog import Catalog
from rivulet.functions.text import anonymize, excel_time, file_stem, without_markup_spaces
from rivulet.operators.asof import asof_join
from rivulet.operators.upsert import upsert
from rivulet.sources.workbooks import cells

EMAIL = r"^[^@\s]+@[^@\s]+\.[^@\s]+$"
#: Columns that a survey's readers don't get.
SENSITIVE = ("address", "email", "customer_no", "group_customer_no")


def find_column(df: DataFrame, score: Callable[[Column], Column], criterion: str | float = "max") -> str | None:
    """The column with the greatest sum of scores (the first of equals), or the first whose sum exceeds a number; a
    warning if several do. One aggregate over all columns."""
    if criterion != "max" and not isinstance(criterion, (int, float)):
        raise ValueError("criterion is max or a number")
    sums = df.agg(*(F.sum(F.coalesce(score(F.col(f"`{c}`")).cast("double"), F.lit(0.0))).alias(f"s{i}") for i, c in enumerate(df.columns))).first()
    found = [x or 0.0 for x in sums]
    if criterion == "max":
        best = max(found, default=0)
        hits = [c for c, x in zip(df.columns, found) if x == best and x > 0]
    else:
        hits = [c for c, x in zip(df.columns, found) if x > criterion]
    if len(hits) > 1:
        warnings.warn(f"several columns fit: {', '.join(hits)}", stacklevel=2)
    return hits[0] if hits else None


def read_files(spark: SparkSession, folder: str) -> DataFrame:
    """filename, email, timestamp, question, subquestion, answer of the sheets (.xlsx, .csv) in a folder and those below it."""
    return answers(cells(spark, folder))


def answers(sheets: DataFrame) -> DataFrame:
    """Long answers of sheets' cells (filename, row, col, value): row 0 has the questions (blank: as the one before), row 1 the
    sub-questions. Each sheet's e-mail and time columns are those (the first, of several) that hold most of them.

    What a sheet's columns are is told by one row a column, joined back; a respondent's cells meet by file and row, so a large
    file's rows are dealt to many tasks."""
    sheets = sheets.withColumn("value", without_markup_spaces(F.col("value"))).where("value is not null and value <> ''")
    body = sheets.where("row > 1")
    number = F.col("value").try_cast("double")
    found = body.groupBy("filename", "col").agg(F.count_if(F.col("value").rlike(EMAIL)).alias("mails"), F.count_if(number.between(40000, 50000)).alias("times"))
    first = lambda n: F.max_by("col", F.when(F.col(n) > 0, F.struct(n, -F.col("col"))))
    mail = found.groupBy("filename").agg(first("mails").alias("_mail"))
    time = found.join(mail, "filename").where("_mail is null or col <> _mail").groupBy("filename", "_mail").agg(first("times").alias("_time"))
    special = mail.join(time.select(F.col("filename").alias("_f"), "_time"), F.col("filename") == F.col("_f"), "left").drop("_f")

    heads = sheets.where("row < 2").groupBy("filename", "col").agg(F.max(F.when(F.col("row") == 0, F.col("value"))).alias("_asked"), F.max(F.when(F.col("row") == 1, F.col("value"))).alias("subquestion"))
    heads = found.select("filename", "col").join(heads, ["filename", "col"], "outer")
    before = Window.partitionBy("filename").orderBy("col").rowsBetween(Window.unboundedPreceding, 0)  # a sheet's columns
    heads = heads.select("filename", "col", F.last("_asked", ignorenulls=True).over(before).alias("question"), "subquestion")

    row = Window.partitionBy("filename", "row")
    of = lambda c: F.max(F.when(F.col("col") == F.col(c), F.col("value"))).over(row)
    rows = body.join(special, "filename").withColumns({"email": of("_mail"), "_when": of("_time")})
    rows = rows.where("(_mail is null or col <> _mail) and (_time is null or col <> _time)").join(heads, ["filename", "col"])
    return rows.select("filename", "email", excel_time(F.col("_when")).alias("timestamp"), "question", "subquestion", F.col("value").alias("answer"))


def read_sheet(spark: SparkSession, sheet: pd.DataFrame) -> DataFrame:
    """email, timestamp, question, subquestion, answer of a sheet without header: its first row holds the questions (blank:
    as the one before), its second the sub-questions."""
    text = sheet.astype("object").where(sheet.notna(), None)
    names = text.iloc[0].ffill().tolist()
    subs = text.iloc[1].tolist()
    cols = [f"c{i}" for i in range(sheet.shape[1])]
    rows = [[None if v is None else str(v) for v in r] for r in text.iloc[2:].itertuples(index=False)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in cols))
    return melt(df, dict(zip(cols, zip(names, subs))))


def melt(df: DataFrame, headers: dict[str, tuple[str | None, str | None]]) -> DataFrame:
    """Long answers of a wide sheet of text; the e-mail and time columns are found by what they hold."""
    df = df.select(*(without_markup_spaces(F.col(c)).alias(c) for c in df.columns))
    email = find_column(df, lambda c: c.rlike(EMAIL).cast("int"))
    time = find_column(df.drop(email) if email else df, lambda c: c.cast("string").try_cast("double").between(40000, 50000).cast("int"))
    asked = [c for c in df.columns if c not in (email, time)]
    ids = [F.col(email).alias("email") if email else F.lit(None).cast("string").alias("email"), excel_time(F.col(time)).alias("timestamp") if time else F.lit(None).cast("timestamp_ntz").alias("timestamp")]
    long = df.select(*ids, *asked).unpivot(["email", "timestamp"], asked, "id", "answer").where("answer is not null")
    head = {k: F.create_map(*(x for c in asked for x in (F.lit(c), F.lit(headers[c][i])))) for i, k in enumerate(("question", "subquestion"))}
    return long.select("email", "timestamp", *(F.element_at(m, F.col("id")).alias(k) for k, m in head.items()), "answer")


def customers_of(rows: DataFrame, emails: DataFrame) -> DataFrame:
    """rows with the customer whose primary e-mail it was at the time."""
    primary = emails.where("primary_ind = 'Y'").select(F.lower(F.trim("address")).alias("email"), F.col("timestamp").alias("_since"), "customer_no", "group_customer_no")
    rows = rows.withColumn("email", F.lower(F.trim("email")))
    return asof_join(rows, primary, ["email"], "timestamp", "_since", ["customer_no", "group_customer_no"], tie=["customer_no"])


def number_question(rows: DataFrame, customers: DataFrame, share: float = 0.9) -> str | None:
    """The question to one sub-question of which more than that share of all respondents (e-mail and time) gave a known customer
    number that nobody gave before them; the first by name, if there are several."""
    asked = rows.select("question", "subquestion", F.col("answer").try_cast("int").alias("customer_no"))
    known = asked.join(customers.select("customer_no").distinct(), "customer_no", "left_semi")
    hits = known.groupBy("question", "subquestion").agg(F.count_distinct("customer_no").alias("n"))
    people = rows.select("email", "timestamp").distinct().count()
    hit = hits.where(F.col("n") > share * people).orderBy("question", "subquestion").limit(1).collect()
    return hit[0][0] if hit else None


def survey_stream(files: DataFrame | Sequence[tuple[str, DataFrame]], emails: DataFrame, customers: DataFrame, keys: tuple[str, str], catalog: Catalog | None = None, name: str = "survey_stream") -> DataFrame:
    """Answers of all files (one frame with filename, as of `read_files`, or a frame each) with hashed customers and no names; merged
    into the catalog's dataset if there is one.

    Merged by customer, time, question and sub-question, and by survey, as two surveys may ask the same at one time.
    Respondents who are no known customers have no hash to be told apart by: a survey's file replaces all of them that it
    had before. Raises if an answer isn't told apart by e-mail, time, question and sub-question."""
    if isinstance(files, DataFrame):
        rows = files
    else:
        rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [df.withColumn("filename", F.lit(path)) for path, df in files])
    rows = rows.withColumn("survey", file_stem(F.col("filename")))
    unique = ["email", "timestamp", "question", "subquestion"]
    if not rows.groupBy("survey", *unique).count().where("count > 1").isEmpty():
        raise ValueError("answers aren't unique by e-mail, time, question and sub-question")
    rows = customers_of(rows, emails)
    asked = number_question(rows, customers)
    if asked is not None:
        told = rows.where(F.col("question") == asked).groupBy("survey", "email", "timestamp").agg(F.max(F.col("answer").try_cast("int")).alias("_told"))
        home = customers.select(F.col("customer_no").alias("_told"), F.col("group_customer_no").alias("_home")).distinct()
        told = told.join(home, "_told", "left").withColumnsRenamed({"survey": "_s", "email": "_e", "timestamp": "_t"})
        rows = rows.join(told, F.col("survey").eqNullSafe(F.col("_s")) & F.col("email").eqNullSafe(F.col("_e")) & F.col("timestamp").eqNullSafe(F.col("_t")), "left")
        rows = rows.withColumns({"customer_no": F.coalesce("customer_no", "_told"), "group_customer_no": F.coalesce("group_customer_no", "_home")})
        rows = rows.where(F.col("question") != asked)
    rows = rows.select(anonymize(F.col("customer_no").cast("string"), keys).alias("customer_hash"), anonymize(F.col("group_customer_no").cast("string"), keys).alias("group_customer_hash"), "timestamp", "survey", "question", "subquestion", "answer", "filename")
    if catalog is None:
        return rows
    told = rows.where("customer_hash is not null")
    done = catalog.read(name) if catalog.exists(name) else rows.limit(0)
    merged = upsert(done.where("customer_hash is not null"), told, ["customer_hash", "timestamp", "survey", "question", "subquestion"])
    others = done.where("customer_hash is null").join(rows.select("survey").distinct(), "survey", "left_anti").select(*rows.columns)
    return catalog.overwrite(name, merged.unionByName(others).unionByName(rows.where("customer_hash is null")).select(*rows.columns))


def survey_cross(rows: DataFrame, *patterns: str) -> DataFrame:
    """Answers to the questions that match each pattern (case counts), side by side by customer_hash, columns numbered .1, .2 and
    so on."""
    parts = []
    for i, p in enumerate(patterns, 1):
        part = rows.where(F.col("question").rlike(p))
        parts.append(part.select("customer_hash", *(F.col(c).alias(f"{c}.{i}") for c in rows.columns if c != "customer_hash")))
    return reduce(lambda a, b: a.join(b, "customer_hash", "outer"), parts)


def append_features(rows: DataFrame, tables: Sequence[DataFrame], keys: tuple[str, str], aggregates: Sequence[Column]) -> DataFrame:
    """rows with aggregates, by hashed household, of tables restricted to the survey's households and without SENSITIVE columns.

    An aggregate is taken over each table that has its columns; one that no table has raises."""
    members = rows.select("group_customer_hash").distinct()
    used = set()
    for table in tables:
        t = table.withColumn("group_customer_hash", anonymize(F.col("group_customer_no").cast("string"), keys)).join(members, "group_customer_hash", "left_semi")
        t = t.drop(*SENSITIVE)
        usable = [i for i, a in enumerate(aggregates) if i not in used and _fits(t, a)]
        used |= set(usable)
        if usable:
            rows = rows.join(t.groupBy("group_customer_hash").agg(*(aggregates[i] for i in usable)), "group_customer_hash", "left")
    missing = [str(a) for i, a in enumerate(aggregates) if i not in used]
    if missing:
        raise ValueError(f"no table has the columns of {', '.join(missing)}")
    return rows


def _fits(df: DataFrame, aggregate: Column) -> bool:
    """Whether the table has the columns of an aggregate; other faults of it are raised."""
    from pyspark.errors import AnalysisException

    try:
        df.groupBy("group_customer_hash").agg(aggregate).schema  # noqa: B018
    except AnalysisException as e:
        if "UNRESOLVED_COLUMN" not in str(e):
            raise
        return False
    return True
