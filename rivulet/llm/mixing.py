"""Mixing sources to target weights by Pareto order sampling.

A target in words per source comes from weights by water-filling: a source gets its share of all words
until it reaches a multiple of its own size, and what is above is shared again by weight. Within a
source each class of documents (a few values of a preference) gets an expected number of copies,
again by water-filling; without a preference, the default, all of a source's documents have equal odds, and odds differ
between sources. The whole part of that number is taken for certain. Of the rest p, a Pareto
sample is drawn: documents are ranked by their random odds over their inclusion odds,
(u / (1 - u)) / (p / (1 - p)), and the lowest ranks are taken. The sample's size is fixed in words, the
unit of the targets: the prefix of ranks whose words come nearest to what the certain copies leave.

Scale: a document's row is its id, source, size and random number, stored once; what follows are sums by
(source, rank bucket), and a sort only within the one bucket per source that the cut falls in (1/256 of a
source at most). The mix itself is a join with a table of one row per source and class. Sources are numbered range by
range, and the level of their targets comes from sums, so there may be as many sources as web domains; the driver sees
three numbers a round and two a range.

Defined results
- null text: 0 words; such documents are taken in whole copies, the rest by rank like others, at 0 words.
- null source: a source of its own, last in order. Null preference: 1.
- random numbers depend on seed, id and size alone, so reruns agree, and repeated rows share their rank. Where the cut falls
  among rows of one rank, as many of them are taken as bring the source nearest to its target; which of them, the table's layout says.
- a source of size 0 has target 0. Empty table: empty result.
- only the named columns are read; others can't clash.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rivulet.durable import stored
from rivulet.llm.common import uniform_of, whole_text, word_count
from rivulet.operators.ordered import numbered

#: Rank buckets are so many per unit of log odds; a unit holds a quarter of a source at most.
PER_UNIT = 64


def water_fill(df: DataFrame, by: list[str], key: str, weight: str, cap: str, total: str, out: str) -> DataFrame:
    """Adds out: min(cap, level * weight), the level per group `by` such that out adds up to total (a column,
    the same in a group, at most the sum of caps). `key` breaks ties. Closed form: in order of cap / weight,
    the level would be what is left over the weight that is left; it holds from the first row it fits."""
    order = Window.partitionBy(*by).orderBy((F.col(cap) / F.col(weight)).asc(), F.col(key).asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    left = F.col(total) - F.coalesce(F.sum(cap).over(before), F.lit(0))
    weights = F.sum(weight).over(order.rowsBetween(0, Window.unboundedFollowing))
    df = df.withColumn("_level", left / weights)
    df = df.withColumn("_fits", F.when(F.col("_level") * F.col(weight) <= F.col(cap), F.col("_level")))
    level = F.max("_fits").over(Window.partitionBy(*by))
    return df.withColumn("_at", level).withColumn(out, F.coalesce(F.least(F.col(cap).cast("double"), F.col("_at") * F.col(weight)), F.col(cap).cast("double"))).drop("_level", "_fits", "_at")


def water_level(df: DataFrame, weight: str, cap: str, size: str) -> float:
    """The level such that min(cap, level * weight) adds up to the sum of size (whole numbers, at most the sum of caps), over
    all rows. Each round is one sum over the rows: what those at their caps leave, over the weight of the others. The level
    only rises, each round brings a row more to its cap or is the last, and the driver sees three numbers a round."""
    level, capped = 0.0, -1
    while True:
        full = F.col(cap) <= F.lit(level) * F.col(weight)
        left = F.sum(size) - F.coalesce(F.sum(F.when(full, F.col(cap))), F.lit(0))
        got = df.agg(F.count_if(full), left, F.coalesce(F.sum(F.when(~full, F.col(weight))), F.lit(0.0))).first()
        if got[0] == capped or not got[2]:
            return level
        level, capped = max(level, got[1] / got[2]), got[0]


def alike(size: Column) -> Column:
    """No preference."""
    return F.lit(1.0)


def measured(docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: int, preference=alike) -> DataFrame:
    """doc_id, source, size, u, pref: all that the plan and the choice need of a document."""
    text = whole_text(F.col(text_col))
    df = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"), word_count(text).alias("size"))
    return _drawn(df, seed, preference)


def _drawn(df: DataFrame, seed: int, preference) -> DataFrame:
    """Adds u and pref."""
    u = uniform_of(F.concat_ws(":", F.lit(str(seed)), F.col("doc_id").cast("string"), F.col("size").cast("string")))
    return df.withColumn("u", u).withColumn("pref", F.coalesce(preference(F.col("size")).cast("double"), F.lit(1.0)))


def _odds(df: DataFrame) -> Column:
    """Log of the Pareto rank."""
    u, p = F.col("u"), F.col("p")
    return F.log(u / (1 - u)) - F.log(p / (1 - p))


def _same(a: DataFrame, b: DataFrame, *names: str) -> Column:
    return reduce(lambda x, y: x & y, (a[n].eqNullSafe(b[f"_{n}"]) for n in names))


def _renamed(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumnsRenamed({n: f"_{n}" for n in names})


def plan(rows: DataFrame, weights: tuple[float, ...] = (1, 2, 3), most: int = 3) -> DataFrame:
    """Per source and preference: source, pref, source_size, target, whole (certain copies), p (chance of one
    more), cut (log rank up to which one more is taken; null: none), some (how many of the rows at the cut; null: all)."""
    classes = stored(rows.groupBy("source", "pref").agg(F.sum("size").alias("class_size")), "mix-class-sizes")
    sources = classes.groupBy("source").agg(F.sum("class_size").alias("source_size"))
    sources = stored(numbered(sources, [F.col("source").asc_nulls_last()], "place"), "mix-sources")
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), ((F.col("place") - 1) % len(weights) + 1).cast("int"))
    sources = sources.withColumns({"weight": weight, "most": F.col("source_size") * most})
    level = water_level(sources, "weight", "most", "source_size")
    target = F.least(F.col("most").cast("double"), F.lit(level) * F.col("weight"))
    sources = sources.select("source", "source_size", target.alias("target"))

    of = _renamed(sources, "source")
    classes = classes.join(of, _same(classes, of, "source")).drop("_source")
    classes = classes.withColumns({"w": F.col("pref") * F.col("class_size"), "c": F.col("class_size") * most})
    some = classes.where("class_size > 0 and pref > 0")
    some = water_fill(some, ["source"], "pref", "w", "c", "target", "words").select("source", "pref", (F.col("words") / F.col("class_size")).alias("copies"))
    some = _renamed(some, "source", "pref")
    classes = classes.join(some, _same(classes, some, "source", "pref"), "left").drop("_source", "_pref")
    # classes without words get what their source's words get on average
    copies = F.least(F.coalesce("copies", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")), F.lit(0.0)), F.lit(float(most)))
    near = F.when(F.abs(copies - F.round(copies)) < 1e-9, F.round(copies)).otherwise(copies)
    classes = classes.withColumn("copies", near).withColumns({"whole": F.floor("copies").cast("long"), "p": F.col("copies") - F.floor("copies")})
    classes = stored(classes.select("source", "pref", "class_size", "source_size", "target", "whole", "p"), "mix-classes")

    budget = classes.groupBy("source").agg((F.max("target") - F.sum(F.col("whole") * F.col("class_size"))).alias("budget"))
    ranked = ranks(rows, classes).where("p > 0").select("source", "size", "rank", F.floor(F.col("rank") * PER_UNIT).alias("bucket"))
    sums = ranked.groupBy("source", "bucket").agg(F.sum("size").alias("words"))
    upto = Window.partitionBy("source").orderBy("bucket")
    b = _renamed(budget, "source")
    sums = sums.withColumn("before", F.sum("words").over(upto) - F.col("words"))
    sums = sums.join(b, _same(sums, b, "source")).drop("_source").where("before <= budget and before + words > budget")
    edge = _renamed(sums.select("source", "bucket", "before", "budget"), "source", "bucket")
    inside = ranked.join(edge, _same(ranked, edge, "source", "bucket")).drop("_source", "_bucket")
    # equal ranks (repeated rows) are one step, of which a part may be taken
    steps = inside.groupBy("source", "rank").agg(F.sum("size").alias("words"), F.count("*").alias("n"), F.max("before").alias("before"), F.max("budget").alias("budget"), F.max("bucket").alias("bucket"))
    steps = steps.withColumn("before", F.col("before") + F.sum("words").over(Window.partitionBy("source").orderBy("rank")) - F.col("words"))
    steps = steps.withColumn("some", _nearest_count())
    cuts = steps.groupBy("source").agg(F.max(F.when(F.col("some") > 0, F.struct("rank", F.when(F.col("some") < F.col("n"), F.col("some")).alias("some")))).alias("last"), (F.max("bucket") / PER_UNIT).alias("edge"))
    # none in the edge bucket: what lies below it is taken
    cuts = cuts.select("source", F.coalesce("last.rank", F.col("edge") - 1e-12).alias("cut"), "last.some")
    full = ranked.groupBy("source").agg(F.sum("size").alias("words"), F.max("rank").alias("top"))
    full = full.join(b, _same(full, b, "source")).where("words <= budget").select("source", F.col("top").alias("cut"), F.lit(None).cast("long").alias("some"))
    cuts = _renamed(cuts.unionByName(full), "source")
    return classes.join(cuts, _same(classes, cuts, "source"), "left").drop("_source", "class_size")


def ranks(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """rows with their class's columns and log rank (null where p is 0)."""
    of = _renamed(classes, "source", "pref")
    df = rows.join(of, _same(rows, of, "source", "pref")).drop("_source", "_pref")
    return df.withColumn("rank", F.when(F.col("p") > 0, _odds(df)))


def _nearest_count() -> Column:
    """How many of the n rows of a step are taken: all whose half of words lies within the budget."""
    left, n = F.col("budget") - F.col("before"), F.col("n")
    size = F.col("words") / n
    fits = lambda j: j * size - size / 2 <= left
    about = F.floor(left / size + 0.5).cast("long")
    j = F.when(fits(about + 1), about + 1).when(fits(about), about).otherwise(about - 1)
    return F.when(F.col("words") > 0, F.greatest(F.lit(0), F.least(n, j))).otherwise(F.when(left >= 0, n).otherwise(F.lit(0))).cast("long")


def chosen(rows: DataFrame, made: DataFrame) -> DataFrame:
    """rows with copies: the certain ones and the sampled one. made: a stored plan."""
    df = ranks(rows, made)
    more = F.coalesce(F.col("rank") <= F.col("cut"), F.lit(False)).cast("long")
    if made.where(F.col("some").isNotNull()).isEmpty():
        return df.withColumn("copies", F.col("whole") + more)
    tied = F.coalesce((F.col("rank") == F.col("cut")) & F.col("some").isNotNull(), F.lit(False))
    others = df.where(~tied).withColumn("copies", F.col("whole") + more)
    return others.unionByName(_numbered(df.where(tied)).withColumn("copies", F.col("whole") + (F.col("_number") <= F.col("some")).cast("long")).drop("_number"))


def _numbered(rows: DataFrame) -> DataFrame:
    """rows, stored, with _number from 1 in each source: places within a partition after those of the partitions before, so
    that no task holds more than a partition, however many rows share a rank."""
    dealt = rows.withColumns({"_part": F.spark_partition_id(), "_at": F.monotonically_increasing_id()})
    dealt = stored(dealt, "mix-tied")
    counts = dealt.groupBy("source", "_part").agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.partitionBy("source").orderBy("_part")) - F.col("_n")
    counts = counts.select(F.col("source").alias("_source"), F.col("_part").alias("__part"), before.alias("_before"))
    df = dealt.join(counts, _same(dealt, counts, "source", "_part")).drop("_source", "__part")
    place = F.row_number().over(Window.partitionBy("source", "_part").orderBy("_at"))
    return df.withColumn("_number", F.col("_before") + place).drop("_part", "_at", "_before")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[float, ...] = (1, 2, 3), most: int = 3, seed: int = 20240607, preference=alike) -> DataFrame:
    """doc_id, size, source_size, target, taken (words the mix takes of the document), copies, source."""
    rows = stored(measured(docs, id_col, text_col, source_col, seed, preference), "mix-rows")
    made = stored(plan(rows, weights, most), "mix-plan")
    return chosen(rows, made).select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies", "source")


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[float, ...] = (1, 2, 3), most: int = 3, seed: int = 20240607, preference=alike) -> DataFrame:
    """docs with each row repeated as often as the mix takes it; the columns stay. Texts aren't shuffled: each row's
    size and random number are found again beside it and compared with the plan."""
    rows = stored(measured(docs, id_col, text_col, source_col, seed, preference), "mix-rows")
    made = stored(plan(rows, weights, most), "mix-plan")
    whole = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("row"))
    text = whole_text(F.col(f"row.`{text_col}`"))
    keyed = whole.select("row", F.col(f"row.`{id_col}`").alias("doc_id"), F.col(f"row.`{source_col}`").cast("string").alias("source"), word_count(text).alias("size"))
    keyed = _drawn(keyed, seed, preference)
    taken = chosen(keyed, made).where("copies > 0")
    return taken.select("row", F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int")))).select("row.*")
