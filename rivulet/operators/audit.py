"""Rebuilding the full history of a table from its change log and its present state."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rivulet.contracts import from_end, need
from rivulet.operators.debounce import debounce

#: Kinds of history rows, in the order in which they stand for an entity.
KINDS = ("Creation", "Change", "Current")


def primary_key(registry: DataFrame, table: str) -> tuple[str, str]:
    """(base table, its key) of a table's short or base name; raises unless there is one table with one key column."""
    rows = registry.where((F.col("short_name") == table) | (F.col("base_table") == table)).select("base_table", "primary_keys").distinct().collect()
    if not rows:
        raise ValueError(f"no such table: {table}")
    keys = {k.strip() for r in rows for k in r["primary_keys"].split(",")}
    if len(rows) > 1 or len(keys) > 1:
        raise ValueError(f"{table} has more than one key")
    return rows[0]["base_table"], keys.pop()


def reconstruct(
    audit: DataFrame,
    base: DataFrame,
    key: str,
    columns: Mapping[str, str],
    logged: Sequence[str] = (),
    carry: Sequence[str] = ("group_customer_no", "customer_no"),
) -> DataFrame:
    """One row per state of each entity: key, timestamp, event_subtype (of KINDS), last_updated_by, carry, data columns.

    audit: alternate_key, date, userid, action, column_updated, old_value, new_value, and carry columns it has.
    base: key, create_dt, created_by, last_update_dt, last_updated_by, carry, data columns. columns maps the log's names
    to base's; logged are further names the log may have (give them, so that the plan doesn't depend on data).
    Values are strings, as the log has them. One shuffle by key after the pivot."""
    need(base, [key, "create_dt", "created_by", "last_update_dt", "last_updated_by", *columns.values()])
    need(audit, ["alternate_key", "date", "userid", "action", "column_updated", "old_value", "new_value"])
    names = list(dict.fromkeys([*columns, *logged]))
    key_type = base.schema[key].dataType
    both = [c for c in carry if c in base.columns]
    shared = [c for c in both if c in audit.columns]
    new = F.coalesce(F.col("new_value"), F.lit(""))
    log = audit.select(
        F.expr("try_cast(alternate_key as bigint)").cast(key_type).alias(key),
        F.col("date").alias("timestamp"),
        F.col("userid").alias("last_updated_by"),
        F.coalesce("column_updated", F.lit("NA")).alias("column_updated"),
        new.alias("new_value"),
        F.when(F.lower("action") == "inserted", new).otherwise(F.coalesce("old_value", F.lit(""))).alias("old_value"),
        *shared,
    )
    log = log.where(F.col("column_updated").isin(*names))
    log = debounce(log, [c for c in log.columns if c != "new_value"], ["new_value"])
    rank = {k: i for i, k in enumerate(KINDS)}

    changes = log.groupBy(key, "timestamp", "last_updated_by", "old_value", *shared).pivot("column_updated", names).agg(F.max("new_value")).drop("old_value")
    changes = changes.withColumn("_rank", F.lit(rank["Change"]))
    firsts = log.groupBy(key).pivot("column_updated", names).agg(F.min_by("old_value", F.struct("timestamp", "old_value")))
    made = base.select(key, *both, F.col("create_dt").alias("timestamp"), F.col("created_by").alias("last_updated_by"))
    made = made.join(firsts, key, "left").withColumn("_rank", F.lit(rank["Creation"]))
    now = base.select(key, *both, F.col("last_update_dt").alias("timestamp"), "last_updated_by", *(F.col(b).cast("string").alias(a) for a, b in columns.items()))
    now = now.withColumn("_rank", F.lit(rank["Current"]))

    rows = made.unionByName(changes, allowMissingColumns=True).unionByName(now, allowMissingColumns=True)
    order = Window.partitionBy(key).orderBy("_rank", "timestamp", "last_updated_by", *names)
    back, ahead = order.rowsBetween(Window.unboundedPreceding, 0), from_end([key], ["_rank", "timestamp", "last_updated_by", *names])
    filled = [*names, *both]
    rows = rows.withColumns({c: F.coalesce(F.last(c, ignorenulls=True).over(back), F.last(c, ignorenulls=True).over(ahead)) for c in filled})
    kind = F.element_at(F.array(*map(F.lit, KINDS)), F.col("_rank") + 1)
    rows = rows.withColumn("event_subtype", kind)
    out = debounce(rows, [key, "timestamp"], ["_rank", "last_updated_by", *names])
    return out.select(key, "timestamp", "event_subtype", "last_updated_by", *both, *names)


def reconstruct_open(
    audit: DataFrame,
    base: DataFrame,
    key: str,
    columns: Mapping[str, str],
    carry: Sequence[str] = ("group_customer_no", "customer_no"),
) -> DataFrame:
    """As `reconstruct`, for a log whose names aren't known: one row per entity and time with state, a map of every name that the
    log has for the entity, and of those of columns, to its value then.

    Values stay in rows (entity, name, time, value) and are filled forward, then backward along each name's own history, so no list of names is
    needed, nor a column for each. An entity's names times its rows are what a name's history is laid against, so the work
    grows with those of each entity and not with all names. Changes at one time are one row, by the greatest of who made
    them; of several values of a name at one time the greatest counts. Carry columns are base's."""
    need(base, [key, "create_dt", "created_by", "last_update_dt", "last_updated_by", *columns.values()])
    need(audit, ["alternate_key", "date", "userid", "action", "column_updated", "old_value", "new_value"])
    key_type = base.schema[key].dataType
    both = [c for c in carry if c in base.columns]
    rank = {k: i for i, k in enumerate(KINDS)}
    new = F.coalesce(F.col("new_value"), F.lit(""))
    log = audit.select(
        F.expr("try_cast(alternate_key as bigint)").cast(key_type).alias(key), F.col("date").alias("timestamp"), F.col("userid").alias("last_updated_by"),
        F.coalesce("column_updated", F.lit("NA")).alias("name"), new.alias("value"),
        F.when(F.lower("action") == "inserted", new).otherwise(F.coalesce("old_value", F.lit(""))).alias("old"),
    )
    now = F.explode(F.array(*(F.struct(F.lit(a).alias("name"), F.col(f"`{b}`").cast("string").alias("value")) for a, b in columns.items()))).alias("x")
    current = base.select(key, now, F.col("last_update_dt").alias("timestamp")).select(key, "x.*", "timestamp", F.lit(rank["Current"]).alias("_rank"))
    firsts = log.groupBy(key, "name").agg(F.min_by("old", F.struct("timestamp", "old")).alias("value"))
    firsts = firsts.join(base.select(key, F.col("create_dt").alias("timestamp")), key).withColumn("_rank", F.lit(rank["Creation"]))
    changed = log.groupBy(key, "name", "timestamp").agg(F.max("value").alias("value")).withColumn("_rank", F.lit(rank["Change"]))
    values = firsts.unionByName(changed).unionByName(current)

    made = base.select(key, F.col("create_dt").alias("timestamp"), F.col("created_by").alias("last_updated_by"), F.lit(rank["Creation"]).alias("_rank"))
    moves = log.groupBy(key, "timestamp").agg(F.max("last_updated_by").alias("last_updated_by")).withColumn("_rank", F.lit(rank["Change"]))
    stays = base.select(key, F.col("last_update_dt").alias("timestamp"), "last_updated_by", F.lit(rank["Current"]).alias("_rank"))
    rows = made.unionByName(moves).unionByName(stays)
    names = values.select(key, "name").distinct()
    at = [key, "name", "_rank", "timestamp"]
    laid = rows.join(names, key, "left").join(values.groupBy(*at).agg(F.max("value").alias("value")), at, "left")
    order = Window.partitionBy(key, "name").orderBy("_rank", "timestamp")
    back, ahead = order.rowsBetween(Window.unboundedPreceding, 0), from_end([key, "name"], ["_rank", "timestamp"])
    laid = laid.withColumn("value", F.coalesce(F.last("value", ignorenulls=True).over(back), F.last("value", ignorenulls=True).over(ahead)))
    entry = F.when(F.col("name").isNotNull() & F.col("value").isNotNull(), F.struct("name", "value"))
    state = F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("state")
    told = laid.groupBy(key, "timestamp", "_rank", "last_updated_by").agg(state)
    kept = debounce(told, [key, "timestamp"], ["_rank", "last_updated_by"])
    kind = F.element_at(F.array(*map(F.lit, KINDS)), F.col("_rank") + 1).alias("event_subtype")
    known = base.select(F.col(key).alias("_key"), *both)
    return kept.join(known, F.col(key) == F.col("_key"), "left").select(key, "timestamp", kind, "last_updated_by", *both, "state")
