"""E-mail promotions and responses as a stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.catalog import Catalog
from rivulet.operators.asof import asof_join
from rivulet.operators.debounce import last_state
from rivulet.operators.running import category_features

EMAIL_MEDIA = 3
SUBTYPES = ("Send", "Open", "Click", "Unsubscribe", "Soft Bounce", "Hard Bounce")
#: A response's code is a case-insensitive pattern, in order; else it stays as it is.
LADDER = (("open", "Open"), ("click", "Click"), ("unsub", "Unsubscribe"), ("soft", "Soft Bounce"), ("hard", "Hard Bounce"))


def data(promotions: DataFrame, responses: DataFrame, start: object, end: object) -> DataFrame:
    """E-mail promotions and responses in [start, end), and all others of the sources found there. A response has the
    greatest appeal, campaign and address of its source; nulls if the source has no promotion."""
    inside = lambda c: (F.col(c) >= F.lit(start).cast("timestamp_ntz")) & (F.col(c) < F.lit(end).cast("timestamp_ntz"))
    promotions = promotions.where(F.col("media_type") == EMAIL_MEDIA)
    found = promotions.where(inside("promote_dt")).select("source_no").unionByName(responses.where(inside("response_dt")).select("source_no")).distinct()
    promotions = promotions.join(found, "source_no", "left_semi")
    responses = responses.join(found, "source_no", "left_semi")
    of = promotions.groupBy("source_no").agg(*(F.max(c).alias(c) for c in ("appeal_no", "campaign_no", "eaddress")))
    return promotions.unionByName(responses.join(of, "source_no", "left"), allowMissingColumns=True)


def described(rows: DataFrame, codes: DataFrame, sources: DataFrame, extractions: DataFrame) -> DataFrame:
    """rows with event_subtype and the descriptions of source and extraction."""
    text = F.col("event_subtype")
    kind = F.when(text.isNull(), "Send")
    for pattern, name in LADDER:
        kind = kind.when(text.rlike(f"(?i){pattern}"), name)
    rows = rows.join(codes.select("response", "event_subtype"), "response", "left").withColumn("event_subtype", kind.otherwise(text))
    rows = rows.join(sources.select("source_no", "source_desc", "acq_dt"), "source_no", "left")
    return rows.join(extractions.select("source_no", "extraction_desc"), "source_no", "left")


def timed(rows: DataFrame, days: int = 30) -> DataFrame:
    """rows with a timestamp: a response's own; for a send the source's first response, if it is less than so many days
    from the promotion, before or after, else the promotion's. Timestamps that there are stay."""
    first = rows.groupBy("source_no").agg(F.min("response_dt").alias("_first"))
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    near = F.abs(micros("_first") - micros("promote_dt")) < days * 86_400_000_000
    at = F.coalesce("response_dt", F.when(near, F.col("_first")), "promote_dt")
    at = F.coalesce("timestamp", at) if "timestamp" in rows.columns else at
    return rows.join(first, "source_no", "left").withColumn("timestamp", at).drop("_first")


def addressed(rows: DataFrame, emails: DataFrame, spread: bool = False) -> DataFrame:
    """rows with eaddress: the given one, else the household's primary e-mail at the time, else the customer's; lower
    case and trimmed; and domain, what follows the last @. spread: rows without a household, or of one, may be too many for a task."""
    primary = emails.where("primary_ind = 'Y'")
    rows = asof_join(rows, primary, ["customer_no"], "timestamp", "timestamp", ["address"], tie=["address"], suffix="_customer", spread=spread)
    rows = asof_join(rows, primary, ["group_customer_no"], "timestamp", "timestamp", ["address"], tie=["address"], suffix="_house", spread=spread)
    text = F.trim(F.lower(F.coalesce("eaddress", "address_house", "address_customer")))
    return rows.withColumn("eaddress", text).withColumn("domain", F.regexp_replace("eaddress", ".+@", "")).drop("address_house", "address_customer")


def base(promotions: DataFrame, responses: DataFrame, codes: DataFrame, sources: DataFrame, extractions: DataFrame, emails: DataFrame, start: object, end: object) -> DataFrame:
    """All of the above; rows whose timestamp lies outside [start, end) go."""
    rows = timed(described(data(promotions, responses, start, end), codes, sources, extractions))
    rows = rows.where((F.col("timestamp") >= F.lit(start).cast("timestamp_ntz")) & (F.col("timestamp") < F.lit(end).cast("timestamp_ntz")))
    rows = addressed(rows, emails).withColumn("event_type", F.lit("Email"))
    return rows.withColumn("timestamp_id", F.unix_micros(F.col("timestamp").cast("timestamp")))


def features(rows: DataFrame, subtypes: Sequence[str] = SUBTYPES) -> DataFrame:
    """Counts, first and last times per subtype of the household so far."""
    return category_features(rows, "event_subtype", subtypes, ["group_customer_no"], "timestamp", "email_")


def email_stream(catalog: Catalog, rows: DataFrame, other: DataFrame | None = None, out: str = "email_stream", subtypes: Sequence[str] = SUBTYPES) -> DataFrame:
    """Writes rows, and another service's (source_no: its campaign, negative), with features, by year.

    With a dataset already there, rows from rows' first time on are replaced; features go on from each
    household's last state before."""
    if other is not None:
        rows = rows.unionByName(other.withColumn("source_no", -F.col("campaignid")), allowMissingColumns=True)
    names = {s: f"email_{s.lower().replace(' ', '_')}" for s in subtypes}
    done = features(rows, subtypes)
    if catalog.exists(out) and not rows.isEmpty():
        first = rows.agg(F.min("timestamp")).first()[0]
        state = last_state(catalog.read(out), ["group_customer_no"], first, tie=["timestamp_id"], patterns=["^email_"])
        state = state.drop("timestamp").withColumnsRenamed({c: f"_{c}" for c in state.columns if c.startswith("email_")})
        done = done.join(state, "group_customer_no", "left")
        for n in names.values():
            done = done.withColumns({
                f"{n}_count": F.col(f"{n}_count") + F.coalesce(f"_{n}_count", F.lit(0)),
                f"{n}_timestamp_min": F.coalesce(f"_{n}_timestamp_min", f"{n}_timestamp_min"),
                f"{n}_timestamp_max": F.coalesce(f"{n}_timestamp_max", f"_{n}_timestamp_max"),
            })
        done = done.select(*(c for c in done.columns if not c.startswith("_email_")))
    return catalog.replace_range(out, done.withColumn("year", F.year("timestamp")), "timestamp", ["year"])
