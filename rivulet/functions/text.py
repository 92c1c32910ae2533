"""Text and date expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.contracts import as_columns

#: Fixed value: text that stands for no address, or begins so; lower case.
JUNK = r"^(web add|unknown|no add)|^$"


def collapse(c: Column) -> Column:
    """White space as single spaces, none at the ends."""
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def title_case(c: Column) -> Column:
    """A capital after every word boundary, so also after an apostrophe or a hyphen; the rest lower case."""
    parts = F.regexp_extract_all(F.lower(c), F.lit("([A-Za-z0-9_]+|[^A-Za-z0-9_]+)"), F.lit(1))
    return F.array_join(F.transform(parts, lambda p: F.concat(F.upper(F.substring(p, 1, 1)), F.substring(p, 2, 1 << 30))), "")


def clean(c: Column, junk: str = JUNK) -> Column:
    """collapse and title_case; null where the text is junk (compared before its case is changed)."""
    one = collapse(c)
    return F.when(~one.rlike(junk), title_case(one))


def slug(c: Column, each: bool = False) -> Column:
    """Lower case with white space as underscores: a run as one, or each as its own."""
    return F.regexp_replace(F.lower(c), r"\s" if each else r"\s+", "_")


def blank_to_null(c: Column) -> Column:
    """Lower case, trimmed; null if nothing is left."""
    t = F.trim(F.lower(c))
    return F.when(t != "", t)


def repeated_word(c: Column) -> Column:
    """Whether a word occurs twice."""
    words = F.split(c, r"\s+")
    return F.size(words) != F.size(F.array_distinct(words))


def unite(df: DataFrame, out: str, cols: Sequence[str], sep: str = "_", remove: bool = True, skip_null: bool = False) -> DataFrame:
    """df with out: the columns joined by sep; a null is written NA, or left out with skip_null (all null: empty)."""
    parts = [c.cast("string") for c in as_columns(cols)]
    joined = F.concat_ws(sep, *(parts if skip_null else [F.coalesce(p, F.lit("NA")) for p in parts]))
    df = df.withColumn("_united", joined)
    return df.drop(*[c for c in cols if remove or c == out]).drop(out).withColumnRenamed("_united", out)


def separators(c: Column, sep: str = ",") -> Column:
    """How often sep occurs."""
    return F.size(F.split(c, f"\\Q{sep}\\E")) - 1


def file_stem(c: Column) -> Column:
    """A path's last part without its extension."""
    return F.regexp_extract(c, r"([^/\\]*?)(\.[^./\\]*)?$", 1)


def excel_time(c: Column) -> Column:
    """Days since 1899-12-30 as a time."""
    seconds = F.round(c.cast("double") * 86400).cast("long")
    return F.timestamp_seconds(seconds - 25569 * 86400).cast("timestamp_ntz")


def epoch_time(c: Column) -> Column:
    """Text of a time in ISO form or seconds since 1970 as a time; null if neither."""
    seconds = c.cast("string").try_cast("double")
    return F.coalesce(F.timestamp_seconds(seconds), F.try_to_timestamp(c.cast("string"))).cast("timestamp_ntz")


def hmac_sha256(key: str, message: Column) -> Column:
    """Keyed digest (RFC 2104) as 64 hexadecimal characters; null of null."""
    import hashlib

    k = key.encode()
    k = (hashlib.sha256(k).digest() if len(k) > 64 else k).ljust(64, b"\0")
    inner = F.sha2(F.concat(F.lit(bytes(b ^ 0x36 for b in k)), message.cast("string").cast("binary")), 256)
    return F.sha2(F.concat(F.lit(bytes(b ^ 0x5C for b in k)), F.unhex(inner)), 256)


def hmac_salted(key: str, salt: Column, message: Column) -> Column:
    """hmac_sha256 of salt and message with a hyphen between."""
    return hmac_sha256(key, F.concat(salt, F.lit("-"), message.cast("string")))


def anonymize(c: Column, keys: tuple[str, str]) -> Column:
    """An id's keyed digest, salted by the digest under another key."""
    return hmac_salted(keys[1], hmac_sha256(keys[0], c), c)


def without_markup_spaces(c: Column) -> Column:
    """Text without the space attributes that spreadsheets leave."""
    return F.regexp_replace(c, r'\s*xml:space="[^"]*">', "")
