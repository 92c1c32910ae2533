"""Shared expressions of the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A word is a run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def released(run: Callable[[Iterator], Iterator], cache: Callable[[], dict]) -> Callable[[Iterator], Iterator]:
    """run, after which the worker's cache is emptied and Arrow's unused memory given back: a Python worker lives
    through many tasks, of other stages too."""

    def task(batches: Iterator) -> Iterator:
        import pyarrow as pa

        try:
            yield from run(batches)
        finally:
            cache().clear()
            pa.default_memory_pool().release_unused()

    return task


def whole_text(text: Column) -> Column:
    """The text; a null counts as empty."""
    return F.coalesce(text.cast("string"), F.lit(""))


def words_of(text: Column) -> Column:
    """Array of the words of a non-null text, in order: all white space made spaces, then a split at one
    character, which is several times as fast as matching WORD."""
    rare = text
    for c in "\t\x0b\f\r":
        rare = F.replace(rare, F.lit(c), F.lit(" "))
    spaced = F.when(text.rlike(r"[\t\x0B\f\r]"), rare).otherwise(text)
    return F.array_remove(F.split(F.replace(spaced, F.lit("\n"), F.lit(" ")), " "), "")


def count_of(text: Column, characters: str) -> Column:
    """How often the (ASCII) characters occur in a text."""
    rest = text
    for c in characters:
        rest = F.replace(rest, F.lit(c), F.lit(""))
    some = text.rlike("[" + "".join(f"\\x{ord(c):02X}" for c in characters) + "]")
    return F.when(some, (F.length(text) - F.length(rest)).cast("long")).otherwise(F.lit(0).cast("long"))


def word_count(text: Column) -> Column:
    """Number of words of a non-null text, as long."""
    return F.size(words_of(text)).cast("long")


def uniform(seed: int, *columns: Column) -> Column:
    """A number in (0, 1) that depends on the seed and the columns' values alone."""
    h = F.xxhash64(F.lit(seed).cast("long"), *columns)
    return (F.shiftrightunsigned(h, 11).cast("double") + F.lit(0.5)) / F.lit(float(1 << 53))


def uniform_of(text: Column) -> Column:
    """A number in (0, 1) from the first 52 bits of a text's MD5, which other engines have too."""
    return (F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") + F.lit(0.5)) / F.lit(float(1 << 52))
