"""Grouping of spelling variants by a symmetric-delete join.

Words are counted over all texts. Every word emits a key of itself and one of each of its distinct single deletions;
words that share a key are candidates, as any two words at distance one do: the shorter is a deletion of the longer, or
both lose the replaced letter. Keys are polynomial digests modulo a prime, so that a deletion's costs one
multiplication and a word of any length emits as many rows as it has letters, of two numbers each. What digests bring
together by chance goes when candidates are verified: the distance has to be exactly one.

No key has many words: those that share one are the key itself and what an inserted letter makes of it, so at most
(length + 1) * letters of the alphabet. A word's most frequent near word, if frequent enough, is its form; forms are
followed to the last by joining the table of forms with itself, each time twice as far. A form is `ratio` times as
frequent as its word, so chains are short: the rounds are the logarithm of a logarithm of the largest count.

Two near words whose own 64-bit digests are equal would be missed: a chance of 2^-64 a pair.

Defined results
- null or empty text: no words. Null id: as the empty id. Repeated rows and equal ids: each row counts.
- ties between near words of equal counts: the smallest in code-point order. Empty table: empty result.
- words of any length; texts are read whole. Only the id and the text are read, so other columns can't clash.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.durable import discard, stored

#: Words have at least so many code points and occurrences; a form has so many times the occurrences of its word.
LENGTH, OCCURRENCES, RATIO = 6, 5, 5
#: One in so many runs, by its digest with the id, loses a letter before it is counted.
SPOILT = 199
#: Distinct words a task counts before it passes them on; keys in a batch.
COUNTED, BATCH = 200_000, 100_000

#: Maximal runs of A-Z, a-z and U+00C0 to U+00FF in UTF-8 after ASCII lower-casing, `LENGTH` code points at least:
#: shorter ones can't become words.
_RUN = re.compile(rb"(?:[a-z]|\xc3[\x80-\xbf]){%d,}+" % LENGTH)
_PRIME, _BASE = (1 << 61) - 1, 0x1D2E1A4C3B5F6071 % ((1 << 61) - 1)


def spoil(run: bytes, digest_of_id: int) -> bytes:
    """The run, without one letter if its digest says so."""
    h = zlib.crc32(run, digest_of_id)
    if h % SPOILT:
        return run
    letters = run.decode()
    k = h % len(letters)
    return (letters[:k] + letters[k + 1 :]).encode()


def count_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """word, n: the words of all texts, counted in tasks before the shuffle."""
    import pyarrow as pa

    df = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.col(text_col).cast("string").cast("binary").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[bytes] = Counter()

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(found.keys(), pa.binary()), pa.array(found.values(), pa.int64())], ["word", "n"])
            found.clear()
            return out

        for b in batches:
            for doc_id, text in zip(b.column("id").to_pylist(), b.column("text")):
                start = zlib.crc32(f"{doc_id}:".encode())
                for word, times in Counter(_RUN.findall((text.as_py() or b"").lower())).items():
                    found[spoil(word, start)] += times
                if len(found) > COUNTED:
                    yield flush()
        yield flush()

    counts = df.mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counts.select(F.col("word").cast("string").alias("word"), "n").where((F.col("n") >= OCCURRENCES) & (F.length("word") >= LENGTH))


def keys_of(word: str) -> set[int]:
    """Digests of the word and of its single deletions; of equal neighbours one is deleted."""
    codes = [ord(c) + 1 for c in word]
    before = [0]
    for c in codes:
        before.append((before[-1] * _BASE + c) % _PRIME)
    whole = before[-1]
    out, power = {whole}, 1
    for i in range(len(codes) - 1, -1, -1):
        if not i or codes[i] != codes[i - 1]:
            out.add((whole + (before[i] - before[i + 1]) * power) % _PRIME)
        power = power * _BASE % _PRIME
    return out


def emit_keys(words: DataFrame) -> DataFrame:
    """key, id: the keys of every word with its 64-bit digest."""
    import pyarrow as pa

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys: list[int] = []
        ids: list[int] = []

        def made() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(ids, pa.int64())], ["key", "id"])
            keys.clear()
            ids.clear()
            return out

        for b in batches:
            for word, i in zip(b.column("word"), b.column("id")):
                some = keys_of(word.as_py())
                keys.extend(some)
                ids.extend([i.as_py()] * len(some))
                if len(keys) > BATCH:
                    yield made()
        yield made()

    return words.select("word", "id").mapInArrow(run, "key long, id long")


def near_pairs(words: DataFrame, keys: DataFrame) -> DataFrame:
    """Both directions of every pair of words at distance one: word, near, near_n. words: word, id, n; their keys: key, id."""
    a, b = keys.select("key", F.col("id").alias("a")), keys.select("key", F.col("id").alias("b"))
    candidates = a.join(b, "key").where(F.col("a") < F.col("b")).select("a", "b").distinct()
    left = words.select(F.col("id").alias("a"), F.col("word").alias("word_a"), F.col("n").alias("n_a"))
    right = words.select(F.col("id").alias("b"), F.col("word").alias("word_b"), F.col("n").alias("n_b"))
    near = candidates.join(left, "a").join(right, "b").where(F.levenshtein("word_a", "word_b", 1) == 1)
    ways = F.array(
        F.struct(F.col("word_a").alias("word"), F.col("word_b").alias("near"), F.col("n_b").alias("near_n")),
        F.struct(F.col("word_b").alias("word"), F.col("word_a").alias("near"), F.col("n_a").alias("near_n")),
    )
    return near.select(F.explode(ways).alias("x")).select("x.*")


def roots(forms: DataFrame) -> DataFrame:
    """word, root: the last of the forms that follow from each word. forms: word, form, stored."""
    at, before = forms.select("word", F.col("form").alias("root")), None
    while True:
        ahead = at.select(F.col("word").alias("root"), F.col("root").alias("further"))
        joined = stored(at.join(ahead, "root", "left").select("word", "root", "further"), "spelling-roots")
        if before is not None:
            discard(before)
        at, before = joined.select("word", F.coalesce("further", "root").alias("root")), joined
        if joined.where("further IS NOT NULL").isEmpty():
            return at


def group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of docs."""
    counts = count_words(docs, id_col, text_col)
    words = stored(counts.select("word", F.xxhash64("word").alias("id"), "n"), "spelling-words")
    best = F.min(F.struct((-F.col("near_n")).alias("m"), F.col("near").alias("near"))).alias("best")
    keys = stored(emit_keys(words), "spelling-keys")
    found = stored(near_pairs(words, keys).groupBy("word").agg(F.count("*").alias("n_near"), best), "spelling-near")
    discard(keys)
    with_near = words.select("word", "n").join(found, "word", "left")
    enough = -F.col("best.m") >= RATIO * F.col("n")
    named = stored(
        with_near.select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(enough, F.col("best.near")).alias("form"), F.when(enough, -F.col("best.m")).alias("form_n"),
        ), "spelling-forms",
    )
    discard(found)
    discard(words)
    ends = roots(named.where("form IS NOT NULL").select("word", "form"))
    return named.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
