"""Quality rules: a threshold table compiled into one projection.

Measures are array and string functions of the text alone, so a document is judged within its own row:
no shuffle, no user functions. Windows of eight words are compared by a 64-bit hash built
by doubling (1, 2, 4, 8 words); positions of equal hashes
are found by sorting the document's own array, and only in documents whose hashes aren't all distinct.

Defined results
- null text: as empty (0 words, so base_failed).
- repeated rows and equal ids: each row is judged alone; null ids stay null.
- a text of any length is measured whole; memory is a few arrays of its words.
- empty table: empty result. Only the id and the text are read; other columns can't clash.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.llm.common import WORD, count_of, whole_text, words_of

#: Frequent words of the four languages of the corpus.
STOP_WORDS = (
    "the of and to in that is was for with on as are it be this by from at or an have not "
    "der die das und ist in den zu von mit ein eine nicht auf sich des dem im auch "
    "le la les des de et un une est que pour dans qui par sur pas avec du au en "
    "el los las y una es por con para del no se lo su"
).split()

#: Spans of repeated words are windows of this many words.
WINDOW = 8
SYMBOLS = "#*$%&|<>"

#: stop_ratio is the share of the words that are stop words.
#: name: (measure, lowest value kept, highest value kept); None: no bound. Ratios are over words or lines.
RULES: dict[str, tuple[str, float | None, float | None]] = {
    "n_words": ("n_words", 20, None),
    "mean_word_chars": ("mean_word_chars", 2, 14),
    "symbols_per_word": ("symbols_per_word", None, 0.3),
    "repeated_words": ("repeat_ratio", None, 0.30),
    "repeated_lines": ("dup_line_ratio", None, 0.50),
    "stop_words": ("stop_ratio", 0.02, None),
    "exclamations": ("exclamations_per_word", None, 0.30),
    "ellipsis_lines": ("ellipsis_line_ratio", None, 0.50),
    "bullet_lines": ("bullet_line_ratio", None, 0.95),
}


def _pairs(hashes: Column, step: int) -> Column:
    """Hash of each element with the one `step` later; as many fewer elements."""
    n = F.greatest(F.size(hashes) - F.lit(step), F.lit(0))
    return F.zip_with(F.slice(hashes, F.lit(1), n), F.slice(hashes, F.lit(step + 1), n), lambda a, b: F.xxhash64(a, b))


def _repeated(hashes: Column) -> Column:
    """Words in windows whose hash occurs twice or more: sort (hash, position), keep positions next to an equal
    hash, and add up what each window covers beyond the one before it."""
    at = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    n = F.size(at)
    edge = F.array(F.struct(F.lit(None).cast("long").alias("h"), F.lit(-1).alias("i")))
    before, after = F.concat(edge, F.slice(at, F.lit(1), n - 1)), F.concat(F.slice(at, F.lit(2), n - 1), edge)
    twice = F.zip_with(F.zip_with(at, before, lambda x, y: F.struct(x["i"].alias("i"), x["h"].alias("h"), (x["h"] == y["h"]).alias("same"))), after, lambda x, y: F.when(x["same"] | (x["h"] == y["h"]), x["i"]))
    places = F.sort_array(F.array_compact(twice))
    follow = F.concat(F.slice(places, F.lit(2), F.greatest(F.size(places) - 1, F.lit(0))), F.array(F.lit(1 << 30)))
    covered = F.zip_with(places, follow, lambda a, b: F.least(b - a, F.lit(WINDOW)))
    return F.aggregate(covered, F.lit(0).cast("long"), lambda s, x: s + x)


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def compiled(rules: dict[str, tuple[str, float | None, float | None]] = RULES) -> Column:
    """The table as one boolean expression over the measures' columns."""
    bounds = [F.col(m) >= F.lit(float(low)) for m, low, _ in rules.values() if low is not None]
    bounds += [F.col(m) <= F.lit(float(high)) for m, _, high in rules.values() if high is not None]
    return reduce(lambda a, b: a & b, bounds, F.lit(True))


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: dict[str, tuple[str, float | None, float | None]] = RULES) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (long), base_failed, kept
    (boolean), then the ratios that the rules use (double)."""
    df = docs.select(F.col(id_col).alias("doc_id"), whole_text(F.col(text_col)).alias("text"))
    df = df.select("doc_id", "text", words_of(F.col("text")).alias("words"))
    df = df.select(
        "doc_id", "text", "words",
        F.transform("words", lambda w: F.xxhash64(w)).alias("h1"),
        F.filter(F.split("text", "\n"), lambda line: line.rlike(WORD)).alias("lines"),
    )
    for k in (1, 2, 4):
        df = df.select("doc_id", "text", "words", "lines", _pairs(F.col(f"h{k}"), k).alias(f"h{2 * k}"))
    df = df.withColumnRenamed("h8", "windows")
    df = df.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        count_of(F.col("text"), SYMBOLS).alias("n_symbols"),
        count_of(F.col("text"), "!").alias("n_exclamations"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(F.size(F.array_distinct("windows")) < F.size("windows"), _repeated(F.col("windows"))).otherwise(F.lit(0).cast("long")).alias("n_repeat_words"),
        F.size(F.filter("words", lambda w: w.isin(*dict.fromkeys(STOP_WORDS)))).cast("long").alias("n_stop"),
        F.size(F.filter("lines", lambda x: F.rtrim(x).endswith("...") | F.rtrim(x).endswith("…"))).cast("long").alias("n_ellipsis"),
        F.size(F.filter("lines", lambda x: F.substring(F.ltrim(x), 1, 1).isin("-", "*", "•", "‣", "·"))).cast("long").alias("n_bullets"),
    )
    df = df.withColumns(
        {
            "mean_word_chars": _ratio(F.col("word_chars"), F.col("n_words")),
            "symbols_per_word": _ratio(F.col("n_symbols"), F.col("n_words")),
            "repeat_ratio": _ratio(F.col("n_repeat_words"), F.col("n_words")),
            "dup_line_ratio": _ratio(F.col("n_dup_lines"), F.col("n_lines")),
            "exclamations_per_word": _ratio(F.col("n_exclamations"), F.col("n_words")),
            "stop_ratio": _ratio(F.col("n_stop"), F.col("n_words")),
            "ellipsis_line_ratio": _ratio(F.col("n_ellipsis"), F.col("n_lines")),
            "bullet_line_ratio": _ratio(F.col("n_bullets"), F.col("n_lines")),
        }
    )
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    base = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    ratios = ["mean_word_chars", "symbols_per_word", "repeat_ratio", "dup_line_ratio", "exclamations_per_word", "stop_ratio", "ellipsis_line_ratio", "bullet_line_ratio"]
    return df.select(*base, failed.alias("base_failed"), (~failed & compiled(rules)).alias("kept"), *ratios)
