"""Language of code-switched text by a linear-chain conditional random field over words.

A word's features are its affixes, its letter n-grams, itself, and what lexicons say of it: how much more frequent it is
in its best language than in all, in steps. Features are digested to `BUCKETS` rows of weights, one a language; a chain
has weights of transitions from language to language and of beginnings. Forward and backward passes give
each word's probability of each language; a document's languages are the means of its words', and its own is the largest.
Runs of words of one language are its segments.

The field is fitted on a bounded sample of labelled text: windows of `WINDOW` words of training documents, about
`SAMPLE` a language, those of the smallest digests of their words, so that it doesn't depend on how rows are dealt and
copies of a window count once. One half of the windows makes the lexicons, the other is cut into pieces and spliced across
languages into chains, whose labels change where the pieces meet: transitions are learnt from those. The fit is Adagrad
on the log likelihood, in numpy, on the driver; the sample, and what is broadcast, are bounded by the parameters and the
number of languages. Prediction runs in tasks over whole texts: a batch's chains go side by side, word by word.

Defined results
- null text, and text without a letter: `und`, score 0, no segments.
- null or empty language: its rows teach nothing. Without any to learn from, every row gets `und`, score 0.
- ties between languages: the smallest by code point. Null id: as the empty id, so not held out (crc32 is 0).
- repeated rows and equal ids: each row is predicted alone. Empty table: empty result.
- a text of any length is read whole. Only id, text and language are read, so other columns can't clash.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rivulet.llm.common import released

UNKNOWN = "und"
#: Rows of feature weights; words in a window; windows of the sample, a language.
BUCKETS, WINDOW, SAMPLE = 1 << 16, 24, 3000
#: Words of a chain in training and of a spliced piece (shortest, longest); chains in a step; passes; learning rate; penalty.
CHAIN, PIECE, CHAINS, PASSES, RATE, PENALTY = 32, (2, 16), 128, 6, 0.3, 1e-5
#: Distinct words whose scores a task keeps, words scored at once, words of chains run side by side.
KEPT, SCORED, AT_ONCE = 300_000, 20_000, 400_000

_LETTERS = re.compile(r"[^\W\d_]+")


def held_out(id_column: Column) -> Column:
    return F.crc32(F.coalesce(id_column.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def words_of(text: str) -> list[str]:
    """Runs of letters, in lower case; runs of numerals that are no digits have no letter."""
    return [w for w in _LETTERS.findall(text.lower()) if w.isalpha() or any(c.isalpha() for c in w)]


_ODD = np.uint64(0x9E3779B97F4A7C15)


def _mixed(kind: int, *codes: np.ndarray) -> np.ndarray:
    """Rows of weights: a digest of the kind and the code points."""
    h = np.full(len(codes[0]), kind, np.uint64) * _ODD
    for c in codes:
        h = (h ^ (h >> np.uint64(29)) ^ c) * _ODD
    return ((h ^ (h >> np.uint64(32))) % np.uint64(BUCKETS)).astype(np.int64)


def features(words: Sequence[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, word) arrays, words ascending, of each kind: n-grams of two and three of the word in its frame, affixes up to
    four letters, the word itself. No word is empty."""
    codes = np.frombuffer("".join(f"<{w}>" for w in words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    starts = np.cumsum(sizes + 2) - sizes - 2
    word = np.repeat(np.arange(len(words)), sizes + 2)
    place = np.arange(len(codes)) - starts[word]
    for n in (2, 3):
        at = np.flatnonzero(place + n <= sizes[word] + 2)
        yield _mixed(n, *(codes[at + i] for i in range(n))), word[at]
    for n in range(1, 5):
        some = np.flatnonzero(sizes >= n)
        yield _mixed(10 + n, *(codes[starts[some] + 1 + i] for i in range(n))), some
        yield _mixed(20 + n, *(codes[starts[some] + 1 + sizes[some] - n + i] for i in range(n))), some
    power = np.full(int(sizes.max(initial=0)) + 2, _ODD | np.uint64(1), np.uint64).cumprod(dtype=np.uint64)
    yield _mixed(30, np.add.reduceat(codes * power[place], starts)), np.arange(len(words))


def windows(docs: DataFrame) -> DataFrame:
    """lang, h, words of every window of `WINDOW` words of docs (text, lang); h digests the words."""
    import pyarrow as pa

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for text, lang in zip(b.column("text"), b.column("lang")):
                words = words_of(text.as_py())
                some = [" ".join(words[i : i + WINDOW]) for i in range(0, len(words), WINDOW)]
                hs = [zlib.crc32(w.encode("utf-8", "surrogatepass")) for w in some]
                yield pa.RecordBatch.from_arrays([pa.array([lang.as_py()] * len(some), pa.string()), pa.array(hs, pa.int64()), pa.array(some, pa.string())], ["lang", "h", "words"])

    return docs.select("text", "lang").mapInArrow(run, "lang string, h long, words string")


def sample(docs: DataFrame, per_language: int = SAMPLE) -> list[tuple[str, int, list[str]]]:
    """(lang, h, words) of at most `per_language` windows a language, those of the smallest digests of docs (text, lang).

    Documents are drawn first, by a digest of their text, at a rate that gives a few times the windows wanted
    (letters are counted for that), so that not all training text is cut into windows.
    """
    spark = docs.sparkSession
    docs = docs.where("text IS NOT NULL AND lang IS NOT NULL AND lang <> ''")
    sizes = {r["lang"]: r["n"] for r in docs.groupBy("lang").agg(F.sum(F.length("text")).alias("n")).collect()}
    if not sizes:
        return []
    wanted = 8 * per_language * WINDOW * 8  # eight times the windows, of about eight characters a word
    rates = spark.createDataFrame([(k, min(1.0, wanted / max(n, 1))) for k, n in sizes.items()], "lang string, rate double")
    u = F.pmod(F.xxhash64(F.lit(17), F.col("text")), F.lit(1 << 30)) / float(1 << 30)
    drawn = docs.join(F.broadcast(rates), "lang").where(u < F.col("rate"))
    found = windows(drawn).groupBy("lang", "h").agg(F.min("words").alias("words"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("h"))  # over some times `per_language` rows
    rows = found.withColumn("place", place).where(F.col("place") <= per_language).collect()
    return sorted((r["lang"], r["h"], r["words"].split(" ")) for r in rows)


def lexicons(sampled: Sequence[tuple[str, int, list[str]]], langs: Sequence[str]) -> dict[str, int]:
    """word: language * 4 + step, of words that one language uses more than the others together; steps are powers of
    four of how much."""
    at = {lang: k for k, lang in enumerate(langs)}
    counts: dict[str, np.ndarray] = {}
    totals = np.ones(len(langs))
    for lang, _, words in sampled:
        totals[at[lang]] += len(words)
        for w in words:
            counts.setdefault(w, np.zeros(len(langs)))[at[lang]] += 1
    out = {}
    for w, c in counts.items():
        share = c / totals
        k = int(share.argmax())
        rest = (share.sum() - share[k]) + 0.25 / totals.sum()
        if share[k] > rest:
            out[w] = k * 4 + min(3, int(np.log(share[k] / rest) / np.log(4)))
    return out


@dataclass
class Field:
    """Weights: of features and lexicon steps, of transitions from row to column, of beginnings."""

    langs: list[str]
    lexicon: dict[str, int]
    weights: np.ndarray
    moves: np.ndarray
    begins: np.ndarray

    @classmethod
    def blank(cls, langs: Sequence[str], lexicon: dict[str, int]) -> Field:
        k = len(langs)
        return cls(list(langs), lexicon, np.zeros((BUCKETS + 4 * k + 1, k)), np.zeros((k, k)), np.zeros(k))

    def rows(self, words: Sequence[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Rows of `weights` that words add up, as `features` gives them; the last row is of words in no lexicon."""
        yield from features(words)
        none = len(self.weights) - 1 - BUCKETS
        yield BUCKETS + np.fromiter((self.lexicon.get(w, none) for w in words), np.int64, len(words)), np.arange(len(words))

    def emissions(self, words: Sequence[str]) -> np.ndarray:
        """A row of scores for each word."""
        out = np.zeros((len(words), len(self.langs)))
        if words:
            for rows, word in self.rows(words):
                if len(word):
                    first = np.flatnonzero(np.diff(word, prepend=-1))
                    out[word[first]] += np.add.reduceat(self.weights[rows], first, axis=0)
        return out


def marginals(scores: np.ndarray, lengths: np.ndarray, moves: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Forward-backward over chains side by side, longest first.

    scores: rows of emissions, step by step (first the first word of every chain, then the second of those that have
    one, ...). Gives each word's probabilities, the chains' log normalisers, expected transitions and expected beginnings.
    """
    k, steps = len(begins), int(lengths[0]) if len(lengths) else 0
    alive = np.searchsorted(-lengths, -np.arange(steps), side="left")
    starts = np.concatenate([[0], np.cumsum(alive)])
    top = scores.max(1, initial=-np.inf)
    local = np.exp(scores - top[:, None])
    shift = moves.max()
    m = np.exp(moves - shift)
    first = np.exp(begins - begins.max())
    ahead, scale = np.empty_like(scores), np.empty(len(scores))
    for t in range(steps):
        a, b = starts[t], starts[t + 1]
        x = first * local[a:b] if t == 0 else (ahead[starts[t - 1] : starts[t - 1] + alive[t]] @ m) * local[a:b]
        z = x.sum(1)
        scale[a:b] = z
        ahead[a:b] = x / z[:, None]
    back = np.ones_like(scores)
    pairs = np.zeros((k, k))
    for t in range(steps - 1, 0, -1):
        a, b, p = starts[t], starts[t + 1], starts[t - 1]
        y = back[a:b] * local[a:b] / scale[a:b, None]
        back[p : p + alive[t]] = y @ m.T
        pairs += ahead[p : p + alive[t]].T @ y
    out = ahead * back
    logs = np.log(scale) + top
    logs[alive[0] if steps else 0 :] += shift
    normaliser = np.zeros(len(lengths))
    for t in range(steps):
        normaliser[: alive[t]] += logs[starts[t] : starts[t + 1]]
    if steps:
        normaliser += begins.max()
    return out, normaliser, pairs * m, out[: alive[0]].sum(0) if steps else np.zeros(k)


def splice(sampled: Sequence[tuple[str, int, list[str]]], langs: Sequence[str], rng: np.random.Generator) -> tuple[list[str], np.ndarray]:
    """Windows cut into pieces that follow each other in a random order: words and their languages."""
    at = {lang: k for k, lang in enumerate(langs)}
    pieces: list[tuple[int, list[str]]] = []
    for lang, _, words in sampled:
        i = 0
        while i < len(words):
            n = int(rng.integers(PIECE[0], PIECE[1] + 1))
            pieces.append((at[lang], words[i : i + n]))
            i += n
    order = rng.permutation(len(pieces))
    words = [w for j in order for w in pieces[j][1]]
    return words, np.fromiter((pieces[j][0] for j in order for _ in pieces[j][1]), np.int64, len(words))


def _spans(firsts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of spans, one after the other."""
    return np.arange(sizes.sum()) + np.repeat(firsts - np.cumsum(sizes) + sizes, sizes)


def likelihood(field: Field, ids: np.ndarray, labels: np.ndarray, sizes: np.ndarray, flat: np.ndarray, firsts: np.ndarray) -> tuple[float, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Log likelihood of chains of equal length (ids and labels: chain by word) and its gradient: by distinct word, of
    which there are rows flat[firsts : firsts + sizes], by transition and by beginning; and the distinct words."""
    k = len(field.langs)
    own, place = np.unique(ids, return_inverse=True)
    place = place.reshape(ids.shape)
    take = _spans(firsts[own], sizes[own])
    scores = np.add.reduceat(field.weights[flat[take]], np.cumsum(sizes[own]) - sizes[own], axis=0)
    chains, n = ids.shape
    by_step = scores[place.T.ravel()]
    p, z, pairs, begun = marginals(by_step, np.full(chains, n), field.moves, field.begins)
    gold = labels.T.ravel()
    total = by_step[np.arange(len(gold)), gold].sum() + field.begins[labels[:, 0]].sum() + field.moves[labels[:, :-1], labels[:, 1:]].sum() - z.sum()
    d = -p
    d[np.arange(len(gold)), gold] += 1
    word = np.bincount((place.T.ravel()[:, None] * k + np.arange(k)).ravel(), d.ravel(), len(own) * k).reshape(len(own), k)
    moved = np.zeros((k, k))
    np.add.at(moved, (labels[:, :-1], labels[:, 1:]), 1)
    return float(total), word, moved - pairs, np.bincount(labels[:, 0], minlength=k) - begun, own


def fit(sampled: Sequence[tuple[str, int, list[str]]], seed: int = 5) -> Field | None:
    """A field of the sample's languages; None of an empty sample."""
    langs = sorted({lang for lang, _, _ in sampled})
    if not langs:
        return None
    lexical = [s for s in sampled if s[1] % 2]
    rest = [s for s in sampled if not s[1] % 2] or list(sampled)
    field = Field.blank(langs, lexicons(lexical, langs))
    rng = np.random.default_rng(seed)
    known = {w: i for i, w in enumerate(dict.fromkeys(w for _, _, words in rest for w in words))}
    pairs = list(field.rows(list(known)))
    flat, of = np.concatenate([r for r, _ in pairs]), np.concatenate([w for _, w in pairs])
    flat, sizes = flat[np.argsort(of, kind="stable")], np.bincount(of, minlength=len(known))
    firsts = np.cumsum(sizes) - sizes
    sums = [np.full(x.shape, 1e-2) for x in (field.weights, field.moves, field.begins)]
    for _ in range(PASSES):
        words, labels = splice(rest, langs, rng)
        ids = np.fromiter((known[w] for w in words), np.int64, len(words))
        n = min(CHAIN, len(ids))
        chains = len(ids) // n
        ids, labels = ids[: chains * n].reshape(chains, n), labels[: chains * n].reshape(chains, n)
        for i in range(0, chains, CHAINS):
            some = slice(i, i + CHAINS)
            _, by_word, moved, begun, own = likelihood(field, ids[some], labels[some], sizes, flat, firsts)
            rows, where = np.unique(flat[_spans(firsts[own], sizes[own])], return_inverse=True)
            k = len(langs)
            spread = np.repeat(by_word, sizes[own], axis=0)
            g = np.bincount((where[:, None] * k + np.arange(k)).ravel(), spread.ravel(), len(rows) * k).reshape(len(rows), k)
            g = g / len(ids[some]) - PENALTY * field.weights[rows]
            sums[0][rows] += g * g
            field.weights[rows] += RATE * g / np.sqrt(sums[0][rows])
            for x, grad, s in ((field.moves, moved, sums[1]), (field.begins, begun, sums[2])):
                grad = grad / len(ids[some]) - PENALTY * x
                s += grad * grad
                x += RATE * grad / np.sqrt(s)
    return field


class Scored:
    """Emissions of words, kept while there is room."""

    def __init__(self, field: Field) -> None:
        self.field = field
        self.at: dict[str, int] = {}
        self.table = np.zeros((KEPT, len(field.langs)))

    def of(self, words: list[str]) -> np.ndarray:
        """Rows of scores, one for each word."""
        new = [w for w in dict.fromkeys(words) if w not in self.at]
        if len(self.at) + len(new) > KEPT:
            self.at.clear()
            new = list(dict.fromkeys(words))
        first = len(self.at)
        if first + len(new) > len(self.table):
            self.table = np.zeros((first + len(new), self.table.shape[1]))
        for i in range(0, len(new), SCORED):
            part = new[i : i + SCORED]
            self.table[first + i : first + i + len(part)] = self.field.emissions(part)
        self.at.update(zip(new, range(first, first + len(new))))
        return self.table[np.fromiter(map(self.at.__getitem__, words), np.int64, len(words))]


def label_chains(field: Field, scored: Scored, chains: list[list[str]]) -> list[np.ndarray]:
    """Each word's probabilities of the languages, chain by chain."""
    lengths = np.fromiter(map(len, chains), np.int64, len(chains))
    order = np.argsort(-lengths, kind="stable")
    order = order[lengths[order] > 0]
    out = [np.zeros((0, len(field.langs)))] * len(chains)
    if not len(order):
        return out
    lens = lengths[order]
    emitted = scored.of([w for j in order for w in chains[j]])
    chain_at = np.cumsum(lens) - lens
    chain_of, step_of = np.repeat(np.arange(len(lens)), lens), np.arange(lens.sum()) - np.repeat(chain_at, lens)
    by_step = np.lexsort((chain_of, step_of))
    p, *_ = marginals(emitted[by_step], lens, field.moves, field.begins)
    back = np.empty_like(p)
    back[by_step] = p
    for j, part in zip(order, np.split(back, chain_at[1:])):
        out[j] = part
    return out


def predict(docs: DataFrame, field: Field | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, lang_pred, score, n_words, segments: runs of words of one likeliest language (lang, words: how many)."""
    import pyarrow as pa

    df = docs.select(F.col(id_col).alias("doc_id"), held_out(F.col(id_col)).alias("held_out"), F.col(text_col).cast("string").alias("text"))
    if field is None:
        return df.select("doc_id", "held_out", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(0).cast("long").alias("n_words"), F.lit(None).cast("array<struct<lang:string,words:long>>").alias("segments"))
    sent = docs.sparkSession.sparkContext.broadcast(field)
    kept: dict[int, Scored] = {}
    segment = pa.list_(pa.struct([("lang", pa.string()), ("words", pa.int64())]))
    names = ["doc_id", "held_out", "lang_pred", "score", "n_words", "segments"]

    def labelled(model: Field, scored: Scored, chains: list[list[str]]) -> list[tuple[str, float, int, list[dict]]]:
        out = []
        for p in label_chains(model, scored, chains):
            if not len(p):
                out.append((UNKNOWN, 0.0, 0, []))
                continue
            mean, best = p.mean(0), p.argmax(1)
            k = int(np.argmax(np.round(mean, 12)))
            ends = np.append(np.flatnonzero(np.diff(best)), len(best) - 1)
            runs = [{"lang": model.langs[best[e]], "words": int(n)} for e, n in zip(ends, np.diff(ends, prepend=-1))]
            out.append((model.langs[k], float(min(1.0, mean[k])), len(p), runs))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        scored = kept.setdefault(0, Scored(model))
        for b in batches:
            start, chains, size = 0, [], 0
            for i, text in enumerate(b.column("text")):
                chains.append(words_of(text.as_py() or ""))
                size += len(chains[-1])
                if size > AT_ONCE or i + 1 == b.num_rows:
                    cols = list(zip(*labelled(model, scored, chains)))
                    part = b.slice(start, len(chains))
                    yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("held_out"), pa.array(cols[0], pa.string()), pa.array(cols[1], pa.float64()), pa.array(cols[2], pa.int64()), pa.array(cols[3], segment)], names)
                    start, chains, size = i + 1, [], 0

    schema = f"doc_id {df.schema['doc_id'].dataType.simpleString()}, held_out boolean, lang_pred string, score double, n_words long, segments array<struct<lang:string,words:long>>"
    return df.mapInArrow(released(run, lambda: kept), schema)


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """predict, by a field fitted on the documents that aren't held out."""
    learn = docs.where(~held_out(F.col(id_col))).select(F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    return predict(docs, fit(sample(learn)), id_col, text_col)
