"""Toxicity by noisy-channel deobfuscation.

A word may have come through a channel that writes letters as look-alikes, puts marks or white space between them or
repeats them. Its readings form a lattice of characters; a character trigram model and the channel's costs give the
best path (Viterbi). A word of plain letters, none twice in a row, has one path, itself, so only other words are
decoded, each distinct one once per worker while a bounded table has room. Single characters set apart are one lattice, in
which white space is a mark or the end of a word.

The restored words' beginnings and wholes that go with the label beyond chance are the features of a logistic
regression trained in numpy; the score is its probability.

The character model counts the letters of all documents' words, so it is the same however the table is dealt; the classifier is fitted on
a bounded sample of labelled documents, `LABELLED` at most, the smallest by a hash of their id, none of them held out.
Labels, ids, languages and sources are never inputs of a score.

Defined results
- null text: as empty; an empty text has the score of no features. Null id: as the empty id, so held out.
- several labels of an id: the highest counts; null labels are left out. Without labels of both kinds, or without
  features beyond chance, scores are the share of label 1 (smoothed).
- repeated rows and equal ids: each row is scored alone; a whole text is read. Empty table: empty result.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.durable import stored

#: Labelled documents used at most; features at most; chi-square that a feature needs; words a worker keeps.
LABELLED, FEATURES, CHI, KEPT = 20_000, 4096, 30.0, 400_000
#: Lengths of word beginnings that are features.
BEGINNINGS = (4, 5, 6, 7, 8)
#: Letters that a character may stand for.
LOOKS = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "¥": "y",
}
#: Costs (natural logs) of a look-alike, of a mark between letters, of a mark that is also a look-alike, of leaving
#: out a repeated letter, of white space between letters.
LOOK, MARK, DROP, REPEAT, SPACE = 1.0, 1.0, 20.0, 0.3, 0.5
LETTERS = "abcdefghijklmnopqrstuvwxyz" + "".join(map(chr, range(0xDF, 0xF7))) + "".join(map(chr, range(0xF8, 0x100)))
_CODE = {c: i + 1 for i, c in enumerate(LETTERS)}
_N = len(LETTERS) + 1

_PLAIN = re.compile(f"[{LETTERS}]+")
_EDGES = re.compile(r"^[^\w$@!|+(€£¥]+|[^\w$@]+$")
_MARKS = re.compile(r"([$@!|+(€£¥])\1\1+|^[!|+(]+(?=\W|$)|[!|+(]+$")
_RUN = re.compile(r"(.)\1")
_RUNS = re.compile(r"(.)\1*")
_SINGLE = "[" + LETTERS + re.escape("".join(LOOKS)) + "]"
_ONE = rf"(?:[.,;:\-_*~'\"?]*+{_SINGLE}[.,;:\-_*~'\"?)!]*+|[.,;:\-_*~'\"?]++)(?!\S)"
_APART = re.compile(rf"(?<!\S){_ONE}(?:\s++{_ONE}){{2,}}+")
_SINGLES = re.compile(_SINGLE)


def held_out(id_column: Column) -> Column:
    return F.crc32(F.coalesce(id_column.cast("string"), F.lit("")).cast("binary")) % 5 == 0


class CharModel:
    """Smoothed trigram costs over LETTERS and an edge."""

    def __init__(self, counts: np.ndarray) -> None:
        three = counts.reshape(_N, _N, _N).astype(np.float64)
        two, one = three.sum(0), three.sum((0, 1))
        p1 = (one + 1) / (one + 1).sum()
        p2 = (two + 5 * p1[None, :]) / (two.sum(1, keepdims=True) + 5)
        p3 = (three + 5 * p2[None, :, :]) / (three.sum(2, keepdims=True) + 5)
        self.cost = (-np.log(p3)).tolist()

    def spelled(self, word: str, most: int = 8) -> str | None:
        """What `decode` gives for a word of plain letters, whose paths differ in repeated letters alone, by going through them
        all; None if they are more than so many. Most words that have a lattice are of this kind."""
        runs = [m[0] for m in _RUNS.finditer(word)]
        ways: list[tuple[str, float]] = [("", 0.0)]
        for r in runs:
            n = len(r)
            if n == 1:
                ways = [(text + r, extra) for text, extra in ways]
                continue
            ways = [(text + r[:k], extra + REPEAT * (n - k)) for text, extra in ways for k in {1, 2, n}]
            if len(ways) > most:
                return None
        best = None
        cost = self.cost
        for text, total in ways:
            p = q = 0
            for y in text:
                r = _CODE[y]
                total += cost[p][q][r]
                p, q = q, r
            total += cost[p][q][0]
            if best is None or (total, text) < best:
                best = total, text
        return best[1]

    def decode(self, word: str) -> str:
        """The best path through the word's lattice."""
        states: dict[tuple[int, int], tuple[float, str]] = {(0, 0): (0.0, "")}
        i = 0
        while i < len(word):
            c = word[i]
            if c == " ":  # between single characters: a mark, or the word's end
                ended = min((cost + self.cost[a][b][0], text + " ") for (a, b), (cost, text) in states.items())
                states = {k: (cost + SPACE, text) for k, (cost, text) in states.items() if k != (0, 0)} | {(0, 0): ended}
                i += 1
                continue
            j = i + 1
            while j < len(word) and word[j] == c:
                j += 1
            run = j - i
            letters = c if c in _CODE else LOOKS.get(c, "")
            base = 0.0 if c in _CODE else LOOK
            arcs = []
            for x in letters:
                for n in {1, min(2, run), run}:
                    arcs.append((x * n, base * run + REPEAT * (run - n)))
            if c not in _CODE:
                arcs.append(("", (DROP if c in LOOKS else MARK) * run))
            new: dict[tuple[int, int], tuple[float, str]] = {}
            for (a, b), (cost, text) in states.items():
                for x, extra in arcs:
                    p, q, total = a, b, cost + extra
                    for y in x:
                        r = _CODE[y]
                        total += self.cost[p][q][r]
                        p, q = q, r
                    old = new.get((p, q))
                    if old is None or (total, text + x) < old:
                        new[p, q] = total, text + x
            states = new
            i = j
        return min((cost + self.cost[a][b][0], text) for (a, b), (cost, text) in states.items())[1]


def _trimmed(token: str) -> str:
    return _MARKS.sub("", _EDGES.sub("", token))


def readings(token: str, model: CharModel) -> list[str]:
    """The token without punctuation at its ends, and if its lattice has more than one path, the best one; of single
    characters set apart, the words of the best path."""
    if " " in token:
        return model.decode(token).split()
    plain = _PLAIN.fullmatch(token)
    word = token if plain else _trimmed(token)
    if not word or word.isdigit():
        return []
    plain = plain or _PLAIN.fullmatch(word)
    if plain and not _RUN.search(word):
        return [word]
    if not any(c in _CODE or c in LOOKS for c in word):
        return [word]
    restored = (model.spelled(word) if plain else None) or model.decode(word)
    return [word, restored] if restored and restored != word else [word]


def named(word: str) -> list[str]:
    """Feature names of a restored word."""
    return ["=" + word, *("^" + word[:n] for n in BEGINNINGS if len(word) >= n)]


def tokens(text: str) -> set[str]:
    """Distinct tokens in lower case; single characters set apart, two of them letters, also as one, with spaces between."""
    low = text.lower()
    found = set(low.split())
    for m in _APART.finditer(low):
        singles = _SINGLES.findall(m[0])
        if len(singles) > 2 and sum(c in _CODE for c in singles) > 1:
            found.add(" ".join(singles))
    return found


def _trigrams(words: dict[str, int]) -> np.ndarray:
    """Counts of code triples over words, each as often as it occurs."""
    table = np.zeros(0x110000, np.int64)
    table[[ord(c) for c in LETTERS]] = np.arange(1, _N)
    joined = "\n\n" + "\n\n".join(words) + "\n\n"
    codes = table[np.frombuffer(joined.encode("utf-32-le", "replace"), np.uint32)]
    triples = (codes[:-2] * _N + codes[1:-1]) * _N + codes[2:]
    weights = np.repeat(np.array(list(words.values()), np.float64), [len(w) + 2 for w in words]) if words else np.zeros(0)
    out = np.bincount(triples, np.append(weights, [0, 0])[: len(triples)], minlength=_N**3)
    out.reshape(_N, _N, _N)[:, 0, 0] = 0  # what lies between words
    return out


def char_model(docs: DataFrame) -> CharModel:
    """Counts letters' triples in the words of docs' text; _N cubed numbers at most."""
    import pyarrow as pa

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[str] = Counter()
        counts = np.zeros(_N**3)

        def flush() -> None:
            nonlocal counts
            words: Counter[str] = Counter()
            for w, n in seen.items():
                w = w if _PLAIN.fullmatch(w) else _trimmed(w)
                if _PLAIN.fullmatch(w):
                    words[w] += n
            counts += _trigrams(words)
            seen.clear()

        for b in batches:
            for text in b.column("text"):
                seen.update((text.as_py() or "").lower().split())
                if len(seen) > KEPT:
                    flush()
        flush()
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at])], ["i", "n"])

    rows = docs.select("text").mapInArrow(run, "i long, n double").groupBy("i").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(_N**3)
    counts[rows["i"]] = rows["n"]
    return CharModel(counts)


def _featured(sample: DataFrame, sent) -> DataFrame:
    """name, n1, n0: documents of either label that have the feature."""
    import pyarrow as pa

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        n: dict[int, Counter[str]] = {0: Counter(), 1: Counter()}
        for b in batches:
            for text, label in zip(b.column("text"), b.column("label").to_pylist()):
                n[label].update({f for t in tokens(text.as_py() or "") for w in readings(t, model) for f in named(w)})
        names = list(n[0] | n[1])
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([n[1][x] for x in names], pa.int64()), pa.array([n[0][x] for x in names], pa.int64())], ["name", "n1", "n0"])

    return sample.mapInArrow(run, "name string, n1 long, n0 long").groupBy("name").agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0"))


class Scorer:
    """Names of features, weights, bias, character model; and a worker's table of words."""

    def __init__(self, names: list[str], weights: np.ndarray, bias: float, model: CharModel) -> None:
        self.place = {n: i for i, n in enumerate(names)}
        self.weights, self.bias, self.model = weights, bias, model
        # a word has a feature only if it begins as some feature does
        self.fronts = {n[1 : 1 + BEGINNINGS[0]] for n in names}
        self.kept: dict[str, tuple[int, ...]] = {}
        self.blank: set[str] = set()

    def hits(self, text: str) -> set[int]:
        out: set[int] = set()
        for t in tokens(text) - self.blank:
            found = self.kept.get(t)
            if found is None:
                found = tuple(self.place[f] for w in readings(t, self.model) if w[: BEGINNINGS[0]] in self.fronts for f in named(w) if f in self.place)
                if len(self.kept) + len(self.blank) >= KEPT:
                    self.kept.clear()
                    self.blank.clear()
                if found:
                    self.kept[t] = found
                else:
                    self.blank.add(t)
            out.update(found)
        return out

    def score(self, text: str) -> float:
        x = self.bias + float(self.weights[list(self.hits(text))].sum())
        return float(1 / (1 + np.exp(-max(-30.0, min(30.0, x)))))


def _regress(rows: list[list[int]], labels: np.ndarray, times: np.ndarray, n: int, rounds: int = 1500, ridge: float = 0.01) -> tuple[np.ndarray, float]:
    """Logistic regression over lists of present features, each counted `times`: gradient steps with momentum."""
    doc = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    at = np.array([i for r in rows for i in r], np.int64)
    share = ((labels * times).sum() + 0.5) / (times.sum() + 1)
    w, b = np.zeros(n), float(np.log(share / (1 - share)))
    scale = 1 / np.sqrt(np.bincount(at, times[doc], n) + 1.0)
    v, vb = np.zeros(n), 0.0
    for _ in range(rounds if n else 0):
        p = 1 / (1 + np.exp(-np.clip(b + np.bincount(doc, w[at], len(rows)), -30, 30)))
        e = (labels - p) * times
        v = 0.9 * v + scale * (np.bincount(at, e[doc], n) - ridge * w)
        vb = 0.9 * vb + e.sum() / times.sum()
        w, b = w + 0.2 * v, b + 0.5 * vb
    return w, b


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Scorer:
    import pyarrow as pa

    spark = docs.sparkSession
    one = labels.select(F.col(id_col).cast("string").alias("_id"), F.col(label_col).cast("int").alias("label")).dropna().groupBy("_id").agg(F.max("label").alias("label"))
    one = stored(one.where(~held_out(F.col("_id"))).orderBy(F.xxhash64("_id"), "_id").limit(LABELLED), "toxic-labels")
    rows = docs.select(F.col(id_col).cast("string").alias("_id"), F.col(text_col).cast("string").alias("text"))
    model = char_model(rows)
    sample = stored(rows.join(F.broadcast(one), "_id").select("text", "label"), "toxic-sample")
    sent = spark.sparkContext.broadcast(model)
    sizes = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    all1, all0 = sizes.get(1, 0), sizes.get(0, 0)
    n1, n0 = F.col("n1").cast("double"), F.col("n0").cast("double")
    d = n1 * (all0 - n0) - n0 * (all1 - n1)
    chi = (all1 + all0) * d * d / (F.lit(float(all1 or 1)) * float(all0 or 1) * (n1 + n0) * F.greatest(all1 + all0 - n1 - n0, F.lit(1.0)))
    best = _featured(sample, sent).withColumn("chi", chi).where(F.col("chi") > CHI).orderBy(F.col("chi").desc(), "name").limit(FEATURES)
    rows = best.collect()
    names = [r["name"] for r in rows]
    scorer = Scorer(names, np.zeros(len(names)), 0.0, model)
    sent = spark.sparkContext.broadcast(scorer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("label"), pa.array([sorted(own.hits(t.as_py() or "")) for t in b.column("text")], pa.list_(pa.int32()))], ["label", "hits"])

    found = sample.mapInArrow(run, "label int, hits array<int>").orderBy("label", "hits").collect()  # of the bounded sample
    # toxic words come together, so a word alone would get a part of the credit: each feature that all but goes with
    # label 1 is also seen alone, as a tenth of the documents that have it
    seen = [r["n1"] + r["n0"] for r in rows]
    alone = [r["n1"] / n for r, n in zip(rows, seen)]
    labels_of = np.array([*(r["label"] for r in found), *alone], np.float64)
    times = np.array([*([1.0] * len(found)), *(0.1 * n if x >= 0.95 else 0.0 for n, x in zip(seen, alone))])
    scorer.weights, scorer.bias = _regress([*(r["hits"] for r in found), *([i] for i in range(len(names)))], labels_of, times, len(names))
    return scorer


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """doc_id, held_out, score (0 to 1), predicted (1 if score >= 0.5)."""
    import pyarrow as pa

    scorer = fit(docs, labels, id_col, text_col, label_col)
    sent = docs.sparkSession.sparkContext.broadcast(scorer)
    df = docs.select(F.col(id_col).alias("doc_id"), held_out(F.col(id_col)).alias("held_out"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("held_out"), pa.array([own.score(t.as_py() or "") for t in b.column("text")], pa.float64())], ["doc_id", "held_out", "score"])

    scored = df.mapInArrow(run, f"doc_id {df.schema['doc_id'].dataType.simpleString()}, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
