"""Language-model scoring with a log-bilinear model trained by noise-contrastive estimation.

Tokens are words in lower-case ASCII, then one end. All training documents are counted in Spark (word, count). Every
word has a class, known or not: the `VOCABULARY` most frequent words are classes of their own, as is the end, and the
others are dealt to `GROUPS` classes by their last two letters, so that endings have vectors and a word never
seen has its group's. A class is predicted from the two before it (before the text: the end) by

    s(w | u, v) = (a * R[u] + c * R[v]) . Q[w] + b[w]

with word vectors R and Q, position weights a and c, and biases b. Each partition of the training documents passes
over its own class triples, all of them, from the same start, by noise-contrastive estimation in numpy (noise:
class frequencies, shared within a batch); the parameters are averaged by tokens (one row per parameter and
partition). A model this size is normalised exactly and at once: exp of the two position products A = (a R) Q' and
C = (c R) Q' are matrices, and their product over the classes gives every context's normaliser. A word of a group
gets the group's probability times its smoothed frequency within the group, so probabilities add up over words.
All words are counted, whatever their number; the classes are a fixed number, so that the broadcast is bounded.

The average depends on how the table is dealt over partitions (its model is the mean of theirs), as sums of doubles do;
the same partitions give the same scores. Counts and base_score don't depend on it.

Counts, of which there are as many as words, stay in Spark. The `HEAD` most frequent at most are broadcast, under
that bound; a document's other words are joined with the counts by word, counted within the document first.

Defined results
- null text: as empty (one token, the end). Null id: as the empty id, so held out (crc32 is 0).
- repeated rows and equal ids: each row is scored alone. Empty table: empty result; without training documents
  probabilities are those of no counts.
- a text of any length is scored whole. Only the id and the text are read, so other columns can't clash.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.durable import stored

#: Classes with a word of their own; classes of the other words; words whose counts are broadcast at most; size of a vector.
VOCABULARY, GROUPS, HEAD, WIDTH = 1022, 512, 150_000, 16
#: Noise classes a batch shares, noise tokens per token, triples in a batch, learning rate, distinct words counted at once.
SHARED, NOISE, BATCH, RATE, COUNTED = 64, 10, 4096, 0.15, 250_000
#: Triples a partition learns from at once; groups of words a task keeps.
AT_ONCE, KEPT = 3_000_000, 200_000
#: Classes: the end, the groups, the words.
END, FIRST_WORD = 0, 1 + GROUPS
ALPHA = 0.1


def held_out(id_column: Column) -> Column:
    return F.crc32(F.coalesce(id_column.cast("string"), F.lit("")).cast("binary")) % 10 == 0


def _tokens(text: bytes | None) -> list[bytes]:
    return (text or b"").lower().split()


_NO_LETTER = re.compile(rb"^[^a-z\x80-\xff]+|[^a-z\x80-\xff]+$")


def group(word: bytes) -> int:
    """The class of a word that has none of its own, by its last two bytes between marks and digits at its ends."""
    return 1 + zlib.crc32(_NO_LETTER.sub(b"", word)[-2:]) % GROUPS


class Classes(dict):
    """Classes of words: the known ones for good, groups of others while they fit."""

    def __init__(self, known: dict[bytes, int]) -> None:
        super().__init__(known)
        self.known, self.most = known, len(known) + KEPT

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
            self.update(self.known)
        found = self[word] = group(word)
        return found


def count_words(docs: DataFrame) -> DataFrame:
    """word (binary), c of docs' text (binary); the empty word stands for the end of a text."""
    import pyarrow as pa

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[bytes] = Counter()

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(found.keys(), pa.binary()), pa.array(found.values(), pa.int64())], ["word", "c"])
            found.clear()
            return out

        for b in batches:
            for text in b.column("text"):
                found.update(_tokens(text.as_py()))
                found[b""] += 1
                if len(found) > COUNTED:
                    yield flush()
        yield flush()

    return docs.select("text").mapInArrow(run, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


def grouped(counts: DataFrame, own: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Occurrences and number of the words of each group; GROUPS rows, whatever the input."""
    import pyarrow as pa

    known = frozenset(own)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, v = np.zeros(FIRST_WORD, np.int64), np.zeros(FIRST_WORD, np.int64)
        for b in batches:
            words, times = b.column("word").to_pylist(), b.column("c").to_numpy()
            at = np.fromiter((END if not w or w in known else group(w) for w in words), np.int64, len(words))
            np.add.at(n, at, times)
            np.add.at(v, at, 1)
        some = np.flatnonzero(v[1:]) + 1
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(n[some]), pa.array(v[some])], ["i", "n", "v"])

    rows = counts.select("word", "c").mapInArrow(run, "i long, n long, v long").groupBy("i").agg(F.sum("n").alias("n"), F.sum("v").alias("v")).toPandas()
    n, v = np.zeros(FIRST_WORD), np.zeros(FIRST_WORD)
    n[rows["i"]], v[rows["i"]] = rows["n"], rows["v"]
    return n[1:], v[1:]


def head_of(counts: DataFrame, most: int) -> list[tuple[bytes, int]]:
    """The most frequent words, at most so many, by falling count: a histogram of an eighth of a power of two finds the
    lowest count that fits."""
    step = F.floor(F.log2(F.col("c")) * 8)
    steps = counts.groupBy(step.alias("step")).agg(F.count("*").alias("n"), F.min("c").alias("c")).collect()
    low, room = None, most
    for r in sorted(steps, key=lambda r: -r["step"]):
        if r["n"] > room:
            break
        low, room = r["c"], room - r["n"]
    rows = counts.where(F.col("c") >= low).collect() if low is not None else []
    if low is None and steps:  # one step alone is too large
        rows = counts.orderBy(F.col("c").desc(), "word").limit(most).collect()
    return sorted(((bytes(r["word"]), r["c"]) for r in rows), key=lambda x: (-x[1], x[0]))


def _sums(at: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """Row i: the sum of the rows whose place is i."""
    width = rows.shape[1]
    return np.bincount((at[:, None] * width + np.arange(width)).ravel(), rows.ravel(), n * width).reshape(n, width)


class Model:
    """Parameters; trained on class triples; then tables."""

    def __init__(self, frequency: np.ndarray, seed: int = 7) -> None:
        rng = np.random.default_rng(seed)
        self.noise = (frequency + 1) / (frequency + 1).sum()
        n = len(frequency)
        self.r = rng.normal(0, 0.3, (n, WIDTH))
        self.q = rng.normal(0, 0.3, (n, WIDTH))
        self.a, self.c = np.full(WIDTH, 0.3), np.full(WIDTH, 0.7)
        self.b = np.log(self.noise)

    def flat(self) -> np.ndarray:
        return np.concatenate([self.r.ravel(), self.q.ravel(), self.a, self.c, self.b])

    def load(self, flat: np.ndarray) -> Model:
        n = len(self.b)
        at = np.cumsum([n * WIDTH, n * WIDTH, WIDTH, WIDTH])
        r, q, self.a, self.c, self.b = np.split(flat, at)
        self.r, self.q = r.reshape(n, WIDTH), q.reshape(n, WIDTH)
        return self

    def train(self, u: np.ndarray, v: np.ndarray, w: np.ndarray, times: np.ndarray, seed: int = 11) -> None:
        """One pass over distinct triples that occur `times` each; Adagrad."""
        rng = np.random.default_rng(seed)
        n = len(self.b)
        sums = [np.full(x.shape, 1e-2) for x in (self.r, self.q, self.a, self.c, self.b)]
        log_noise = np.log(NOISE * self.noise)
        order = rng.permutation(len(w))
        for k in range(0, len(w), BATCH):
            at = order[k : k + BATCH]
            uu, vv, ww, m = u[at], v[at], w[at], times[at].astype(np.float64)
            m /= m.mean()
            x = rng.choice(n, SHARED, p=self.noise)
            ru, rv = self.r[uu], self.r[vv]
            h = self.a * ru + self.c * rv
            good = 1 / (1 + np.exp(np.clip((h * self.q[ww]).sum(1) + self.b[ww] - log_noise[ww], -30, 30)))
            bad = h.astype(np.float32) @ -self.q[x].T.astype(np.float32)  # the large product, and what follows, in place
            bad += (log_noise[x] - self.b[x]).astype(np.float32)
            np.exp(np.clip(bad, -30, 30, out=bad), out=bad)
            bad += 1
            np.divide((m * (NOISE / SHARED)).astype(np.float32)[:, None], bad, out=bad)
            good *= m
            dh = good[:, None] * self.q[ww] - bad @ self.q[x].astype(np.float32)
            dq = _sums(ww, good[:, None] * h, n) - _sums(x, bad.T @ h.astype(np.float32), n)
            db = np.bincount(ww, good, n) - np.bincount(x, bad.sum(0), n)
            dr = _sums(uu, dh * self.a, n) + _sums(vv, dh * self.c, n)
            for p, g, s in zip((self.r, self.q, self.a, self.c, self.b), (dr, dq, (dh * ru).sum(0), (dh * rv).sum(0), db), sums):
                g /= len(at) ** 0.5
                s += g * g
                p += RATE * g / np.sqrt(s)

    def tables(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """A[u, w] and C[v, w] with the bias, and the log normaliser Z[u, v]; natural logs."""
        a = (self.a * self.r) @ self.q.T
        c = (self.c * self.r) @ self.q.T + self.b
        ma, mc = a.max(1), c.max(1)
        z = np.log(np.exp(a - ma[:, None]) @ np.exp(c - mc[:, None]).T) + ma[:, None] + mc[None, :]
        return a.astype(np.float32), c.astype(np.float32), z.astype(np.float32)


def _triples(classes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Contexts and tokens of one text's classes, which end in END."""
    padded = np.concatenate([[END, END], classes])
    return padded[:-2], padded[1:-1], padded[2:]


def train(docs: DataFrame, vocabulary: dict[bytes, int], frequency: np.ndarray) -> Model:
    """The average of the models that partitions of docs' text (binary) come to, by tokens."""
    import pyarrow as pa

    model, n = Model(frequency), len(frequency)
    sent = docs.sparkSession.sparkContext.broadcast((vocabulary, frequency))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, freq = sent.value
        class_of = Classes(known)
        held: list[np.ndarray] = []
        size = tokens = 0
        own = Model(freq)
        passed = 0

        def learn() -> None:
            nonlocal size, passed
            if held:
                codes, times = np.unique(np.concatenate(held), return_counts=True)
                own.train(codes // (n * n), codes // n % n, codes % n, times, seed=11 + passed)
                passed += 1
            held.clear()
            size = 0

        for b in batches:
            for text in b.column("text"):
                words = _tokens(text.as_py())
                ids = np.fromiter(map(class_of.__getitem__, words), np.int64, len(words))
                u, v, w = _triples(np.append(ids, END))
                held.append((u * n + v) * n + w)
                size += len(w)
                tokens += len(w)
                if size > AT_ONCE:
                    learn()
        learn()
        if tokens:
            flat = own.flat() * tokens
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat) + 1)), pa.array(np.append(flat, tokens))], ["i", "x"])

    rows = docs.select("text").mapInArrow(run, "i long, x double").groupBy("i").agg(F.sum("x").alias("x")).toPandas()  # one row per parameter
    if not len(rows):
        return model
    flat = np.zeros(len(rows))
    flat[rows["i"]] = rows["x"]
    return model.load(flat[:-1] / flat[-1])


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10)."""
    import pyarrow as pa

    spark = docs.sparkSession
    df = docs.select(F.col(id_col).alias("doc_id"), held_out(F.col(id_col)).alias("held_out"), F.col(text_col).cast("string").cast("binary").alias("text"))
    learnt = df.where(~F.col("held_out"))
    counts = stored(count_words(learnt), "lm-counts")
    all_tokens, distinct = counts.agg(F.sum("c"), F.count("*")).first()
    all_tokens = all_tokens or 0
    head = head_of(counts.where(F.length("word") > 0), HEAD)
    ends = counts.where(F.length("word") == 0).agg(F.sum("c")).first()[0] or 0

    own = head[:VOCABULARY]
    known = {w: FIRST_WORD + i for i, (w, _) in enumerate(own)}
    in_groups, of_groups = grouped(counts, list(known))
    frequency = np.concatenate([[ends], in_groups, [c for _, c in own]]).astype(np.float64)
    model = train(learnt, known, frequency)
    log_base = float(np.log10(all_tokens + ALPHA * (distinct + 1)))
    log_group = np.append(0.0, np.log10(in_groups + ALPHA * (of_groups + 1)))
    place = {w: i for i, (w, _) in enumerate(head)}
    logs = np.log10(np.array([c for _, c in head], np.float64) + ALPHA)
    class_of_head = np.array([*known.values(), *(group(w) for w, _ in head[len(own) :])], np.int64)
    sent = spark.sparkContext.broadcast((place, class_of_head, logs, log_group, *model.tables()))
    end_log = float(np.log10(ends + ALPHA))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, class_of_head, logs, log_group, a, c, z = sent.value
        class_of = Classes({})
        part, at = TaskContext.get().partitionId() << 33, 0
        for b in batches:
            rows, words_out, n_out = [], [], []
            for text in b.column("text"):
                words = _tokens(text.as_py())
                p = np.fromiter((place.get(w, -1) for w in words), np.int64, len(words))
                seen = p >= 0
                unseen = np.flatnonzero(~seen)
                classes = np.full(len(words) + 1, END)
                classes[:-1][seen] = class_of_head[p[seen]]
                classes[unseen] = [class_of[words[i]] for i in unseen]
                u, v, w = _triples(classes)
                log_p = float((a[u, w].astype(np.float64) + c[v, w] - z[u, v]).sum()) / np.log(10)
                base = float(logs[p[seen]].sum()) + end_log - log_base * (len(words) + 1)
                some = classes[:-1] < FIRST_WORD
                inner = float(logs[p[seen & some]].sum()) - float(log_group[classes[:-1][some]].sum())
                other = Counter([words[i] for i in unseen])
                rows.append((part + at, len(words) + 1, int(seen.sum()) + (1 if ends else 0), base, log_p + inner))
                words_out.append(list(other))
                n_out.append(list(other.values()))
                at += 1
            cols = list(zip(*rows)) if rows else [(), (), (), (), ()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.int64()), b.column("doc_id"), b.column("held_out"), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.float64()), pa.array(cols[4], pa.float64()), pa.array(words_out, pa.list_(pa.binary())), pa.array(n_out, pa.list_(pa.int64()))],
                ["row", "doc_id", "held_out", "n_tokens", "known", "base", "model", "words", "times"],
            )

    schema = f"row long, doc_id {df.schema['doc_id'].dataType.simpleString()}, held_out boolean, n_tokens long, known long, base double, model double, words array<binary>, times array<long>"
    rows = stored(df.mapInArrow(run, schema), "lm-rows")  # a row's number is of one run of its task, so it is kept
    tail = rows.select("row", F.explode(F.arrays_zip("words", "times")).alias("x")).select("row", F.col("x.words").alias("word"), F.col("x.times").alias("n"))
    tail = tail.join(counts, "word", "left").select("row", "n", F.coalesce("c", F.lit(0)).alias("c"))
    sums = tail.groupBy("row").agg(F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("more"), F.sum(F.col("n") * F.log10(F.col("c") + ALPHA)).alias("logs"))
    out = rows.drop("words", "times").join(sums, "row", "left")
    logs_of = F.coalesce("logs", F.lit(0.0))
    return out.select(
        "doc_id", "held_out", "n_tokens",
        (F.col("known") + F.coalesce("more", F.lit(0))).alias("n_known"),
        F.lit(int(all_tokens)).cast("long").alias("train_tokens"),
        (F.col("base") + logs_of).alias("base_score"),
        (F.col("model") + logs_of).alias("score"),
    )
