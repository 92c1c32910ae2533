"""Quality classifier by importance resampling.

Two generative models of hashed words and word pairs are counted: one of the raw text (all documents), one of the
target (labelled documents of quality 1). A document's log importance weight is the sum over its features of the log
of target over raw probability. Features of one text lean on each other, so weights are tempered: a text counts as
`TEMPERED` features at most, and the sum of a longer one is scaled to those. Gumbel noise is added to it and the k largest are
the sample (Gumbel top-k: k draws without repetition in proportion to the weights). k is asked for as a share of the rows;
without one, it is the number of documents whose weight passes the point that best separates the labelled documents of
quality 1 and 0, each weighed without its own counts.

The raw model covers all documents; the target model and the separating point use a bounded sample of labelled
documents, `LABELLED` at most, the smallest by a hash of their id, which is broadcast under that bound. Counts
are `BUCKETS` numbers a model, whatever the input. The k-th largest is found by narrowing counts of 4096
intervals, so nothing is sorted or collected but these counts.

Defined results
- null text: as empty; no features, so log weight 0. Null id: never labelled.
- several labels of an id: the lowest quality counts; of several rows of a labelled id, the lowest weight does. Null labels are left out.
- noise depends on seed, id and text alone, so reruns agree; repeated rows get the same verdict. Ties at the k-th
  largest are all kept. Without labels of both kinds all is kept, unless a share is asked for. Empty table: empty result.
- `keep` returns docs' own columns whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.durable import stored
from rivulet.llm.common import released, uniform, whole_text
from rivulet.llm.probminhash import _mix, _words, kept_words

BUCKETS = 1 << 14
#: Share of the raw model mixed into the target's, so that features rare in the sample say little.
MIXED = 0.25
#: Labelled documents used at most.
LABELLED = 20_000
#: Features that a text counts as at most: the larger, the less the draw matters beside the weights.
TEMPERED = 96
#: What losing all documents of quality 1 costs against keeping all of quality 0.
LOSS = 10
_PAIR = np.uint64(0x9E3779B97F4A7C15)


def features(text: bytes | None) -> np.ndarray:
    """Buckets of the words (lower-case ASCII) and of the pairs of neighbours."""
    words = (text or b"").lower().split()
    h = np.fromiter(map(_words.__getitem__, words), np.uint64, len(words))
    with np.errstate(over="ignore"):
        both = np.concatenate([_mix(h), _mix(h[:-1] * _PAIR + h[1:])])
    return (both % np.uint64(BUCKETS)).astype(np.int64)


def _counted(docs: DataFrame) -> DataFrame:
    """bucket, raw, target: counts over text (binary) and quality."""
    import pyarrow as pa

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, target = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
        for b in batches:
            for text, quality in zip(b.column("text"), b.column("quality").to_pylist()):
                n = np.bincount(features(text.as_py()), minlength=BUCKETS) if len(text.as_py() or b"") > 20_000 else None
                if n is None:
                    f = features(text.as_py())
                    np.add.at(raw, f, 1)
                    if quality == 1:
                        np.add.at(target, f, 1)
                else:
                    raw += n
                    if quality == 1:
                        target += n
        at = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(raw[at]), pa.array(target[at])], ["bucket", "raw", "target"])

    return docs.mapInArrow(released(run, kept_words), "bucket long, raw long, target long").groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))


def _sample(labels: DataFrame, id_col: str, quality_col: str) -> DataFrame:
    one = labels.select(F.col(id_col).cast("string").alias("_id"), F.col(quality_col).cast("int").alias("quality")).dropna().groupBy("_id").agg(F.min("quality").alias("quality"))
    return one.orderBy(F.xxhash64("_id"), "_id").limit(LABELLED)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", quality_col: str = "quality") -> tuple[tuple[np.ndarray, np.ndarray], DataFrame]:
    """Counts per bucket in the target and shares in the raw text, and the sample of labels (_id, quality)."""
    sample = stored(_sample(labels, id_col, quality_col), "quality-labels")
    df = docs.select(F.col(id_col).cast("string").alias("_id"), F.col(text_col).cast("string").cast("binary").alias("text")).join(F.broadcast(sample), "_id", "left")
    counts = _counted(df.select("text", "quality")).toPandas()  # BUCKETS rows at most
    raw, target = np.zeros(BUCKETS), np.zeros(BUCKETS)
    raw[counts["bucket"]], target[counts["bucket"]] = counts["raw"], counts["target"]
    return (target, (raw + 1e-9) / (raw + 1e-9).sum()), sample


def log_ratio(target: np.ndarray, total: float, share: np.ndarray) -> np.ndarray:
    """Log of target over raw probability of buckets."""
    return np.log((1 - MIXED) * target / total + MIXED * share) - np.log(share) if total > 0 else np.zeros(len(share))


def tempered(total: float, n: int) -> float:
    """The log weight of a text of n features, whose log ratios add up to total."""
    return float(total) * min(1.0, TEMPERED / max(n, 1))


def weighed(rows: DataFrame, model: tuple[np.ndarray, np.ndarray], held: bool = False) -> DataFrame:
    """rows (with text as binary) and log_weight; the text goes. held: rows have a quality, and held_weight is added,
    the weight by a target model without the document's own counts."""
    import pyarrow as pa

    sent = rows.sparkSession.sparkContext.broadcast(model)
    rest = [f for f in rows.schema.fields if f.name != "text"]
    names = [*(f.name for f in rest), "log_weight", *(["held_weight"] if held else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target, share = sent.value
        total = target.sum()
        w = log_ratio(target, total, share)
        for b in batches:
            found, without = [], []
            quality = b.column("quality").to_pylist() if held else []
            for i, t in enumerate(b.column("text")):
                f = features(t.as_py())
                found.append(tempered(w[f].sum(), len(f)))
                if held and quality[i] == 1:
                    at, n = np.unique(f, return_counts=True)
                    without.append(tempered((n * log_ratio(target[at] - n, total - len(f), share[at])).sum(), len(f)))
                elif held:
                    without.append(found[-1])
            extra = [pa.array(found, pa.float64()), *([pa.array(without, pa.float64())] if held else [])]
            yield pa.RecordBatch.from_arrays([*(b.column(f.name) for f in rest), *extra], names)

    schema = type(rows.schema)(list(rest)).add("log_weight", "double")
    return rows.mapInArrow(released(run, kept_words), schema.add("held_weight", "double") if held else schema)


def separating(rows: list[tuple[float, int]]) -> float | None:
    """The log weight that best separates quality 1 (above) from 0: the least balanced error, in the middle of
    the widest gap among equals. None unless both kinds are there."""
    x = np.array([r[0] for r in rows])
    y = np.array([r[1] for r in rows])
    if not (y == 1).any() or not (y == 0).any():
        return None
    order = np.argsort(x, kind="stable")
    x, y = x[order], y[order]
    lost, let = np.concatenate([[0], np.cumsum(y == 1)]) / (y == 1).sum(), 1 - np.concatenate([[0], np.cumsum(y == 0)]) / (y == 0).sum()
    cost = LOSS * lost + let
    edges = np.concatenate([[x[0] - 1], (x[1:] + x[:-1]) / 2, [x[-1] + 1]])
    gap = np.concatenate([[0], x[1:] - x[:-1], [0]])
    best = np.flatnonzero(cost <= cost.min() + 1e-12)
    return float(edges[best[np.argmax(gap[best])]])


def kth_largest(df: DataFrame, key: str, k: int) -> float:
    """The k-th largest of a column without nulls, exactly: counts of 4096 intervals, narrowed until few values are left."""
    low, high = df.agg(F.min(key), F.max(key)).first()
    while True:
        step = (high - low) / 4096
        inside = df.where(F.col(key).between(low, high))
        if step <= 0 or low + step == low:
            return low
        at = F.least(F.floor((F.col(key) - low) / step), F.lit(4095)).cast("int")
        counts = inside.groupBy(at.alias("at")).agg(F.count("*").alias("n"), F.min(key).alias("lo"), F.max(key).alias("hi")).collect()
        for r in sorted(counts, key=lambda r: -r["at"]):
            if k <= r["n"]:
                break
            k -= r["n"]
        low, high = r["lo"], r["hi"]
        if k == r["n"] or low == high:
            return low
        if k == 1:
            return high


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", quality_col: str = "quality", seed: int = 6, share: float | None = None) -> DataFrame:
    """doc_id, log_weight, key (log weight with Gumbel noise), kept. share: of the rows to keep; None: as the labels say."""
    scores, cut, _ = _scored(docs, labels, id_col, text_col, quality_col, seed, share)
    return scores.select("doc_id", "log_weight", "key", (F.col("key") >= cut).alias("kept"))


def _scored(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, quality_col: str, seed: int, share: float | None = None) -> tuple[DataFrame, float, tuple]:
    model, sample = fit(docs, labels, id_col, text_col, quality_col)
    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).alias("doc_id"), uniform(seed, F.col(id_col).cast("string"), whole_text(text)).alias("u"), text.cast("binary").alias("text"))
    rows = rows.join(F.broadcast(sample), rows["doc_id"].cast("string") == sample["_id"], "left").drop("_id")
    scores = stored(weighed(rows, model, held=True).withColumn("key", noisy("log_weight", "u")), "quality-scores")
    if share is not None:
        k = round(share * scores.count())
        return scores, kth_largest(scores, "key", k) if k else float("inf"), model
    # one row a labelled id, so LABELLED at most; of several rows of an id the smallest weight
    known = scores.where("quality is not null").groupBy(F.col("doc_id").cast("string")).agg(F.min("held_weight").alias("w"), F.min("quality").alias("q")).select("w", "q").collect()
    point = separating([(r[0], r[1]) for r in known])
    k = scores.where(F.col("log_weight") >= point).count() if point is not None else 0
    return scores, (kth_largest(scores, "key", k) if k else float("-inf") if point is None else float("inf")), model


def noisy(weight: str, u: str):
    """A column plus standard Gumbel noise made of a uniform one."""
    return F.col(weight) - F.log(-F.log(F.col(u)))


def keep(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", quality_col: str = "quality", seed: int = 6, share: float | None = None) -> DataFrame:
    """docs without the documents that the classifier rejects. Weights are found again beside each row, so no text is shuffled."""
    _, cut, model = _scored(docs, labels, id_col, text_col, quality_col, seed, share)
    text = F.col(f"row.`{text_col}`").cast("string")
    rows = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("row"))
    rows = rows.select("row", uniform(seed, F.col(f"row.`{id_col}`").cast("string"), whole_text(text)).alias("u"), text.cast("binary").alias("text"))
    return weighed(rows, model).where(noisy("log_weight", "u") >= cut).select("row.*")
