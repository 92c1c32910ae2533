"""Near-duplicates by ProbMinHash, banding and verification.

A document is the weighted set of its five-word shingles (words in lower-case ASCII; weight: occurrences; a text of
one to four words is one shingle). Each shingle is a Poisson process seeded by its hash, its rate the
weight; arrivals fall into registers at random, and a register keeps its first arrival's shingle. A process
stops once its next arrival lies beyond the last register's first one (early termination). Two documents agree in
a register with the probability that is their probability Jaccard similarity,

    J_P = sum over common d of 1 / sum over d' of max(w(d') / w(d), v(d') / v(d)),

plain Jaccard where no shingle repeats. Registers are banded; candidates are verified by the exact J_P.

Equal texts are one node (by MD5 of the text) before anything is paired, so copies are never expanded. Within a
bucket candidates aren't all paired either. A node's popularity is the number of nodes in its buckets; the most popular
node of a bucket, its centre, is compared with the others, and linked ones become components. Nodes of buckets that still
hold several components are then compared by their rarest shingles: J_P is at most the common part of two normalised
sets, so two sets at SIMILARITY share a shingle before either has passed 1 - SIMILARITY of its weight, in any order
that is the same for all; in sets without repeats, of n and m shingles, before it has passed n (or m) less the least
common number, 4 (n + m) / 9. The order puts shingles first that are rare by a count of `COUNTERS` hash classes. So
no link between such nodes is lost, and those that are alike but for the threshold are hardly ever paired.
Components come from alternating large and small stars.
Everything but the compared pairs' shingles is rows of keys and hashes; nothing is collected.

A node's key is its smallest id and the MD5, in bytes that sort that way, so the smallest key of a component names its class
and the row to keep, without a further join. Hot keys (a bucket, a star's centre, a token): what is known of a key is
grouped apart from the join that uses it, so both sides are dealt anew and adaptive execution splits what is
skewed; a token's pairs are dealt by salts, as many as its nodes need.

Defined results
- null text: as empty. A text without words has no shingles: its only duplicates are rows of exactly the same text.
- null id: the row is in its text's class. A class's id is its smallest id; null if it has none.
- rows of equal id and different text are different documents; repeated rows are in one class.
- `keep_one` keeps one row per class: smallest id (null last), then smallest MD5, then of rows that differ in other columns
  the first by their JSON; all its columns stay. Empty table: empty result.
- `classes` reads the id and the text alone, so other columns can't clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.durable import discard, stored
from rivulet.llm.common import released, whole_text

SHINGLE, SIMILARITY = 5, 0.8
#: A pair at similarity 0.8 shares no band once in 50,000; one at 0.3 (a common passage) shares one once in 40.
BANDS, ROWS = 36, 6
REGISTERS = BANDS * ROWS
#: Hash classes whose counts order shingles.
COUNTERS = 1 << 18
#: Shingles handled at once by a task, words whose hash it keeps; nodes of a token that a salt has.
AT_ONCE, KEPT, SALTED = 300_000, 200_000, 256

_U = np.uint64
_GOLDEN = _U(0x9E3779B97F4A7C15)


def _mix(z: np.ndarray) -> np.ndarray:
    """The finaliser of SplitMix64."""
    z = (z ^ (z >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> _U(27))) * _U(0x94D049BB133111EB)
    return z ^ (z >> _U(31))


class WordHash(dict):
    """64-bit hashes of words, kept while they fit."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= KEPT:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


_words = WordHash()


def kept_words() -> WordHash:
    """The worker's own table."""
    return _words


def shingles(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes of the text's shingles, and how often each occurs."""
    words = text.encode("utf-8", "replace").lower().split()
    n = len(words)
    if not n:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    h = np.fromiter(map(_words.__getitem__, words), np.uint64, n)
    k = min(SHINGLE, n)
    s = h[: n - k + 1].copy()
    for i in range(1, k):
        s = s * _U(0x100000001B3) + h[i : n - k + 1 + i]
    return np.unique(_mix(s + _U(k)), return_counts=True)


def signatures(sets: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """(documents x REGISTERS) hashes of the shingles that come first. No set is empty."""
    m, n = REGISTERS, len(sets)
    doc = np.repeat(np.arange(n), [len(s) for s, _ in sets])
    s = np.concatenate([s for s, _ in sets])
    w = np.concatenate([c for _, c in sets]).astype(np.float64)
    first, by = np.full(n * m, np.inf), np.zeros(n * m, np.uint64)
    last, t, k = np.full(n, np.inf), np.zeros(len(s)), 0
    with np.errstate(over="ignore"):
        while len(s):
            k += 1
            z = _mix(s + _GOLDEN * _U(k))
            t = t - np.log(((z >> _U(11)).astype(np.float64) + 0.5) / (1 << 53)) / w
            at = doc * m + ((_mix(z) >> _U(32)) % _U(m)).astype(np.int64)
            sooner = np.flatnonzero(t < first[at])
            sooner = sooner[np.lexsort((s[sooner], t[sooner]))[::-1]]  # the soonest is written last
            first[at[sooner]], by[at[sooner]] = t[sooner], s[sooner]
            if len(sooner):
                seen = np.unique(doc[sooner])
                last[seen] = first.reshape(n, m)[seen].max(1)
            on = t < last[doc]
            doc, s, w, t = doc[on], s[on], w[on], t[on]
    return by.reshape(n, m)


def bands(signed: np.ndarray) -> np.ndarray:
    """(documents x BANDS) keys, different for different bands."""
    with np.errstate(over="ignore"):
        rows = signed.reshape(len(signed), BANDS, ROWS)
        key = np.arange(1, BANDS + 1, dtype=np.uint64)[None, :] * _GOLDEN
        for r in range(ROWS):
            key = _mix(key + rows[:, :, r])
    return key.view(np.int64)


def similarity(a: np.ndarray, wa: np.ndarray | None, b: np.ndarray, wb: np.ndarray | None) -> float:
    """J_P of two sorted sets of hashes; weights None: all 1."""
    if not len(a) or not len(b):
        return 0.0
    _, ia, ib = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    if wa is None and wb is None:
        return len(ia) / (len(a) + len(b) - len(ia))
    wa = np.ones(len(a)) if wa is None else wa.astype(np.float64)
    wb = np.ones(len(b)) if wb is None else wb.astype(np.float64)
    x, y = wa[ia], wb[ib]
    only_a, only_b = wa.sum() - x.sum(), wb.sum() - y.sum()
    ratios, place = np.unique(x / y, return_inverse=True)
    mass = np.bincount(place, x)
    # with d's ratio r, the inner sum times w(d) is the sum of max(w, r v)
    order = np.argsort(x / y, kind="stable")
    x, y = x[order], y[order]
    below = np.searchsorted(x / y, ratios, side="right")
    head_y, tail_x = np.concatenate([[0], np.cumsum(y)])[below], x.sum() - np.concatenate([[0], np.cumsum(x)])[below]
    return float((mass / (ratios * head_y + tail_x + only_a + ratios * only_b)).sum())


def signed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, key (MD5 of the text), bands array<long> (empty: no shingles). Map only."""
    import pyarrow as pa

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[np.ndarray | None] = [None] * b.num_rows
            held: list[tuple[int, tuple]] = []
            size = 0

            def flush() -> None:
                if held:
                    for (i, _), row in zip(held, bands(signatures([x for _, x in held]))):
                        out[i] = row
                    held.clear()

            for i, text in enumerate(b.column("text")):
                with np.errstate(over="ignore"):
                    x = shingles(text.as_py())
                if len(x[0]):
                    held.append((i, x))
                    size += len(x[0])
                if size > AT_ONCE:
                    flush()
                    size = 0
            flush()
            ends = np.cumsum([0, *(0 if r is None else BANDS for r in out)])
            rows = [r for r in out if r is not None]
            flat = np.concatenate(rows) if rows else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("key"), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))], ["id", "key", "bands"])

    text = whole_text(F.col(text_col))
    df = docs.select(F.col(id_col).cast("long").alias("id"), F.unhex(F.md5(text)).alias("key"), text.alias("text"))
    return df.mapInArrow(released(run, kept_words), "id long, key binary, bands array<long>")


_LEAST = -(2**63)


def label(id_: Column, md5: Column) -> Column:
    """A node's key: 0 (1: no id), the id as 8 bytes that sort as it does, MD5."""
    flipped = F.coalesce(id_, F.lit(0).cast("long")).bitwiseXOR(F.lit(_LEAST).cast("long"))
    return F.concat(F.unhex(F.when(id_.isNull(), F.lit("01")).otherwise(F.lit("00"))), F.unhex(F.lpad(F.hex(flipped), 16, "0")), md5)


def id_of(key: Column) -> Column:
    """The id within a node's key."""
    flipped = F.conv(F.hex(F.substring(key, 2, 8)), 16, -10).cast("long")
    return F.when(F.substring(key, 1, 1) == F.unhex(F.lit("00")), flipped.bitwiseXOR(F.lit(_LEAST).cast("long")))


def md5_of(key: Column) -> Column:
    return F.substring(key, 10, 16)


def _facts(df: DataFrame, key: str, *aggregates: Column) -> DataFrame:
    """One row a key. Grouped by one column more than a join by key needs, so that the join deals both sides anew and its hot
    keys can be split."""
    return df.groupBy(key, F.xxhash64(key).alias("_h")).agg(*aggregates).drop("_h")


def _blobs(df: DataFrame) -> DataFrame:
    """key, s, w (binary) of key, text; w is empty where all weights are 1."""
    import pyarrow as pa

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s, w = [], []
            for text in b.column("text"):
                with np.errstate(over="ignore"):
                    x, n = shingles(text.as_py())
                s.append(x.tobytes())
                w.append(n.astype(np.int32).tobytes() if len(n) and n.max() > 1 else b"")
            yield pa.RecordBatch.from_arrays([b.column("key"), pa.array(s, pa.binary()), pa.array(w, pa.binary())], ["key", "s", "w"])

    return df.mapInArrow(released(run, kept_words), "key binary, s binary, w binary")


def _verified(pairs: DataFrame, blobs: DataFrame) -> DataFrame:
    """Of a, b the pairs whose similarity is reached."""
    import pyarrow as pa

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            c = {n: batch.column(n) for n in ("sa", "wa", "sb", "wb")}
            keep = []
            for i in range(batch.num_rows):
                sa, wa, sb, wb = (c[n][i].as_py() for n in ("sa", "wa", "sb", "wb"))
                x = similarity(np.frombuffer(sa, np.uint64), np.frombuffer(wa, np.int32) if wa else None, np.frombuffer(sb, np.uint64), np.frombuffer(wb, np.int32) if wb else None)
                keep.append(x >= SIMILARITY - 1e-12)
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    left = blobs.select(F.col("key").alias("a"), F.col("s").alias("sa"), F.col("w").alias("wa"))
    right = blobs.select(F.col("key").alias("b"), F.col("s").alias("sb"), F.col("w").alias("wb"))
    return pairs.join(left, "a").join(right, "b").mapInArrow(run, "a binary, b binary")


def _rarity(blobs: DataFrame) -> np.ndarray:
    """How many nodes have a shingle of each hash class; COUNTERS numbers, whatever the input."""
    import pyarrow as pa

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(COUNTERS, np.int64)
        for b in batches:
            for s in b.column("s"):
                np.add.at(n, (np.frombuffer(s.as_py(), np.uint64) % _U(COUNTERS)).astype(np.int64), 1)
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(n[at])], ["i", "n"])

    rows = blobs.select("s").mapInArrow(run, "i long, n long").groupBy("i").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(COUNTERS, np.int64)
    out[rows["i"]] = rows["n"]
    return out


def _rarest(nodes: DataFrame, rarity: np.ndarray) -> DataFrame:
    """token, key, root, n, i, heavy: the shingles of key, s, w, root that come before 1 - SIMILARITY of the weight."""
    import pyarrow as pa

    sent = nodes.sparkSession.sparkContext.broadcast(rarity)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = sent.value
        for b in batches:
            row, token, size, place, heavy = [], [], [], [], []
            for r, (s, w) in enumerate(zip(b.column("s"), b.column("w"))):
                s, w = np.frombuffer(s.as_py(), np.uint64), w.as_py()
                weight = np.frombuffer(w, np.int32).astype(np.float64) if w else np.ones(len(s))
                order = np.lexsort((s, count[(s % _U(COUNTERS)).astype(np.int64)]))
                weight = weight[order]
                before = np.cumsum(weight) - weight
                k = int(np.searchsorted(before, (1 - SIMILARITY) * weight.sum() + 1e-6, side="right"))
                row.append(np.full(k, r))
                token.append(s[order[:k]])
                size.append(np.full(k, len(s)))
                place.append(np.arange(k))
                heavy.append(np.full(k, bool(w)))
            at = pa.array(np.concatenate(row) if row else np.empty(0, np.int64))
            long = lambda x, kind=np.int64: pa.array(np.concatenate(x).astype(kind) if x else np.empty(0, kind))
            tokens = pa.array(np.concatenate(token).view(np.int64) if token else np.empty(0, np.int64))
            yield pa.RecordBatch.from_arrays([tokens, b.column("key").take(at), b.column("root").take(at), long(size), long(place), long(heavy, np.bool_)], ["token", "key", "root", "n", "i", "heavy"])

    return nodes.select("key", "s", "w", "root").mapInArrow(run, "token long, key binary, root binary, n long, i long, heavy boolean")


def _across(rows: DataFrame) -> DataFrame:
    """a, b: pairs of different roots that share one of the rarest shingles where both may have their first common one."""
    common = lambda n, m: F.floor((4 * (n + m) + 8) / 9)  # noqa: E731  the least common number, rounded up
    # of a token's nodes without repeats the smallest bounds where the others may have it
    ends = F.min("root").alias("low"), F.max("root").alias("high")
    least = _facts(rows, "token", F.min("n").alias("least"), F.max("heavy").alias("any_heavy"), *ends).where("low <> high").select("token", "least", "any_heavy")
    rows = rows.join(least, "token").where(F.col("any_heavy") | (F.col("i") <= F.col("n") - common(F.col("n"), F.col("least"))))
    several = _facts(rows, "token", F.ceil(F.count("*") / SALTED).cast("int").alias("salts"), *ends).where("low <> high").select("token", "salts")
    rows = stored(rows.join(several, "token").select("token", "salts", "key", "root", "n", "i", "heavy"), "near-tokens")
    left = rows.withColumn("salt", F.pmod(F.xxhash64("key"), F.col("salts")).cast("int"))
    other = rows.select("token", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), *(F.col(c).alias(f"_{c}") for c in ("key", "root", "n", "i", "heavy")))
    o = common(F.col("n"), F.col("_n"))
    fits = F.col("heavy") | F.col("_heavy") | ((F.col("i") <= F.col("n") - o) & (F.col("_i") <= F.col("_n") - o))
    pairs = left.join(other, ["token", "salt"]).where((F.col("key") < F.col("_key")) & (F.col("root") != F.col("_root")) & fits)
    return pairs.select(F.col("key").alias("a"), F.col("_key").alias("b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """key, root (the smallest key of its component) of the nodes of links a, b: a large and a small star a round, until a
    round changes nothing. Each round is stored, so plans stay small."""
    edges = stored(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "near-edges")
    mark = lambda e: e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    before = mark(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = _facts(both, "u", F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        least = _facts(large, "u", F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        new = stored(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "near-edges")
        discard(edges)
        edges, after = new, mark(new)
        if after == before:
            break
        before = after
    return edges.groupBy(F.col("u").alias("key")).agg(F.min("v").alias("root"))


def _joined(roots: DataFrame, links: DataFrame) -> DataFrame:
    """roots after further links, found among the roots alone."""
    ends = links.select(F.col("a").alias("key"), "b").join(roots, "key", "left").select(F.coalesce("root", "key").alias("a"), F.col("b").alias("key"))
    ends = ends.join(roots, "key", "left").select("a", F.coalesce("root", "key").alias("b"))
    more = stored(components(ends), "near-more").withColumnsRenamed({"key": "_key", "root": "_root"})
    moved = roots.join(more, F.col("root") == F.col("_key"), "left").select("key", F.coalesce("_root", "root").alias("root"))
    new = more.join(roots.select(F.col("key").alias("_old")), F.col("_key") == F.col("_old"), "left_anti").select(F.col("_key").alias("key"), F.col("_root").alias("root"))
    return moved.unionByName(new)


def _rooted(df: DataFrame, roots: DataFrame) -> DataFrame:
    return df.join(roots.withColumnRenamed("root", "_root"), "key", "left").withColumn("root", F.coalesce("_root", "key")).drop("_root")


def linked(docs: DataFrame, signs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """key, root of the nodes that are linked to another. signs: `signed`, stored."""
    nodes = signs.groupBy("key").agg(F.min("id").alias("id"), F.any_value("bands").alias("bands"))
    rows = nodes.select(label(F.col("id"), F.col("key")).alias("key"), F.explode("bands").alias("bucket"))
    full = _facts(rows, "bucket", F.count("*").alias("n")).where("n > 1")
    plain = stored(rows.join(full, "bucket").select("bucket", "key", "n"), "near-rows")
    known = plain.groupBy("key").agg(F.sum("n").alias("fame"))
    rows = stored(plain.join(known, "key").select("bucket", "key", "fame"), "near-rows")
    discard(plain)

    needed = rows.select("key").distinct().select("key", md5_of(F.col("key")).alias("_md5"), id_of(F.col("key")).alias("_id"))
    text = whole_text(F.col(text_col))
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.unhex(F.md5(text)).alias("md5"), text.alias("text"))
    texts = texts.join(needed, (F.col("md5") == F.col("_md5")) & F.col("id").eqNullSafe(F.col("_id"))).select("key", "text")
    blobs = stored(_blobs(texts).groupBy("key").agg(F.any_value("s").alias("s"), F.any_value("w").alias("w")), "near-shingles")

    centres = _facts(rows, "bucket", F.max_by("key", F.struct("fame", "key")).alias("c"))
    pairs = rows.join(centres, "bucket").where("key <> c").select(F.least("key", "c").alias("a"), F.greatest("key", "c").alias("b")).distinct()
    roots = stored(components(_verified(pairs, blobs)), "near-roots")
    left = _rooted(rows.select("bucket", "key"), roots)
    several = _facts(left, "bucket", F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high").select("bucket")
    left = stored(left.join(several, "bucket").select("key", "root").distinct(), "near-left")
    rarest = stored(_rarest(blobs.join(left, "key"), _rarity(blobs)), "near-rarest")
    links = stored(_verified(_across(rarest), blobs), "near-links")
    found = roots if links.isEmpty() else stored(_joined(roots, links), "near-roots")
    for used in (rows, blobs, left, rarest, links):
        discard(used)
    return found


def _classes(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """signs; and per node: key (MD5), id (smallest), n (rows), label, root (null: linked to none)."""
    signs = stored(signed(docs, id_col, text_col), "near-signs")
    roots = linked(docs, signs, id_col, text_col).select(F.col("key").alias("_label"), "root")
    nodes = signs.groupBy("key").agg(F.min("id").alias("id"), F.count("*").alias("n")).withColumn("label", label(F.col("id"), F.col("key")))
    return signs, stored(nodes.join(roots, F.col("label") == F.col("_label"), "left").drop("_label"), "near-classes")


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, class_id (smallest id of its near-duplicates)."""
    signs, nodes = _classes(docs, id_col, text_col)
    # of any other row the class is its own
    named = nodes.where("n > 1 or root is not null").select("key", F.coalesce("root", "label").alias("root"))
    class_id = F.when(F.col("root").isNull(), F.col("id")).otherwise(id_of(F.col("root")))
    return signs.select("id", "key").join(named, "key", "left").select(F.col("id").alias("doc_id"), class_id.alias("class_id"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with one row of each class."""
    signs, nodes = _classes(docs, id_col, text_col)
    first = nodes.where("root is null or root = label").select(F.col("id").alias("_id"), F.col("key").alias("_key"))
    rows = signs.groupBy("id", "key").count().where("count > 1").select("id", "key", F.lit(True).alias("_repeated"))
    kept = first.join(rows, F.col("id").eqNullSafe(F.col("_id")) & (F.col("key") == F.col("_key")), "left").select("_id", "_key", F.coalesce("_repeated", F.lit(False)).alias("_repeated"))
    whole = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("row"))
    whole = whole.select("row", F.unhex(F.md5(whole_text(F.col(f"row.`{text_col}`")))).alias("key"))
    whole = whole.join(kept, (F.col("key") == F.col("_key")) & F.col(f"row.`{id_col}`").cast("long").eqNullSafe(F.col("_id")))
    # repeated rows of the kept document: one stays
    once = whole.where("not _repeated").select("row")
    more = whole.where("_repeated").groupBy("key").agg(F.min_by("row", F.to_json("row")).alias("row")).select("row")
    return once.unionByName(more).select("row.*")
