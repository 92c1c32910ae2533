"""Fill-in-middle, spelling variants and language against plain versions of themselves."""

from __future__ import annotations

import hashlib
import itertools
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from rivulet.llm import fim, language, spelling

DIR = "/root/testdata/sf0.001"


# --- fill-in-middle


def plain_cut(text, doc_id):
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    h = hashlib.sha256(f"1:{doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i : 8 * i + 8], 16) for i in range(4))
    n = len(units)
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:low]), "".join(units[low:high]), "".join(units[high:])
    if h4 % 100 < 20:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


TEXTS = ["", " ", "a", "ab cd", "<", "<<P", "x" * 5000, "a1" * 3000, "é😀 ab\x00\n\n", "the <S> sign", "P>S>M>" * 400, "<P" * 900, "wörter und Wörter " * 300]


def test_cut_as_plain_and_back():
    for text in TEXTS:
        for doc_id in range(60):
            got = fim.cut(text, doc_id)
            assert got == plain_cut(text, doc_id)
            assert fim.uncut(got[4], got[1]) == text


def test_rope_caches_and_splits():
    rng = np.random.default_rng(3)
    text = "".join(rng.choice(list("ab1 é"), 4000))
    rope = fim.Rope.of(text)
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    assert (rope.units, rope.chars, str(rope)) == (len(units), len(text), text)
    for k in (0, 1, 511, 512, 513, 1024, len(units) - 1, len(units), len(units) + 5):
        a, b = rope.split(k)
        assert (str(a), str(b)) == ("".join(units[:k]), "".join(units[k:])) and a.units == min(k, len(units)) and a.units + b.units == rope.units
        a, b = rope.split(k, by_chars=True)
        assert (str(a), str(b)) == (text[:k], text[k:]) and a.chars == min(k, len(text))


def test_uncut_refuses_other_forms():
    for out, form in (("<S>a<P>b<M>c", "psm"), ("abc", "psm"), ("<P>a<S>b", "psm"), ("abc", "other")):
        with pytest.raises(ValueError):
            fim.uncut(out, form)


def test_middle_frames(spark):
    rows = [(1, "one two three", "x"), (1, "one two three", "x"), (None, "four five", None), (2, None, "y"), (3, "", "z"), (4, "a <M> b", "q"), (5, "w " * 60_000, "q")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, form string").withColumns({"n": F.lit(1), "output": F.lit("x"), "restored": F.lit(2)})
    out = fim.restore(fim.transform(docs)).collect()
    assert len(out) == len(rows)
    for r in out:
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == plain_cut(r.restored, "" if r.doc_id is None else r.doc_id)
    assert Counter(r.restored for r in out) == Counter(t or "" for _, t, _ in rows)
    assert {r.form for r in out if r.doc_id in (2, 3, 4)} == {"plain"}
    assert fim.digests(docs.limit(0)).collect() == []


# --- spelling


def plain_groups(docs):
    n = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1 :]
            n[run] += 1
    words = {w: c for w, c in n.items() if c >= 5 and len(w) >= 6}

    def near(a, b):
        if len(a) > len(b):
            a, b = b, a
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))

    by = {w: [v for v in words if v != w and abs(len(v) - len(w)) < 2 and near(v, w)] for w in words}
    form = {}
    for w, some in by.items():
        best = min(some, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 5 * words[w] else None
    out = set()
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, words[w], len(by[w]), words[form[w]] if form[w] else None))
    return out


def test_spelling_as_plain(spark):
    rng = np.random.default_rng(1)
    rows = []
    for i in range(900):
        some = []
        for _ in range(20):
            w = str(rng.choice(["reason", "seasons", "Grüßen", "télévision", "aaaaaaa", "bananas"]))
            for _ in range(int(rng.choice([0, 0, 0, 0, 0, 0, 1, 1, 2]))):
                k, c = int(rng.integers(len(w))), str(rng.choice(list("abÿé")))
                w = [w[:k] + w[k + 1 :], w[:k] + c + w[k:], w[:k] + c + w[k + 1 :]][int(rng.integers(3))]
            some.append(w)
        rows.append((i, " ".join(some)))
    rows += [(None, "Reason × reason÷"), (7, None), (7, ""), (5, "reason reason"), (5, "reason reason")]
    rows += [(8, "gradual " * 700 + "graduals " * 70 + "gradualsx " * 8)]
    rows += [(1, "y" * 30_000 + " " + "y" * 29_999 + "z")] * 5 + [(1, "y" * 30_000)] * 25
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"word": F.lit("x"), "n": F.lit(1), "id": F.lit("q"), "key": F.lit(0)})
    got = {tuple(r) for r in spelling.group(docs).select("word", "form", "root", "n", "n_near", "form_n").collect()}
    assert got == plain_groups(rows)
    assert sum(1 for r in got if r[1]) > 5 and any(r[1] and r[1] != r[2] for r in got)
    assert spelling.group(docs.limit(0)).collect() == []


def test_keys_join_all_near_words():
    rng = np.random.default_rng(2)
    for _ in range(2000):
        w = "".join(rng.choice(list("abé"), int(rng.integers(1, 9))))
        k, c = int(rng.integers(len(w))), str(rng.choice(list("abc")))
        for v in (w[:k] + w[k + 1 :], w[:k] + c + w[k:], w[:k] + c + w[k + 1 :]):
            assert spelling.keys_of(w) & spelling.keys_of(v)
        assert len(spelling.keys_of(w)) == len({w} | {w[:i] + w[i + 1 :] for i in range(len(w))})


def test_long_chain_of_forms(spark):
    forms = spark.createDataFrame([(f"w{i:02}", f"w{i + 1:02}") for i in range(20)] + [("x", "w00")], "word string, form string")
    assert {r.root for r in spelling.roots(forms).collect()} == {"w20"}


# --- language


@pytest.fixture(scope="module")
def field(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    learn = docs.where(~language.held_out(F.col("doc_id")))
    return language.fit(language.sample(learn, 200))


def test_forward_backward_by_enumeration():
    rng = np.random.default_rng(4)
    k, lengths = 3, np.array([5, 4, 4, 1])
    each = [rng.normal(0, 2, (n, k)) for n in lengths]
    moves, begins = rng.normal(0, 1, (k, k)), rng.normal(0, 1, k)
    scores = np.array([each[j][t] for t in range(5) for j in range(4) if t < lengths[j]])
    p, z, pairs, begun = language.marginals(scores, lengths, moves, begins)
    want_pairs, want_begun, at = np.zeros((k, k)), np.zeros(k), {}
    for j, n in enumerate(lengths):
        total, own = 0.0, np.zeros((n, k))
        moved, first = np.zeros((k, k)), np.zeros(k)
        for path in itertools.product(range(k), repeat=int(n)):
            w = np.exp(begins[path[0]] + sum(each[j][t, y] for t, y in enumerate(path)) + sum(moves[a, b] for a, b in zip(path, path[1:])))
            total += w
            first[path[0]] += w
            for t, y in enumerate(path):
                own[t, y] += w
            for a, b in zip(path, path[1:]):
                moved[a, b] += w
        assert np.isclose(z[j], np.log(total))
        want_pairs += moved / total
        want_begun += first / total
        for t in range(n):
            at[t, j] = own[t] / total
    assert np.allclose(p, [at[t, j] for t in range(5) for j in range(4) if t < lengths[j]])
    assert np.allclose(pairs, want_pairs) and np.allclose(begun, want_begun)


def test_gradient_by_differences():
    rng = np.random.default_rng(6)
    words = ["the", "der", "und", "and", "lexicon"]
    field = language.Field.blank(["a", "b", "c"], {"the": 1, "und": 6})
    field.weights[:] = rng.normal(0, 0.5, field.weights.shape)
    field.moves[:], field.begins[:] = rng.normal(0, 0.5, (3, 3)), rng.normal(0, 0.5, 3)
    pairs = list(field.rows(words))
    flat, of = np.concatenate([r for r, _ in pairs]), np.concatenate([w for _, w in pairs])
    flat, sizes = flat[np.argsort(of, kind="stable")], np.bincount(of)
    ids, labels = rng.integers(0, 5, (4, 6)), rng.integers(0, 3, (4, 6))
    args = (ids, labels, sizes, flat, np.cumsum(sizes) - sizes)
    _, by_word, moved, begun, own = language.likelihood(field, *args)
    step = 1e-5

    def slope(array, at):
        array[at] += step
        up = language.likelihood(field, *args)[0]
        array[at] -= 2 * step
        down = language.likelihood(field, *args)[0]
        array[at] += step
        return (up - down) / (2 * step)

    assert np.allclose([[slope(field.moves, (i, j)) for j in range(3)] for i in range(3)], moved, atol=1e-4)
    assert np.allclose([slope(field.begins, (i,)) for i in range(3)], begun, atol=1e-4)
    row = flat[0]
    of = np.sort(of)
    times = np.array([np.sum(flat[of == w] == row) for w in own])
    assert np.allclose([slope(field.weights, (row, j)) for j in range(3)], times @ by_word, atol=1e-4)


def test_emissions_add_up_rows():
    field = language.Field.blank(["a", "b"], {"ab": 5})
    field.weights[:] = np.random.default_rng(0).normal(size=field.weights.shape)
    words = ["ab", "a", "äöü😀", "b" * 500]
    want = np.zeros((4, 2))
    for rows, word in field.rows(words):
        np.add.at(want, word, field.weights[rows])
    assert np.allclose(field.emissions(words), want)
    assert np.allclose(field.emissions(words[1:2]), want[1:2])


def test_chains_alone_as_together(field):
    chains = [language.words_of(t) for t in ("Le chat et la souris", "", "the cat", "und die Maus the mouse and")]
    together = language.label_chains(field, language.Scored(field), chains)
    for chain, p in zip(chains, together):
        assert np.allclose(language.label_chains(field, language.Scored(field), [chain])[0], p) and np.allclose(p.sum(1), 1)


def test_held_out_language(spark, field):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    rows = language.predict(docs, field).where("held_out").join(docs.select("doc_id", "lang"), "doc_id").collect()
    right = sum(r.lang_pred == r.lang for r in rows)
    assert right >= 0.97 * len(rows) and all(0 <= r.score <= 1 for r in rows)
    assert all(sum(s.words for s in r.segments) == r.n_words for r in rows)


def test_switches_are_found(spark, field):
    docs = {r.lang: r for r in spark.read.parquet(f"{DIR}/documents.parquet").where("length(text) BETWEEN 600 AND 4000").collect()}
    a, b = (language.words_of(docs[x].text)[:40] for x in ("fr", "en"))
    both = spark.createDataFrame([(1, " ".join(a + b))], "doc_id long, text string")
    found = language.predict(both, field).first()
    assert [s.lang for s in found.segments] == ["fr", "en"] and abs(found.segments[0].words - len(a)) <= 3


def test_language_edges(spark, field):
    rows = [(1, None, "en"), (2, "", "en"), (3, "12 ٣ ² -", "en"), (4, "the " * 50_000, None), (None, "der die", ""), (5, "the", "en"), (5, "the", "en"), (6, "x" * 100_000, "de")]
    rows += [(i, t, w) for i in range(10, 20) for t, w in (("the cat", "en"), ("die Katze", "de"))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumns({"score": F.lit(3), "segments": F.lit("s"), "h": F.lit(1), "words": F.lit("w")})
    out = language.identify(docs).collect()
    assert len(out) == len(rows)
    und = [r for r in out if r.doc_id in (1, 2, 3)]
    assert {(r.lang_pred, r.score) for r in und} == {("und", 0.0)}
    assert {r.lang_pred for r in out if r.doc_id not in (1, 2, 3)} <= {"en", "de"}
    assert [r.held_out for r in out if r.doc_id is None] == [False]
    bare = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in language.identify(bare).collect()} == {"und"}
    assert language.identify(docs.limit(0)).collect() == []


def test_sample_does_not_depend_on_partitions(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    assert language.sample(docs, 50) == language.sample(docs.repartition(7), 50)
