"""Operators against brute force, exact round trips and held-out accuracy."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rivulet.llm import chat, importance, lbl, mixing, pii, probminhash, quality_rules, spm, topk, toxicity
from rivulet.llm.queries import public_model
from tests_llm_brute import base_spans, brute_classes

DIR = "/root/testdata/sf0.001"
np.seterr(over="ignore")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{DIR}/documents.parquet")


@pytest.fixture(scope="module")
def texts(docs):
    return {r["doc_id"]: r["text"] or "" for r in docs.select("doc_id", "text").collect()}


def test_mix_near_targets(docs):
    rows = mixing.mix(docs).collect()
    assert rows and {tuple(r) for r in rows} == {tuple(r) for r in mixing.mix(docs).collect()}
    assert all(r["taken"] <= 3 * r["size"] for r in rows)
    by = defaultdict(list)
    for r in rows:
        by[r["source"]].append(r)
    order = sorted(by)
    total = sum(r["size"] for r in rows)
    weight = {s: 1 + i % 3 for i, s in enumerate(order)}
    size = {s: sum(r["size"] for r in by[s]) for s in order}
    target, capped = {}, set()
    while True:  # share again what is above, until none is
        free = [s for s in order if s not in capped]
        left = total - sum(3 * size[s] for s in capped)
        target = {s: 3 * size[s] if s in capped else left * weight[s] / sum(weight[x] for x in free) for s in order}
        over = {s for s in free if target[s] > 3 * size[s]}
        if not over:
            break
        capped |= over
    for s in order:
        assert by[s][0]["source_size"] == size[s]
        assert by[s][0]["target"] == pytest.approx(target[s])
        assert abs(sum(r["taken"] for r in by[s]) - target[s]) <= max(r["size"] for r in by[s])


def test_mixed_repeats_rows(docs):
    want = Counter({r["doc_id"]: r["copies"] for r in mixing.mix(docs).collect() if r["copies"]})
    assert Counter(r["doc_id"] for r in mixing.mixed(docs).collect()) == want


def test_water_fill_ties(spark):
    df = spark.createDataFrame([("a", 1.0, 10, 60), ("b", 1.0, 10, 60), ("c", 2.0, 100, 60)], "s string, w double, cap long, total long")
    out = {r["s"]: r["x"] for r in mixing.water_fill(df, [], "s", "w", "cap", "total", "x").collect()}
    assert out == {"a": 10.0, "b": 10.0, "c": 40.0}


CASES = ["a@b.c_d@e.f x@y.z.w", "1.2.3.4.5.6.7.8 256.1.1.1 0001.2.3.255", "4111 1111 1111 1111 4111-1111-1111-1111x", "+1 (255) 555-8013 +12 3456789 0 +1", "é😀 a@b.co 😀 4111111111111111 1.1.1.1", "+1+2+3 +12345678901234567890", "a..b@c-.d--e.f @x.y z@ a@b", "9" * 3000 + "a." * 3000 + "@b.c"]


def test_pii_base(spark, docs):
    df = spark.createDataFrame([(-i - 1, t) for i, t in enumerate(CASES)], "doc_id long, text string").unionByName(docs.select("doc_id", "text"))
    text = {r["doc_id"]: r["text"] or "" for r in df.collect()}
    for r in pii.find(df).collect():
        want = base_spans(text[r["doc_id"]])
        assert r["base_sha256"] == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert set(want) <= set(r["spans"].split(","))


@settings(max_examples=4, deadline=None)
@given(st.lists(st.text(alphabet="ab1.5@+- ()9é_%", max_size=60), min_size=20, max_size=20))
def test_pii_base_random(spark, texts_):
    df = spark.createDataFrame(list(enumerate(texts_)), "doc_id long, text string")
    for r in pii.find(df).collect():
        assert r["base_sha256"] == hashlib.sha256(",".join(base_spans(texts_[r["doc_id"]])).encode()).hexdigest()


def test_pii_added_and_redacted(spark):
    df = spark.createDataFrame([(1, "call (255) 555-8013 now"), (2, "josé.maria@x.example.com"), (3, "order 1234567890123456"), (4, "at 4111.1111.1111.1111"), (5, "write a@b.co and +1 (255) 555-8013!")], "doc_id long, text string")
    out = {r["doc_id"]: r["text"] for r in pii.redact(df).collect()}
    assert out == {1: "call [PHONE] now", 2: "[EMAIL]", 3: "order 1234567890123456", 4: "at [CARD]", 5: "write [EMAIL] and [PHONE]!"}


def test_search_brute_force(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", 7)
    rng = np.random.default_rng(0)
    v = rng.normal(size=(900, 12)) * rng.lognormal(0, 1.2, size=(900, 1))
    v[100:140] = v[100]  # ties
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<double>")
    got = defaultdict(list)
    for r in topk.search(df, F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    w = np.floor(1024 * v).astype(np.int64)
    for q in range(0, 900, 20):
        scores = sorted(((-int(w[q] @ w[i]), i) for i in range(900) if i != q))[:10]
        assert got[q] == [(i, -s) for s, i in scores]


OBFUSCATED = ["1d1ot", "i.d.i.o.t", "stuuupid", "$tupid", "m0r0n", "tra$h", "i d i o t", "w0rthl3ss", "lo5er"]


def test_toxicity(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    more = spark.createDataFrame([(10**7 + i, f"Thereat onan {w} the inga.") for i, w in enumerate([*OBFUSCATED, "idiot"])], "doc_id long, text string")
    known = d.select("doc_id", "text").unionByName(more)
    # plain words are labelled in many documents, their disguises never
    taught = spark.createDataFrame([(2 * 10**7 + i, f"Heon {w} inla the.", 1) for i in range(60) for w in ["idiot stupid", "moron trash", "worthless loser"][i % 3 : i % 3 + 1]], "doc_id long, text string, toxic int")
    out = toxicity.score(known.unionByName(taught.select("doc_id", "text")), labels.select("doc_id", "toxic").unionByName(taught.select("doc_id", "toxic")))
    rows = {r["doc_id"]: r for r in out.collect()}
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows.values())
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in rows.items())
    assert sum(rows[10**7 + i]["predicted"] for i in range(len(OBFUSCATED) + 1)) >= len(OBFUSCATED) - 1
    truth = [(r["toxic"], rows[r["doc_id"]]) for r in labels.collect()]
    held = [(t, r["predicted"]) for t, r in truth if r["held_out"]]
    assert sum(t == p for t, p in held) >= 0.93 * len(held)


def rules_of(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    eights = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    n = Counter(eights)
    covered = {i + k for i, e in enumerate(eights) if n[e] > 1 for k in range(8)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


def test_rules(spark, docs):
    extra = ["a b c d e f g h " * 3, "x " * 9, "l\n\nl\n l\nl", "é #$%|<>&* \x0b\x0c x\ty\r\nz", " ".join("abcdefghi") + " q " + " ".join("abcdefghi")]
    df = spark.createDataFrame([(-i - 1, t) for i, t in enumerate(extra)], "doc_id long, text string").unionByName(docs.select("doc_id", "text"))
    text = {r["doc_id"]: r["text"] or "" for r in df.collect()}
    for r in quality_rules.judge(df).collect():
        want = rules_of(text[r["doc_id"]])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want
        assert r["base_failed"] == (want[0] < 20 or 100 * want[4] > 30 * want[0])
        assert not (r["base_failed"] and r["kept"])


def test_importance_held_out(spark):
    d, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    d = d.where("doc_id < 4000")
    out = importance.classify(d, labels.where("doc_id % 2 = 0"))
    rows = out.join(labels.where("doc_id % 2 = 1"), "doc_id").groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()
    kept = {r["quality"]: r["kept"] for r in rows}
    assert kept[1] > 0.97 and kept[0] < 0.15


def test_kth_largest(spark):
    x = np.random.default_rng(1).normal(size=5000).round(2).tolist() + [1e6, -1e6]
    df = spark.createDataFrame([(v,) for v in x], "x double").repartition(3)
    for k in (1, 2, 17, 2500, 5001, 5002):
        assert importance.kth_largest(df, "x", k) == sorted(x, reverse=True)[k - 1]


def test_lbl(spark, docs, texts):
    rows = lbl.score(docs).collect()
    words = {i: re.findall(rb"[^\x20\x09-\x0D]+", t.encode().lower()) for i, t in texts.items()}
    held = {i: zlib.crc32(str(i).encode()) % 10 == 0 for i in texts}
    c = Counter(w for i, ws in words.items() if not held[i] for w in [*ws, b""])
    n, v = sum(c.values()), len(c)
    for r in rows:
        ts = [*words[r["doc_id"]], b""]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held[r["doc_id"]], len(ts), sum(t in c for t in ts), n)
        assert r["base_score"] == pytest.approx(sum(math.log10((c[t] + 0.1) / (n + 0.1 * (v + 1))) for t in ts), rel=1e-9)
        assert r["score"] < 0
    total = lambda k: sum(r[k] for r in rows if r["held_out"])
    assert total("score") > 0.99 * total("base_score")  # both negative: a hundredth better at least


def test_lbl_brute_force(docs, texts):
    """The score from the model's tables, word by word."""
    words = {i: re.findall(rb"[^\x20\x09-\x0D]+", t.encode().lower()) for i, t in texts.items()}
    learnt = [i for i in texts if zlib.crc32(str(i).encode()) % 10]
    c = Counter(w for i in learnt for w in words[i])
    own = [w for w, _ in sorted(c.items(), key=lambda x: (-x[1], x[0]))[: lbl.VOCABULARY]]
    known = {w: lbl.FIRST_WORD + i for i, w in enumerate(own)}
    n, v = Counter(), Counter()
    for w, k in c.items():
        g = known.get(w) or lbl.group(w)
        n[g] += k
        v[g] += 1
    frequency = np.array([len(learnt), *(n[k] for k in range(1, lbl.FIRST_WORD + len(own)))], np.float64)
    rows = docs.select("doc_id", lbl.held_out(F.col("doc_id")).alias("held_out"), F.col("text").cast("binary").alias("text"))
    a, b, z = lbl.train(rows.where("not held_out"), known, frequency).tables()
    for r in lbl.score(docs).limit(40).collect():
        x = y = lbl.END
        want = 0.0
        for w in [*words[r["doc_id"]], None]:
            k = lbl.END if w is None else known.get(w) or lbl.group(w)
            want += float(a[x, k] + b[y, k] - z[x, y]) / math.log(10)
            if 0 < k < lbl.FIRST_WORD:
                want += math.log10((c[w] + lbl.ALPHA) / (n[k] + lbl.ALPHA * (v[k] + 1)))
            x, y = y, k
        assert r["score"] == pytest.approx(want, rel=1e-4)


def test_lbl_normalised():
    model = lbl.Model(np.array([50.0, 10, 30, 20, 5, 5]))
    u = np.random.default_rng(0).integers(0, 6, (3, 4000))
    model.train(u[0], u[1], u[2], np.ones(4000, np.int64))
    a, c, z = model.tables()
    for x in range(6):
        for y in range(6):
            assert np.exp(a[x] + c[y] - z[x, y]).sum() == pytest.approx(1, abs=1e-4)


STRINGS = ["", "a", " ", "Hello  world\n\tx ▁y 漢字 �", "\x00a\x01", "a" * 300, "▁▁a▁b", "tab\tx\r\ny", "<s> </s> <unk> <0x41>", "1234 56.7", "x  \n   y    z     ", "</s>[INST] ok [/INST]", "😀é\u200b"]


def test_spm_like_library(texts):
    import sentencepiece

    lib, own = sentencepiece.SentencePieceProcessor(model_file=public_model()), spm.coder(public_model())
    for t in [*STRINGS, *texts.values()]:
        ids = lib.encode(t)
        n, joined, said = own.joined(t)
        assert (n, joined, said) == (len(ids), ",".join(map(str, ids)), lib.decode(ids))
        assert own.decode(ids) == lib.decode(ids)


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=40))
def test_spm_spans(text):
    own = spm.coder(public_model())
    spans = own.spans(text)
    data = text.encode()
    assert [s[0] for s in spans] == own.encode(text)
    assert all(a <= b for _, a, b in spans) and [s[1] for s in spans] == sorted(s[1] for s in spans)
    covered = bytearray(len(data))
    for _, a, b in spans:
        covered[a:b] = b"\1" * (b - a)
    assert all(covered)


def test_char_map():
    """A compiled map built here: ab -> X, a -> yy, in the double array's layout."""
    units = [0] * 1024

    def base(i, offset):
        units[i] |= offset << 10

    # root's children at 256 ^ label; a at 256^97, its children at 512 ^ label
    base(0, 256)
    a = 256 ^ 97
    units[a] = 97 | (a ^ 512) << 10 | 1 << 8
    units[512] = 1 << 31 | 2  # leaf of a: text at 2
    b = 512 ^ 98
    units[b] = 98 | (b ^ 768) << 10 | 1 << 8
    units[768] = 1 << 31 | 0
    import struct

    blob = struct.pack("<I", 4096) + struct.pack("<1024I", *units) + b"X\0yy\0"
    m = spm.CharMap(blob)
    assert m.replaced("abaéc") == ("Xyyéc", [0, 2, 2, 3, 5, 6])


def test_near_brute_force(spark, texts):
    rng = np.random.default_rng(0)
    base = [f"w{x}" for x in rng.integers(0, 300, 150)]
    more = dict(texts)
    for k in range(60):  # a group of near copies around one text
        words = list(base)
        for p in rng.choice(150, int(rng.integers(1, 7)), replace=False):
            words[p] = f"z{k}{p}"
        more[10_000 + k] = " ".join(words)
    df = spark.createDataFrame(list(more.items()), "doc_id long, text string")
    got = {r["doc_id"]: r["class_id"] for r in probminhash.classes(df).collect()}
    assert got == brute_classes(more)
    kept = {r["doc_id"] for r in probminhash.keep_one(df).collect()}
    assert kept == set(got.values())


def test_probability_jaccard():
    a, b = {1: 3, 2: 1, 4: 2}, {1: 1, 2: 2, 3: 1}
    want = sum(1 / sum(max(a.get(q, 0) / a[d], b.get(q, 0) / b[d]) for q in {*a, *b}) for d in a.keys() & b.keys())
    arrays = [np.array(sorted(x), np.uint64) for x in (a, b)]
    weights = [np.array([x[k] for k in sorted(x)]) for x in (a, b)]
    assert probminhash.similarity(arrays[0], weights[0], arrays[1], weights[1]) == pytest.approx(want)
    rng = np.random.default_rng(5)
    agree = []
    for _ in range(60):
        shift = rng.integers(0, 2**62, 5).astype(np.uint64)
        sets = [(np.array([shift[k] for k in sorted(x)]), np.array([x[k] for k in sorted(x)])) for x in (a, b)]
        s = probminhash.signatures(sets)
        agree.append((s[0] == s[1]).mean())
    assert np.mean(agree) == pytest.approx(want, abs=0.02)


@settings(max_examples=4, deadline=None)
@given(st.lists(st.text(alphabet="\\<s>/[INST]| endturbody", max_size=30), min_size=12, max_size=12))
def test_chat_round_trip(spark, said):
    rows = [(0, i, "assistant" if i % 2 else "u\\ser" + t[:3], t) for i, t in enumerate(said)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("content", chat.text_part(F.col("text")))
    made = chat.format_conversations(df)
    out = made.select(chat.read_turns(F.col("formatted")).alias("t"), chat.read_loss(F.col("formatted"), F.col("loss_spans")).alias("loss")).first()
    assert [tuple(t) for t in out["t"]] == [(r, t) for _, _, r, t in rows]
    assert out["loss"] == "".join(t for _, _, r, t in rows if r == "assistant")


def test_chat_parts(spark):
    rows = [(1, 0, "user", [("text", "see <|image|> ", None, None), ("image", None, "a.png", 2), ("audio", None, "b.wav", None), (None, "!", None, None)]), (1, 1, "assistant", [("document", None, "c.pdf", 3), ("other", "kept", None, None)])]
    made = chat.format_conversations(spark.createDataFrame(rows, f"conv_id long, turn long, role string, content array<{chat.PART}>")).first()
    assert made["formatted"] == "<|turn|>user<|body|>see <\\|image|> <|image|><|audio|>!<|end|><|turn|>assistant<|body|><|document|>kept<|end|>"
    assert [tuple(a) for a in made["attachments"]] == [(0, "image", "a.png", 512), (1, "audio", "b.wav", 25), (2, "document", "c.pdf", 2304)]
    assert made["attachment_tokens"] == 2841
