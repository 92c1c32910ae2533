"""Digests of SentencePiece come from ids, byte spans and text of the encoder."""

from __future__ import annotations

import hashlib
import random
import struct

from rivulet.llm import spm
from rivulet.llm.queries import op8_sentencepiece, public_model

DIR = "/root/testdata/sf0.001"
TEXTS = ["", " ", "a", "  two  spaces ", "naïve café\n\n\ttab", "日本語 テキスト", "😀😀 x😀y", "é   ​", "▁ ▁▁a▁b", "\x00\x01 z"]


def test_aligned_is_spans():
    own, r = spm.coder(public_model()), random.Random(8)
    more = ["".join(r.choice("ab  é日😀\n▁́Z9.") for _ in range(r.randrange(60))) for _ in range(400)]
    for t in [*TEXTS, *more]:
        told, said, ids, starts, ends = own.aligned(t)
        assert list(zip(ids.tolist(), starts.tolist(), ends.tolist())) == own.spans(t), repr(t)
        assert (told, said) == own.joined(t)[1:]


def test_query_digests_spans(spark):
    own = spm.coder(public_model())
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{DIR}/documents.parquet").collect()}
    sha = lambda b: hashlib.sha256(b).hexdigest()
    for r in op8_sentencepiece(spark, DIR).collect():
        spans = own.spans(texts[r["doc_id"]])
        assert r["n_tokens"] == len(spans)
        assert r["ids_sha256"] == sha(",".join(str(x[0]) for x in spans).encode())
        assert r["spans_sha256"] == sha(b"".join(struct.pack("<2i", *x[1:]) for x in spans))


def test_encode_rows(spark):
    own = spm.coder(public_model())
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    for r in spm.encode(df, public_model()).collect():
        assert list(zip(r["ids"], r["starts"], r["ends"])) == own.spans(TEXTS[r["doc_id"]])
        assert r["decoded"] == own.decode(r["ids"])
