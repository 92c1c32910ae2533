"""The pipeline's stages against what each has to do to its own input."""

from __future__ import annotations

import hashlib
from collections import Counter

import pytest

import corpus_pipeline as P
from rivulet.llm.queries import public_model
from tests_llm_brute import base_spans, brute_classes

DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    at = tmp_path_factory.mktemp("steps")
    out = [spark.read.parquet(f"{DIR}/documents.parquet")]
    for k, (_, stage) in enumerate(P.STAGES):
        stage(spark, out[-1], DIR).write.parquet(f"{at}/{k}")
        out.append(spark.read.parquet(f"{at}/{k}"))
    return [{"columns": df.columns, "rows": df.collect()} for df in out]


def test_stages(steps):
    docs, kept, single, clean, mixed, encoded = steps
    for s in (kept, single, clean, mixed):
        assert s["columns"] == P.COLUMNS
    text = lambda s: {r["doc_id"]: r["text"] or "" for r in s["rows"]}
    # the quality classifier takes rows away and changes none
    assert 0 < len(kept["rows"]) <= len(docs["rows"]) and {tuple(r) for r in kept["rows"]} <= {tuple(r) for r in docs["rows"]}
    # one document of each group
    assert sorted(text(single)) == sorted(set(brute_classes(text(kept)).values()))
    # no base span is left, and texts without any are as they were
    before, after = text(single), text(clean)
    assert before.keys() == after.keys() and not any(base_spans(t) for t in after.values())
    assert all(r["n_chars"] == len(r["text"] or "") for r in clean["rows"])
    # the mix repeats whole rows, at most three times
    copies = Counter(r["doc_id"] for r in mixed["rows"])
    assert max(copies.values()) <= 3 and all(after[r["doc_id"]] == (r["text"] or "") for r in mixed["rows"])
    # ids and decoded texts are the library's
    import sentencepiece

    lib = sentencepiece.SentencePieceProcessor(model_file=public_model())
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert Counter(r["doc_id"] for r in encoded["rows"]) == copies
    for r in encoded["rows"]:
        ids = lib.encode(after[r["doc_id"]])
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (len(ids), sha(",".join(map(str, ids))), sha(lib.decode(ids)))
