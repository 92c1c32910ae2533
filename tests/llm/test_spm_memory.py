"""What a worker of the encoder holds: its table is bounded in bytes, and no library that it doesn't need is loaded."""

from __future__ import annotations

import random
import subprocess
import sys
from pathlib import Path

import sentencepiece

from rivulet.llm import spm
from rivulet.llm.queries import public_model

ROOT = str(Path(__file__).resolve().parents[2])


def _size(kept) -> int:
    inner = lambda x: sum(map(sys.getsizeof, x)) if isinstance(x, tuple) else 0
    return sys.getsizeof(kept) + sum(sys.getsizeof(k) + sys.getsizeof(v) + inner(v) for k, v in kept.items())


def test_table_is_bounded():
    own, lib, r = spm.Coder(public_model()), sentencepiece.SentencePieceProcessor(model_file=public_model()), random.Random(3)
    word = lambda n: "".join(r.choices("abcdefghijklmnopqrstuvwxyzé日", k=n))
    # many rare words, long runs without spaces, and more different words in one text than are kept
    texts = [" ".join(word(9) for _ in range(600)) + "\n" + word(4000) for _ in range(100)]
    texts.append(" ".join(word(8) for _ in range(spm.KEPT + 5000)))
    most = 0
    for t in texts:
        assert own.encode(t) == lib.encode(t)
        most = max(most, _size(own.kept))
    assert most < 5_000_000
    assert own.kept and own.encode(texts[0]) == lib.encode(texts[0])


def test_digests_load_no_pandas():
    code = "import sys, pyspark.worker, rivulet.llm.spm as s; s.coder(sys.argv[1]).aligned('some text'); assert 'pandas' not in sys.modules"
    subprocess.run([sys.executable, "-c", code, public_model()], check=True, cwd=ROOT)
