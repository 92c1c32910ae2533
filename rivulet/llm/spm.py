"""SentencePiece encoding with offsets, and decoding.

Normalisation is done here: at each place the longest prefix that the model's compiled character map knows is
replaced (a double array of bytes in the map's first part, replacements in its second), else one character is kept;
spaces become the meta symbol, one more stands before the text if the model asks for it, and extra spaces go if it
asks for that. Every byte of the normalised text keeps the span of the source it came from, so that
each piece is projected to a span of bytes of the original text.

Merging is the library's, on stretches of normalised text between which no piece can lie: a stretch ends before a
meta symbol and at any character that no piece but a byte holds. Equal stretches, mostly words, are merged once and
kept, as the bytes of their ids, in a table per task of bounded number and length; longer stretches aren't kept. A model
whose pieces hold a meta symbol after another character isn't cut.

Defined results
- null text: as empty: no ids, and the empty text decoded.
- repeated rows and equal or null ids: each row is encoded alone. Empty table: empty result.
- a text of any length is encoded whole; memory is its ids. Only the id and the text are read.
"""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Iterator
from itertools import accumulate, chain
from typing import TYPE_CHECKING

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.llm.common import released

if TYPE_CHECKING:  # imported, it takes 27 MB of each worker, also of those that use Arrow alone
    import pandas as pd

META = "▁"
#: Merged stretches a task keeps, characters of the longest kept, stretches given to the library at once.
KEPT, LONGEST, AT_ONCE = 20_000, 48, 10_000


class CharMap:
    """The compiled character map: longest-prefix replacement with a record of the source."""

    def __init__(self, blob: bytes) -> None:
        self.units: tuple[int, ...] = ()
        self.texts = b""
        if blob:
            size = struct.unpack_from("<I", blob)[0]
            self.units = struct.unpack_from(f"<{size // 4}I", blob, 4)
            self.texts = blob[4 + size :]

    def longest(self, data: bytes, at: int) -> tuple[int, bytes] | None:
        """Length of the longest known prefix of data from `at`, and what replaces it."""
        if not self.units:
            return None
        best = None
        node = self._child(0)
        for k in range(at, len(data)):
            node ^= data[k]
            unit = self.units[node]
            if unit & 0x800000FF != data[k]:
                break
            node ^= self._offset(unit)
            if unit >> 8 & 1:
                place = self.units[node] & 0x7FFFFFFF
                best = k + 1 - at, self.texts[place : self.texts.index(b"\0", place)]
        return best

    def _child(self, node: int) -> int:
        return node ^ self._offset(self.units[node])

    @staticmethod
    def _offset(unit: int) -> int:
        return (unit >> 10) << ((unit & (1 << 9)) >> 6)

    def replaced(self, text: str) -> tuple[str, list[int]]:
        """The text with known prefixes replaced, and for each character of it the source byte it starts at;
        one more for the end."""
        data = text.encode()
        out: list[str] = []
        starts: list[int] = []
        at = 0
        while at < len(data):
            found = self.longest(data, at)
            if found:
                n, new = found[0], found[1].decode()
            else:
                n = 1 if data[at] < 0x80 else 2 if data[at] < 0xE0 else 3 if data[at] < 0xF0 else 4
                new = data[at : at + n].decode()
            out.append(new)
            starts += [at] * len(new)
            at += n
        return "".join(out), [*starts, len(data)]


class Coder:
    """A loaded model: encode, spans, decode."""

    def __init__(self, path: str) -> None:
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:  # a library file of every worker's own installation
            proto.ParseFromString(f.read())
        spec = proto.normalizer_spec
        self.map = CharMap(spec.precompiled_charsmap)
        self.prefix, self.squeeze, self.escape = spec.add_dummy_prefix, spec.remove_extra_whitespaces, spec.escape_whitespaces
        spec.precompiled_charsmap, spec.add_dummy_prefix, spec.remove_extra_whitespaces, spec.name = b"", False, False, "identity"
        self.merger = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
        plain = [p.piece for p in proto.pieces if p.type in (1, 4)]
        held = set().union(*plain)
        breaks = "".join(re.escape(c) for c in "\n\t\r" if c not in held)
        whole = any(META in p.lstrip(META) for p in plain) or any(p.type == 4 for p in proto.pieces)
        self.stretch = re.compile("(?s).+" if whole else f"[{breaks}]|{META}*[^{META}{breaks}]+|{META}+" if breaks else f"{META}*[^{META}]+|{META}+")
        self.kept: dict[str, bytes] = {}
        self.bytes = {i: int(p.piece[3:-1], 16) for i, p in enumerate(proto.pieces) if p.type == 6}
        #: Bytes that are no character alone.
        self.parts = {i for i, b in self.bytes.items() if b > 0x7F}
        said = {1: lambda p: p.piece.replace(META, " "), 2: lambda p: proto.trainer_spec.unk_surface, 4: lambda p: p.piece.replace(META, " "), 6: lambda p: chr(int(p.piece[3:-1], 16)) if int(p.piece[3:-1], 16) < 0x80 else ""}
        self.sizes = np.array([1 if p.type == 6 else len(p.piece.encode()) for p in proto.pieces], np.int64)
        #: Bytes of the original text per piece where spaces alone are replaced; -1 for what is no whole characters.
        self.plain = not (self.map.units or self.squeeze) and self.escape
        self.sources = np.array([-1 if p.type == 2 or p.type == 6 and int(p.piece[3:-1], 16) > 0x7F else 1 if p.type == 6 else len(p.piece.replace(META, " ").encode()) for p in proto.pieces], np.int32)
        self.unknown = [i for i, p in enumerate(proto.pieces) if p.type == 2]
        self.pieces = [said.get(p.type, lambda p: "")(p) for p in proto.pieces]

    def normalise(self, text: str) -> tuple[str, list[int]]:
        """The normalised text, and for each character of it the source byte it starts at, and the end."""
        if not (self.map.units or self.squeeze):
            new, starts = self._plain(text)
            return new, starts.tolist()
        new, starts = self.map.replaced(text)
        if self.squeeze:
            kept = [i for i, c in enumerate(new) if c != " " or 0 < i and new[i - 1] != " " and new[i:].strip(" ")]
            starts = [*(starts[i] for i in kept), starts[kept[-1] + 1] if kept else starts[-1]]
            new = "".join(new[i] for i in kept)
        if self.prefix and new:
            new, starts = " " + new, [starts[0], *starts]
        return (new.replace(" ", META) if self.escape else new), starts

    def _plain(self, text: str) -> tuple[str, np.ndarray]:
        """normalise() where nothing is replaced or squeezed: a character starts at each byte that continues none."""
        data = np.frombuffer(text.encode(), np.uint8)
        starts = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))
        if self.prefix and text:
            text, starts = " " + text, np.append(0, starts)
        return (text.replace(" ", META) if self.escape else text), starts

    def _merge(self, stretches: list[str]) -> dict[str, bytes]:
        """The ids of different stretches, each as int32."""
        found: dict[str, bytes] = {}
        for k in range(0, len(stretches), AT_ONCE):
            some = stretches[k : k + AT_ONCE]
            got = self.merger.encode(some, num_threads=1)
            ends = [0, *accumulate([4 * len(ids) for ids in got])]
            ids = np.fromiter(chain.from_iterable(got), np.int32, ends[-1] // 4).tobytes()
            found.update(zip(some, [ids[x:y] for x, y in zip(ends, ends[1:])]))
        return found

    def said(self, ids: list[int]) -> str:
        """What ids decode to, with the space that stands before the text."""
        if self.parts.isdisjoint(ids):
            return "".join([self.pieces[i] for i in ids])
        out, held = [], bytearray()
        for i in ids:
            if i in self.bytes:
                held.append(self.bytes[i])
                continue
            out.append(held.decode(errors="replace"))
            held.clear()
            out.append(self.pieces[i])
        return "".join([*out, held.decode(errors="replace")])

    def _merged(self, new: str) -> np.ndarray:
        """The ids of normalised text."""
        parts = self.stretch.findall(new)
        kept = self.kept
        missing = list(dict.fromkeys([s for s in parts if s not in kept]))
        if not missing:
            return np.frombuffer(b"".join([kept[s] for s in parts]), np.int32)
        found = self._merge(missing)
        ids = np.frombuffer(b"".join([found[s] if s in found else kept[s] for s in parts]), np.int32)
        short = [s for s in missing if len(s) <= LONGEST][:KEPT]
        if len(kept) + len(short) > KEPT:
            kept.clear()
        kept.update({s: found[s] for s in short})
        return ids

    def joined(self, text: str) -> tuple[int, str, str]:
        """Number of ids, the ids in decimal joined by commas, and the text they decode to."""
        ids = self._merged(self.normalise(text)[0])
        return len(ids), *self._told(ids)

    def _told(self, found: np.ndarray) -> tuple[str, str]:
        ids = found.tolist()
        return ",".join(map(str, ids)), self.decode(ids)

    def encode(self, text: str) -> list[int]:
        return self._merged(self.normalise(text)[0]).tolist()

    def spans(self, text: str) -> list[tuple[int, int, int]]:
        """(id, first byte, end byte) of the original text per piece; the spans are in order, and bytes of one
        character that came out as several pieces share its span."""
        new, starts = self.normalise(text)
        lengths = [len(c.encode()) for c in new]
        out, char, within = [], 0, 0
        for i in self.encode(text):
            begin = char
            n = lengths[char] if i in self.unknown else int(self.sizes[i])
            within += n
            while char < len(lengths) and within >= lengths[char]:
                within -= lengths[char]
                char += 1
            end = char + (within > 0)
            out.append((i, starts[begin], starts[max(end, begin)]))
        return out

    def aligned(self, text: str) -> tuple[str, str, np.ndarray, np.ndarray, np.ndarray]:
        """ids in decimal joined by commas, the text they decode to, ids, and first and end bytes of the original text:
        what spans() gives, for all pieces at once."""
        if self.plain and META not in text:
            ids = self._merged((" " + text if self.prefix and text else text).replace(" ", META))
            sizes = self.sources[ids]
            if not len(ids) or sizes.min() > 0:  # each piece is whole characters, so lengths give the places
                ends = np.cumsum(sizes) - self.prefix
                return *self._told(ids), ids, np.maximum(ends - sizes, 0), ends
        new, starts = self.normalise(text) if self.map.units or self.squeeze else self._plain(text)
        ids = self._merged(new)
        told, said = self._told(ids)
        if self.unknown and np.isin(ids, self.unknown).any():
            rows = np.array(self.spans(text), np.int64).reshape(-1, 3)
            return told, said, ids, rows[:, 1], rows[:, 2]
        lead = (np.frombuffer(new.encode(), np.uint8) & 0xC0) != 0x80
        char = np.cumsum(lead) - 1  # of each byte of the normalised text
        ends = np.cumsum(self.sizes[ids])
        begins = ends - self.sizes[ids]
        starts = np.asarray(starts, np.int64)
        return told, said, ids, starts[char[begins]], starts[char[ends - 1] + 1]

    def decode(self, ids: list[int]) -> str:
        said = self.said(ids)
        return said[1:] if self.prefix and said[:1] == " " else said


_coders: dict[str, Coder] = {}


def coder(path: str) -> Coder:
    """The worker's own coder of a model file."""
    if path not in _coders:
        _coders[path] = Coder(path)
    return _coders[path]


def encode(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids array<int>, starts and ends array<int> (bytes of the original text per piece), decoded."""
    import pandas as pd

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        c = coder(model)
        for b in batches:
            rows = [c.aligned(t or "") for t in b["text"]]
            yield pd.DataFrame({"doc_id": b["doc_id"], "ids": [r[2] for r in rows], "starts": [r[3].astype(np.int32) for r in rows], "ends": [r[4].astype(np.int32) for r in rows], "decoded": [r[1] for r in rows]})

    df = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return df.mapInPandas(released(run, lambda: coder(model).kept), f"doc_id {df.schema['doc_id'].dataType.simpleString()}, ids array<int>, starts array<int>, ends array<int>, decoded string")


def digests(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256, spans_sha256 of what encode gives, made beside it so that no array leaves
    the worker. Digests are of the ids in decimal joined by commas, the decoded text, and first and end byte of each
    piece in turn as little-endian int32."""
    import pyarrow as pa

    df = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    sha = lambda x: hashlib.sha256(x).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = coder(model)
        for b in batches:
            n, told, said, spans = [], [], [], []
            for t in b.column("text"):
                x, y, ids, starts, ends = c.aligned(t.as_py() or "")
                n.append(len(ids))
                told.append(sha(x.encode()))
                said.append(sha(y.encode()))
                spans.append(sha(np.stack([starts, ends], 1).astype("<i4").tobytes()))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(n, pa.int64()), *(pa.array(x, pa.string()) for x in (told, said, spans))], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "spans_sha256"])

    return df.mapInArrow(released(run, lambda: coder(model).kept), f"doc_id {df.schema['doc_id'].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string, spans_sha256 string")
