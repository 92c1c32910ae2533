"""Fill-in-the-middle transformation on ropes.

A text is a rope: a binary tree whose leaves are stretches of at most `LEAF` units, cut where a unit ends, and whose
nodes cache how many units and code points they hold. A unit is a run of ASCII letters or any other single code point.
Two splits at ranks of units give prefix, middle and suffix; joined again in another order with sentinels between, they
are the output. The way back makes a rope of the output alone, splits it where the sentinels stand (by rank of code
points) and joins the parts in their first order. Splits walk one path of the tree, so a text costs one pass for its
leaves and a few steps for the rest, whatever its length.

Where a text is cut, and in which form it goes out, follows from a digest of the seed and the id alone:
the same on any cluster, and reruns agree.

Defined results
- null text: as empty, which is plain. Null id: as the empty id. Equal ids: cut by the same digest, each in its own text.
- a text that holds a sentinel stays plain, so that no output is ambiguous.
- repeated rows: each row is transformed alone. Empty table: empty result. A text of any length is cut whole.
- only the id and the text are read, so other columns can't clash.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.llm.common import whole_text

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Units in a leaf at most; characters of output in a batch, after which it is passed on.
LEAF, BATCH = 512, 8_000_000

_UNIT = "(?:[A-Za-z]++|[^A-Za-z])"
_LEAVES = re.compile(f"{_UNIT}{{1,{LEAF}}}+")
_UNITS = re.compile(_UNIT)


class Rope:
    """An immutable text; `units` and `chars` of every subtree are cached."""

    __slots__ = ("chars", "left", "right", "text", "units")

    def __init__(self, text: str = "", units: int = 0, left: Rope | None = None, right: Rope | None = None) -> None:
        self.text, self.left, self.right = text, left, right
        if left is None or right is None:
            self.units, self.chars = units, len(text)
        else:
            self.units, self.chars = left.units + right.units, left.chars + right.chars

    @classmethod
    def of(cls, text: str) -> Rope:
        """A balanced tree over the text's leaves; all but the last hold LEAF units."""
        pieces = _LEAVES.findall(text)
        if not pieces:
            return cls()
        level = [cls(p, LEAF) for p in pieces[:-1]]
        level.append(cls(pieces[-1], len(_UNITS.findall(pieces[-1]))))
        while len(level) > 1:
            level = [cls.join(*level[i : i + 2]) for i in range(0, len(level), 2)]
        return level[0]

    @classmethod
    def join(cls, *parts: Rope) -> Rope:
        """The parts in order, as one tree. The units of the parts must not run into each other."""
        some = [p for p in parts if p.chars]
        if not some:
            return cls()
        out = some[0]
        for p in some[1:]:
            out = cls(left=out, right=p)
        return out

    def split(self, rank: int, by_chars: bool = False) -> tuple[Rope, Rope]:
        """The first `rank` units (or code points, where a unit may be cut in two) and the rest."""
        size = self.chars if by_chars else self.units
        if rank <= 0:
            return Rope(), self
        if rank >= size:
            return self, Rope()
        if self.left is None or self.right is None:
            if by_chars:
                cut, before = rank, len(_UNITS.findall(self.text[:rank]))
                return Rope(self.text[:cut], before), Rope(self.text[cut:], len(_UNITS.findall(self.text[cut:])))
            cut = next(islice(_UNITS.finditer(self.text), rank - 1, None)).end()
            return Rope(self.text[:cut], rank), Rope(self.text[cut:], self.units - rank)
        first = self.left.chars if by_chars else self.left.units
        if rank < first:
            a, b = self.left.split(rank, by_chars)
            return a, Rope.join(b, self.right)
        a, b = self.right.split(rank - first, by_chars)
        return Rope.join(self.left, a), b

    def __str__(self) -> str:
        out: list[str] = []
        todo = [self]
        while todo:
            node = todo.pop()
            if node.left is None or node.right is None:
                out.append(node.text)
            else:
                todo += [node.right, node.left]
        return "".join(out)


def _sentinel(s: str) -> Rope:
    return Rope(s, len(_UNITS.findall(s)))


@dataclass(frozen=True)
class Choice:
    """Which texts are cut, of 100, and how many of those go out suffix first."""

    seed: int = 1
    cut_of_100: int = 90
    suffix_first_of_100: int = 20


def cut(text: str, doc_id: object, choice: Choice = Choice()) -> tuple[int, str, int | None, int | None, str]:
    """Units, form, code points of prefix and of middle (None if plain), output."""
    rope = Rope.of(text)
    digest = hashlib.sha256(f"{choice.seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i : i + 8], 16) for i in range(0, 32, 8))
    if not text or h3 % 100 >= choice.cut_of_100 or PREFIX in text or SUFFIX in text or MIDDLE in text:
        return rope.units, "plain", None, None, text
    low, high = sorted((h1 % (rope.units + 1), h2 % (rope.units + 1)))
    rest, suffix = rope.split(high)
    prefix, middle = rest.split(low)
    if h4 % 100 < choice.suffix_first_of_100:
        form, out = "spm", Rope.join(_sentinel(SUFFIX), suffix, _sentinel(PREFIX), prefix, _sentinel(MIDDLE), middle)
    else:
        form, out = "psm", Rope.join(_sentinel(PREFIX), prefix, _sentinel(SUFFIX), suffix, _sentinel(MIDDLE), middle)
    return rope.units, form, prefix.chars, middle.chars, str(out)


def uncut(output: str, form: str) -> str:
    """The text that `cut` made an output of that form of. Raises ValueError where the output isn't of the form."""
    if form == "plain":
        return output
    if form not in ("psm", "spm"):
        raise ValueError(f"no such form: {form}")
    first, second = (PREFIX, SUFFIX) if form == "psm" else (SUFFIX, PREFIX)
    if not output.startswith(first):
        raise ValueError(f"an output of form {form} begins with {first}")
    at = output.index(second, len(first))
    last = output.index(MIDDLE, at + len(second))
    rest, middle = Rope.of(output).split(last + len(MIDDLE), by_chars=True)
    rest, _ = rest.split(last, by_chars=True)
    a, b = rest.split(at, by_chars=True)
    a, b = a.split(len(first), by_chars=True)[1], b.split(len(second), by_chars=True)[1]
    prefix, suffix = (a, b) if form == "psm" else (b, a)
    return str(Rope.join(prefix, middle, suffix))


def transform(docs: DataFrame, choice: Choice = Choice(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, output of every row."""
    import pyarrow as pa

    df = docs.select(F.col(id_col).alias("doc_id"), whole_text(F.col(text_col)).alias("text"))
    schema = f"doc_id {df.schema['doc_id'].dataType.simpleString()}, n long, form string, prefix_chars long, middle_chars long, output string"
    types = [None, pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]
    names = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made(ids: pa.Array, rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([ids, *(pa.array(c, t) for c, t in zip(zip(*rows), types[1:]))], names)

        for b in batches:
            ids, rows, size, start = b.column("doc_id"), [], 0, 0
            for i, text in enumerate(b.column("text")):
                rows.append(cut(text.as_py(), ids[i].as_py(), choice))
                size += len(rows[-1][4])
                if size > BATCH:
                    yield made(ids.slice(start, len(rows)), rows)
                    start, rows, size = i + 1, [], 0
            if rows:
                yield made(ids.slice(start, len(rows)), rows)

    return df.mapInArrow(run, schema)


def restore(transformed: DataFrame) -> DataFrame:
    """The frame of `transform` with `restored`, rebuilt from output and form alone."""
    import pyarrow as pa
    from pyspark.sql.types import StringType, StructField, StructType

    schema = StructType([*transformed.schema.fields, StructField("restored", StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            start, back, size = 0, [], 0
            for i, (out, form) in enumerate(zip(b.column("output"), b.column("form"))):
                back.append(uncut(out.as_py(), form.as_py()))
                size += len(back[-1])
                if size > BATCH or i + 1 == b.num_rows:
                    part = b.slice(start, len(back))
                    yield pa.RecordBatch.from_arrays([*part.columns, pa.array(back, pa.string())], [*part.schema.names, "restored"])
                    start, back, size = i + 1, [], 0

    return transformed.mapInArrow(run, schema)


def digests(docs: DataFrame, choice: Choice = Choice(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """transform and restore, with digests in place of the texts."""
    df = restore(transform(docs, choice, id_col, text_col))
    return df.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(F.col("restored").cast("binary"), 256).alias("restored_sha256"),
    )
