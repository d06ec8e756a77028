"""Fill-in-middle: documents rewritten as prefix, suffix and middle, so that a model learns to fill gaps.

A text's units are runs of letters A-Z and a-z and single other code points. Fixed blocks of its bytes hold their
numbers of units and code points in two Fenwick trees; a cut is found by descending the unit tree by powers of two to
its block, and inside that block by counting.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The marks before the prefix, the suffix and the middle.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"


@dataclass(frozen=True)
class Config:
    """``plain``: of a hundred documents those that stay as they are; ``spm``: of a hundred others those with the suffix
    first; ``seed``: the leading part of what is hashed; ``block``: bytes of a text that one leaf of the trees counts."""

    plain: int = 10
    spm: int = 20
    seed: str = "1:"
    block: int = 1024


class Fenwick:
    """Sums of leading blocks. Built in one pass; ``descend`` finds a place by binary lifting."""

    def __init__(self, counts: np.ndarray):
        n = len(counts)
        self.tree = np.zeros(n + 1, np.int64)
        self.tree[1:] = counts
        step = 1
        # a node adds the node half its span before it, level by level
        while 2 * step <= n:
            ups = np.arange(2 * step, n + 1, 2 * step)
            self.tree[ups] += self.tree[ups - step]
            step *= 2
        self.top = 1 << (n.bit_length() - 1) if n else 0

    def before(self, blocks: int) -> int:
        """The sum of the first ``blocks`` blocks."""
        total = 0
        while blocks:
            total += int(self.tree[blocks])
            blocks &= blocks - 1
        return total

    def descend(self, rank: int) -> tuple[int, int]:
        """(blocks before the one that holds number ``rank``, counted from 0; the sum before that block)."""
        at, total, step = 0, 0, self.top
        while step:
            nxt = at + step
            if nxt < len(self.tree) and total + self.tree[nxt] <= rank:
                at, total = nxt, total + int(self.tree[nxt])
            step >>= 1
        return at, total


_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True


class Units:
    """The units of one UTF-8 text."""

    def __init__(self, text: np.ndarray, block: int):
        letter = _LETTER[text]
        self.point = (text & 0xC0) != 0x80  # a code point begins
        self.unit = self.point.copy()       # a unit begins
        self.unit[1:] &= ~(letter[1:] & letter[:-1])
        self.block, self.size = block, len(text)
        firsts = np.arange(0, len(text), block)
        self.units = Fenwick(np.add.reduceat(self.unit, firsts, dtype=np.int64) if len(text) else np.zeros(0, np.int64))
        self.points = Fenwick(np.add.reduceat(self.point, firsts, dtype=np.int64) if len(text) else np.zeros(0, np.int64))
        self.n = self.units.before(len(firsts))

    def cut(self, units: int) -> tuple[int, int]:
        """(bytes, code points) of the first ``units`` units."""
        if units >= self.n:
            return self.size, self.points.before(-(-self.size // self.block))
        blocks, before = self.units.descend(units)
        lo = blocks * self.block
        at = lo + int(np.flatnonzero(self.unit[lo : lo + self.block])[units - before])
        return at, self.points.before(blocks) + int(np.count_nonzero(self.point[lo:at]))


def draws(doc_id: int | None, seed: str) -> tuple[int, int, int, int]:
    """Four numbers of 32 bits from a document's id (a null id counts as no text)."""
    h = hashlib.sha256(f"{seed}{'' if doc_id is None else doc_id}".encode()).digest()
    return struct.unpack(">4I", h[:16])


def transform_text(text: bytes, doc_id: int | None, c: Config) -> tuple[int, str, int | None, int | None, bytes]:
    """(units, form, code points of the prefix, of the middle, output) of one text."""
    u = Units(np.frombuffer(text, np.uint8), c.block)
    h1, h2, h3, h4 = draws(doc_id, c.seed)
    if not text or PREFIX in text or SUFFIX in text or MIDDLE in text or h3 % 100 >= 100 - c.plain:
        return u.n, "plain", None, None, text
    one, two = sorted((h1 % (u.n + 1), h2 % (u.n + 1)))
    (i, ci), (j, cj) = u.cut(one), u.cut(two)
    prefix, middle, suffix = text[:i], text[i:j], text[j:]
    if h4 % 100 < c.spm:
        return u.n, "spm", ci, cj - ci, b"".join((SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle))
    return u.n, "psm", ci, cj - ci, b"".join((PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle))


def restore_text(output: bytes, form: str) -> bytes:
    """The text that ``output`` was made from. No mark can arise across a seam, so the first ones found are the right ones."""
    if form == "plain":
        return output
    lead, then = (PREFIX, SUFFIX) if form == "psm" else (SUFFIX, PREFIX)
    a, rest = output[len(lead):].split(then, 1)
    b, middle = rest.split(MIDDLE, 1)
    return a + middle + b if form == "psm" else b + middle + a


def fill_in_middle(docs: DataFrame, c: Config = Config()) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output``: one row a row, map-only.

    ``form`` is ``plain`` (the text as it is), ``psm`` (prefix, suffix, middle) or ``spm`` (suffix, prefix, middle). An empty text,
    one that holds a mark, and a drawn share stay plain. Null text counts as empty. The draws hang on the
    id alone, so rows that repeat an id with the same text give the same row; a null id draws as an empty one. Other columns are
    ignored. Memory: some four times a text's bytes beside the text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for at in range(0, big.num_rows, 256):
                b = big.slice(at, 256)
                got = [transform_text(t or b"", i, c) for t, i in zip(b.column("text").to_pylist(), b.column("doc_id").to_pylist())]
                n, form, pre, mid, out = zip(*got)
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(n, pa.int64()), pa.array(form, pa.string()), pa.array(pre, pa.int64()), pa.array(mid, pa.int64()),
                                                  pa.array(out, pa.binary())], names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string").cast("binary").alias("text"))
    made = rows.mapInArrow(run, "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output binary")
    return made.withColumn("output", F.col("output").cast("string"))


def restore(made: DataFrame) -> DataFrame:
    """``made`` with ``text``, rebuilt from its ``output`` and ``form`` alone. Map-only."""
    names = [*made.columns, "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for at in range(0, big.num_rows, 256):
                b = big.slice(at, 256)
                text = [restore_text(o, f) for o, f in zip(b.column("output").cast(pa.binary()).to_pylist(), b.column("form").to_pylist())]
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(text, pa.binary()).cast(pa.string())], names=names)

    return made.mapInArrow(run, T.StructType([*made.schema.fields, T.StructField("text", T.StringType())]))
