"""Token-ID output: Parquet list columns with dictionary or delta pages, sorted by document id.

``write_tokens`` encodes whole texts and writes one file per range partition; ``read_tokens``
and ``read_meta`` read the id lists or only the small columns. Spark's own Parquet writer
is used, so files go to any shared store, are committed atomically and carry page indexes.
"""

from __future__ import annotations

import codecs
import string
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patchprofile.llm.common import id_lists, ids_by_piece, one_at_a_time, shuffle_partitions, with_offsets

END_ID = 2
META = ["doc_id", "n_tokens", "start"]

#: White space, as the pre-tokenizer sees it.
_WHITE = "".join(c for c in map(chr, range(0x3001)) if c.isspace())
#: Two white-space characters in a row, one at an end, or the mark that cuts are made at: such a text is not cut.
_CUT = "\x01"
_ODD = f"[{_WHITE}][{_WHITE}]|^[{_WHITE}]|[{_WHITE}]$|{_CUT}"


class Encoder:
    """Ids of whole texts, piece by piece.

    A byte-level tokenizer never joins across a single space or line feed that stands between two other characters, so texts are
    cut before these, every different piece of a batch is encoded once, and pieces are kept within twice ``limit``. Nor does it join
    a letter and the mark behind it, so marks behind letters are cut off too. Texts with white space beside white space or at an end go to the tokenizer whole.
    Equal to encoding the whole text (tested).
    """

    def __init__(self, path: str, limit: int = 120_000):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        self.tok = Tokenizer.from_file(path)
        self.model = self.tok.model
        self.limit = limit
        # two generations: what is met again moves to the young one
        self.kept: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        # the byte-level alphabet, as the library's own pre-tokenizer spells each byte
        cut = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        spell = {i: cut.pre_tokenize_str(chr(i))[0][0] for i in range(128)}
        spell |= {x: cut.pre_tokenize_str(c)[0][0][k] for c in _two_byte() for k, x in enumerate(c.encode())}
        self.spell = "".join(spell.get(x, _LONGER) for x in range(256))
        self.lead = {" ": (self.spell[32], b""), "\n": ("", self.whole("\n")), "": ("", b"")}

    def whole(self, text: str) -> bytes:
        return array("I", self.tok.encode(text, add_special_tokens=False).ids).tobytes()

    def unit(self, p: str) -> bytes:
        """Ids of a piece. Letters behind a space or line feed, or behind neither at a text's start, are one unit of the pre-tokenizer, which
        goes to the library's model directly."""
        lead = p[:1]
        if lead in self.lead:
            word = p[1:]
        else:
            lead, word = "", p
        if not word.isalpha():
            return self.whole(p)
        if not word.isascii():
            word = codecs.charmap_decode(word.encode(), "strict", self.spell)[0]
            if _LONGER in word:  # the spelling covers characters of two bytes
                return self.whole(p)
        before, first = self.lead[lead]
        return first + array("I", [x.id for x in self.model.tokenize(before + word)]).tobytes()

    def look_up(self, found: pa.StringArray) -> pa.ListArray:
        if len(self.kept) > self.limit:
            self.kept, self.old = {}, self.kept
        pieces = found.to_numpy(zero_copy_only=False).tolist()
        young, old = self.kept, self.old
        out = list(map(young.get, pieces))
        for i, ids in enumerate(out):
            if ids is None:
                p = pieces[i]
                ids = old.get(p)
                if ids is None:
                    ids = self.unit(p)
                if len(p) <= _KEPT:
                    young[p] = ids
                out[i] = ids
        return id_lists(out)

    def units(self, pieces: pa.StringArray) -> pa.ListArray:
        """Ids of pieces. Up to four marks behind letters are a unit by themselves: letters and marks are looked up apart."""
        pc = pa.compute
        core = pc.ascii_rtrim(pieces, _MARKS)
        n = pc.subtract(pc.binary_length(pieces), pc.binary_length(core))
        two = pc.and_(pc.and_(pc.greater(n, 0), pc.less_equal(n, 4)), pc.utf8_is_alpha(pc.ascii_ltrim(core, " \n")))
        marked = pieces.filter(two).to_numpy(zero_copy_only=False).tolist()
        marks = pa.array([p[-k:] for p, k in zip(marked, n.filter(two).to_pylist())], pa.string())
        # a piece's letters, then its marks
        at = two.to_numpy(zero_copy_only=False)
        ends = np.concatenate([[0], np.cumsum(1 + at)])
        order = np.empty(ends[-1], np.int64)
        order[ends[:-1]] = np.arange(len(at))
        order[ends[1:][at] - 1] = len(at) + np.arange(len(marks))
        both = pa.concat_arrays([pc.if_else(two, core, pieces), marks]).take(pa.array(order))
        return ids_by_piece(pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), both), self.look_up)

    def many(self, texts: pa.Array) -> pa.ListArray:
        """Ids of each text (none is null)."""
        pc = pa.compute
        cut = pc.replace_substring(pc.replace_substring(texts, " ", f"{_CUT} "), "\n", f"{_CUT}\n")
        odd = pc.match_substring_regex(texts, _ODD)
        # what is not cut must not be split either
        safe = pc.if_else(odd, "", cut)
        lists = ids_by_piece(pc.split_pattern(safe, _CUT), self.units)
        if not pc.any(odd).as_py():
            return lists
        whole = [self.whole(t) for t in texts.filter(odd).to_pylist()]
        plain = np.frombuffer(b"".join(whole), np.int32)
        every = np.concatenate([lists.flatten().to_numpy(), plain])
        # rows of odd texts take their ids from the end
        n = pc.list_value_length(lists).to_numpy().copy()
        start = np.concatenate([[0], np.cumsum(n)])[:-1]
        at = np.flatnonzero(odd.to_numpy(zero_copy_only=False))
        size = np.array([len(w) // 4 for w in whole], np.int64)
        start[at] = len(every) - len(plain) + np.cumsum(size) - size
        n[at] = size
        ends = np.concatenate([[0], np.cumsum(n)])
        take = np.repeat(start - ends[:-1], n) + np.arange(ends[-1])
        return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(every[take]))


#: ASCII marks, which the pre-tokenizer parts from letters before them (an apostrophe may belong to letters behind it).
_MARKS = string.punctuation.replace("'", "")
#: Stands for bytes of longer characters in a spelling.
_LONGER = "\x00"
#: Characters of the longest piece that is kept.
_KEPT = 64
#: Bytes of text encoded at once.
_BATCH = 2 << 20


def _two_byte() -> list[str]:
    """Characters whose UTF-8 bytes are every lead byte of two and every following byte."""
    return [bytes([lead, follow]).decode() for lead in range(0xC2, 0xE0) for follow in (range(0x80, 0xC0) if lead == 0xC2 else (0x80,))]


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def write_tokens(docs: DataFrame, out: str, tokenizer: str, *, end_id: int = END_ID, encoding: str = "dictionary",
                 row_group_mb: int = 32, page_rows: int = 2_000, keep: tuple[str, ...] = ()) -> None:
    """Encode every whole ``text`` and write ``doc_id, tokens, n_tokens, n_tokens_before, part`` (+ ``keep``) to ``out``.

    Files are in ascending ``doc_id`` order (null ids first; rows with one id by text), cut by a
    range partition. ``tokens`` is a list column with dictionary pages, or with
    ``encoding="delta"`` delta-packed ones; ``doc_id`` and the counters are delta-packed. ``row_group_mb`` and
    ``page_rows`` bound row groups and pages; column and offset indexes are written for all
    columns, so a reader skips pages by ``doc_id`` and never touches ids it was not asked for.
    Null text counts as empty (only the end id). An empty table gives an empty file set.
    """
    if encoding not in ("dictionary", "delta"):
        raise ValueError("encoding is 'dictionary' or 'delta'")
    spark = docs.sparkSession
    keep = tuple(c for c in keep if c not in ("doc_id", "text", "tokens", "n_tokens", "n_tokens_before", "part"))
    rows = (docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), *keep)
            .repartitionByRange(shuffle_partitions(spark), "doc_id").sortWithinPartitions("doc_id", "text")
            .withColumn("part", F.spark_partition_id()))
    names = ["doc_id", "tokens", "n_tokens", "n_tokens_before", "part", *keep]
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    schema = ", ".join(f"`{c}` {dict(tokens='array<int>', n_tokens='bigint', n_tokens_before='bigint').get(c) or kinds[c]}" for c in names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _encoded(batches, encoder(tokenizer), names, end_id)

    w = (rows.mapInArrow(run, schema).write.mode("error")
         .option("parquet.writer.version", "PARQUET_2_0").option("parquet.block.size", row_group_mb << 20)
         .option("parquet.page.row.count.limit", page_rows).option("parquet.dictionary.page.size", 1 << 20).option("compression", "zstd").option("parquet.compression.codec.zstd.level", 1))
    for c in ("doc_id", "n_tokens", "n_tokens_before", *(["tokens.list.element"] if encoding == "delta" else [])):
        w = w.option(f"parquet.enable.dictionary#{c}", "false")
    w.parquet(out)


def _encoded(batches: Iterator[pa.RecordBatch], enc: Encoder, names: list[str], end_id: int) -> Iterator[pa.RecordBatch]:
    """Columns ``names`` of each batch's rows, some bytes of text at a time: a task holds one Spark batch and one slice's ids."""
    total = 0
    for b in one_at_a_time(batches, "text", _BATCH):
        got = _with_ids(b, enc, names, end_id, total)
        del b
        total += pa.compute.sum(got.column("n_tokens")).as_py()
        yield got
        del got


def _with_ids(b: pa.RecordBatch, enc: Encoder, names: list[str], end_id: int, total: int) -> pa.RecordBatch:
    got = enc.many(b.column("text").cast(pa.string()))
    n = pa.compute.list_value_length(got).to_numpy().astype(np.int64) + 1
    ends = np.cumsum(n)
    flat = np.full(ends[-1], end_id, np.int32)
    own = np.ones(len(flat), bool)
    own[ends - 1] = False
    flat[own] = got.flatten().to_numpy()
    lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(flat))
    made = {"tokens": lists, "n_tokens": pa.array(n), "n_tokens_before": pa.array(ends - n + total)}
    return pa.RecordBatch.from_arrays([made[c] if c in made else b.column(c) for c in names], names=names)


def read_meta(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, n_tokens, start`` (ids of all documents before it) without touching the id lists."""
    return _started(spark.read.parquet(path).select("doc_id", "n_tokens", "n_tokens_before", "part")).select(*META)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, n_tokens, start, tokens``."""
    return _started(spark.read.parquet(path).select("doc_id", "tokens", "n_tokens", "n_tokens_before", "part"), path).select(*META, "tokens")


def _started(df: DataFrame, path: str | None = None) -> DataFrame:
    return with_offsets(df, "part", ["n_tokens"]).withColumnRenamed("n_tokens_before", "start")


def checksums(tokens: DataFrame) -> DataFrame:
    """``ids_crc32``: crc32 over a document's ids as little-endian unsigned 32-bit integers."""
    return tokens.select("doc_id", "start", "n_tokens", "tokens").mapInArrow(_checked, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def _checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in one_at_a_time(batches):
        got = _with_crc(b)
        del b
        yield got
        del got


def _with_crc(b: pa.RecordBatch) -> pa.RecordBatch:
    lists = b.column("tokens")
    flat, ends = lists.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False), lists.offsets.to_numpy()
    crc = [zlib.crc32(flat[i:j]) for i, j in zip(ends[:-1].tolist(), ends[1:].tolist())]
    return pa.RecordBatch.from_arrays([b.column("doc_id").cast(pa.int64()), b.column("start"), b.column("n_tokens"), pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])
