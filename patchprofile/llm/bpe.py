"""BPE encoding and decoding from a tokenizer file's own vocabulary and merge ranks.

A word's symbols form a doubly linked list; a priority queue holds the ranks of its neighbouring pairs. The best pair is
joined and its new neighbours are pushed; entries whose symbols have changed since are stale and skipped. Decoding looks ids up
in the vocabulary and joins the strings.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patchprofile.llm.common import by_bytes, id_lists, ids_by_piece


class Merges:
    """The rank of every pair of ids (one number: the left id above ``BITS`` bits), what each rank joins to, and the ids of single characters."""

    BITS = 24

    def __init__(self, model: dict):
        if model["type"] != "BPE" or model.get("dropout") or model.get("byte_fallback") or model.get("unk_token") or model.get("continuing_subword_prefix"):
            raise ValueError("only plain BPE models are supported: no dropout, byte fallback, unknown token or prefix of following parts")
        self.ids: dict[str, int] = model["vocab"]
        if self.ids and max(self.ids.values()) >> self.BITS:
            raise ValueError("the vocabulary is too large")
        self.end: str = model.get("end_of_word_suffix") or ""
        self.whole = bool(model.get("ignore_merges"))
        self.ranks: dict[int, int] = {}
        self.joined: list[int] = []
        for rank, m in enumerate(model["merges"]):
            a, b = m.split(" ") if isinstance(m, str) else m
            self.ranks[self.ids[a] << self.BITS | self.ids[b]] = rank
            self.joined.append(self.ids[a + b])
        self.first = {c: i for c, i in self.ids.items() if len(c) == 1}

    def encode(self, word: str) -> list[int]:
        """Ids of one pre-tokenized word; a character that the vocabulary lacks is left out."""
        if self.whole and word in self.ids:
            return [self.ids[word]]
        if not word:
            return []
        first, bits = self.first, self.BITS
        sym = [first[c] for c in word[:-1] if c in first]
        if (last := self.ids.get(word[-1] + self.end)) is not None:
            sym.append(last)
        n = len(sym)
        rank_of = self.ranks.get
        # the queue: rank, then place, in one number
        heap = []
        for i in range(n - 1):
            if (r := rank_of(sym[i] << bits | sym[i + 1])) is not None:
                heap.append(r << 32 | i)
        if not heap:
            return sym
        heapify(heap)
        joined = self.joined
        prev, nxt = list(range(-1, n - 1)), list(range(1, n + 1))
        nxt[-1] = -1
        while heap:
            top = heappop(heap)
            rank, i = top >> 32, top & 0xFFFFFFFF
            left, j = sym[i], nxt[i]
            # stale: the left symbol is gone or the last one, or the pair is another by now
            if left < 0 or j < 0 or rank_of(left << bits | sym[j]) != rank:
                continue
            one = sym[i] = joined[rank]
            sym[j] = -1
            k = nxt[i] = nxt[j]
            if k >= 0:
                prev[k] = i
                if (r := rank_of(one << bits | sym[k])) is not None:
                    heappush(heap, r << 32 | i)
            h = prev[i]
            if h >= 0 and (r := rank_of(sym[h] << bits | one)) is not None:
                heappush(heap, r << 32 | h)
        return [s for s in sym if s >= 0]


class Codec:
    """Ids of whole texts and back.

    The file's normalizer and pre-tokenizer are run by the library. White space ends every word of the supported ones and is
    dropped, so every different word of a batch is encoded once, and kept within twice ``limit``. Strings of added tokens
    in a text become their ids, as the library does by default.
    """

    def __init__(self, path: str, limit: int = 150_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        if spec.get("decoder") is not None:
            raise ValueError("only tokenizers without a decoder are supported: ids are decoded by joining vocabulary strings")
        if any(t["normalized"] or t["single_word"] or t["lstrip"] or t["rstrip"] for t in spec["added_tokens"]):
            raise ValueError("only added tokens that match as they are written are supported")
        tok = Tokenizer.from_file(path)
        self.normalizer, self.cutter = tok.normalizer, tok.pre_tokenizer
        self.merges = Merges(spec["model"])
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        names = self.merges.ids | self.added
        strings: list[str] = [""] * (max(names.values()) + 1)
        for s, i in names.items():
            strings[i] = s
        self.strings = pa.array(strings, pa.string())
        by_size = sorted(self.added, key=len, reverse=True)
        self.marks = re.compile("(" + "|".join(map(re.escape, by_size)) + ")") if by_size else None
        # letters up to U+00FF and marks that this file's own normalizer and pre-tokenizer lower, keep together and cut as expected
        cut = lambda t: [p for p, _ in self.cutter.pre_tokenize_str(self.normalizer.normalize_str(t))]
        letters = [c for c in map(chr, range(256)) if c.isalpha()]
        self.spelt = {ord(c.lower()): "".join(cut(c)) for c in letters}
        usual = [c for c in letters if cut(f"a{c}b{c}") == ["a" + self.spelt[ord(c.lower())] + "b" + self.spelt[ord(c.lower())]]]
        marks = [c for c in ".,;:!?" if cut(f"ab{c}") == ["ab", c]]
        self.easy = re.compile(f"([{''.join(usual)}]+)([{''.join(marks)}]?)" if usual and marks else "(?!)")
        self.limit = limit
        # white-space words -> ids and pre-tokenized pieces -> ids, each in two generations: what is met again moves to the young one
        self.words: dict[str, bytes] = {}
        self.old_words: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}
        self.old_pieces: dict[str, bytes] = {}

    def _piece(self, piece: str) -> bytes:
        got = self.pieces.get(piece)
        if got is None:
            got = self.old_pieces.get(piece)
            if got is None:
                got = array("I", self.merges.encode(piece)).tobytes()
            if len(piece) <= _KEPT:
                if len(self.pieces) >= self.limit:
                    self.pieces, self.old_pieces = {}, self.pieces
                self.pieces[piece] = got
        return got

    def _plain(self, text: str) -> bytes:
        return b"".join([self._piece(p) for p, _ in self.cutter.pre_tokenize_str(self.normalizer.normalize_str(text))])

    def whole(self, text: str) -> bytes:
        if self.marks is None:
            return self._plain(text)
        parts = self.marks.split(text)  # odd places hold the marks
        return b"".join([array("I", [self.added[p]]).tobytes() if i % 2 else self._plain(p) if p else b"" for i, p in enumerate(parts)])

    def learn(self, words: list[str]) -> list[bytes]:
        """Ids of words without white space. Letters, perhaps before one mark, are cut at sight; the rest is normalized and cut in one call."""
        out = [b""] * len(words)
        hard = []
        for i, w in enumerate(words):
            m = self.easy.fullmatch(w)
            if m is None:
                hard.append(i)
                continue
            core, mark = m.groups()
            core = core.lower()
            got = self._piece(core if core.isascii() else core.translate(self.spelt))
            out[i] = got + self._piece(mark) if mark else got
        if hard:
            plain = self.normalizer.normalize_str(" ".join([words[i] for i in hard]))
            ends = np.cumsum([len(w) + 1 for w in plain.split(" ")])
            cut = self.cutter.pre_tokenize_str(plain)
            word = np.searchsorted(ends, [at for _, (at, _) in cut], "right").tolist()
            for i, (piece, _) in zip(word, cut):
                out[hard[i]] += self._piece(piece)
        return out

    def look_up(self, found: pa.StringArray) -> pa.ListArray:
        """Ids of different words; those met for the first time are learned."""
        words = found.to_numpy(zero_copy_only=False).tolist()
        if len(self.words) > self.limit:
            self.words, self.old_words = {}, self.words
        young, old = self.words, self.old_words
        new, odd = [], {}
        for w in words:
            if w not in young:
                if w in old:
                    young[w] = old[w]
                elif len(w) > _KEPT or _SPACE.search(w) or (self.marks is not None and self.marks.search(w)):
                    odd[w] = self.whole(w)  # too long to keep, white space of other kinds, or a mark
                else:
                    new.append(w)
        if new:
            young.update(zip(new, self.learn(new)))
        return id_lists([odd[w] if w in odd else young[w] for w in words] if odd else [young[w] for w in words])

    def encode(self, texts: pa.Array) -> pa.ListArray:
        """Ids of each text. Any cut at white space is as good as another, so texts are cut at spaces and line feeds only."""
        pc = pa.compute
        return ids_by_piece(pc.split_pattern(pc.replace_substring(texts, "\n", " "), " "), self.look_up)

    def decode(self, ids: pa.ListArray) -> pa.Array:
        """The vocabulary's strings, with a space between two of them (the library's way where a file names no decoder). An
        id that the vocabulary lacks raises."""
        words = self.strings.take(ids.flatten())
        size = pa.compute.list_value_length(ids).fill_null(0).to_numpy()
        ends = pa.array(np.concatenate([[0], np.cumsum(size)]).astype(np.int32))
        return pa.compute.binary_join(pa.ListArray.from_arrays(ends, words), " ")


_SPACE = re.compile(r"\s")
#: Characters of the longest word that is kept.
_KEPT = 64
#: Bytes of text encoded at once.
_BATCH = 4 << 20
_CODECS: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    if path not in _CODECS:
        _CODECS[path] = Codec(path)
    return _CODECS[path]


def encode(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id, ids`` (array of int): one row a row, whole texts, map-only.

    Null and empty texts give no ids. Rows that repeat a doc_id or have none are encoded each for itself; other columns are
    ignored. A text's list and its ids are in memory at once, twice.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        for big in batches:
            for b in by_bytes(big, "text", _BATCH):
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), c.encode(b.column("text").cast(pa.string()))], names=["doc_id", "ids"])

    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, ids array<int>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``doc_id, ids, text``: the decoded text of each row's ids (null ids as none). An id that the vocabulary lacks raises."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        for big in batches:
            for at in range(0, big.num_rows, 256):
                b = big.slice(at, 256)
                text = c.decode(b.column("ids")).cast(pa.string())
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("ids"), text], names=["doc_id", "ids", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id bigint, ids array<int>, text string")
