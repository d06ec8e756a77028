"""Suffix-array repetition: longest-common-prefix intervals over a text's words.

The suffix array of a batch of texts is built by prefix doubling (ranks of runs of 1, 2, 4, ...
words; a run that is already unique drops out), common prefixes of neighbours come from the
stored ranks, and a span that also stands elsewhere in its own text is repeated.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patchprofile.llm.common import word_hashes

WINDOW = 8


@dataclass(frozen=True)
class Limits:
    """``min_repeat``: words of the shortest repeat that counts. A text of at least ``min_words`` words fails when repeated
    spans cover more than ``max_covered`` of its words (the base rule lets 0.30 pass), or when its longest repeat has
    more than ``max_longest`` words, however long the text is."""

    min_repeat: int = 8
    min_words: int = 20
    max_covered: float = 0.15
    max_longest: int = 100


def repeats(codes: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """For each word position, the longest run from there that also begins elsewhere in the same text.

    ``codes``: an integer per word; ``doc``: the text's number, ascending. Runs never cross texts.
    """
    n = len(codes)
    out = np.zeros(n, np.int64)
    if n < 2:
        return out
    # rank of every (text, word): equal ranks = equal first word in one text
    order = np.lexsort((codes, doc))
    new = np.empty(n, bool)
    new[0] = True
    new[1:] = (codes[order[1:]] != codes[order[:-1]]) | (doc[order[1:]] != doc[order[:-1]])
    starts = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    rank = np.empty(n, np.int64)
    rank[order] = starts
    last = np.empty(n, bool)  # the text's end: a longer run from here would leave the text
    last[:-1], last[-1] = doc[1:] != doc[:-1], True
    end = np.flatnonzero(last)
    left = np.repeat(end, np.diff(np.concatenate([[-1], end]))) - np.arange(n) + 1  # words up to the text's end
    single = np.concatenate([new[1:], [True]]) & new
    open_at = order[~single]  # positions (in suffix order) whose run isn't unique yet
    levels = [rank.copy()]
    step = 1
    while len(open_at):
        nxt = np.where(left[open_at] > step, rank[np.minimum(open_at + step, n - 1)], -1)
        here = rank[open_at]
        sub = np.lexsort((nxt, here))
        pos, a, b = open_at[sub], here[sub], nxt[sub]
        first = np.empty(len(pos), bool)
        first[0] = True
        first[1:] = a[1:] != a[:-1]
        fresh = first.copy()
        fresh[1:] |= b[1:] != b[:-1]
        idx = np.arange(len(pos))
        group = np.maximum.accumulate(np.where(first, idx, 0))
        run = np.maximum.accumulate(np.where(fresh, idx, 0))
        rank[pos] = a + (run - group)
        # suffixes of one text differ in length, so doubling ends with all ranks unique
        levels.append(rank.copy())
        alone = fresh & np.concatenate([fresh[1:], [True]])
        open_at = pos[~alone]
        step *= 2
    sa = np.empty(n, np.int64)
    sa[rank] = np.arange(n)
    i, j = sa[:-1].copy(), sa[1:].copy()
    lcp = np.zeros(n - 1, np.int64)
    live = np.flatnonzero(doc[i] == doc[j])
    for k in range(len(levels) - 1, -1, -1):
        width = 1 << k
        a, b = i[live], j[live]
        # a rank at level k is shared only by runs of full length 2^k
        ok = (a < n) & (b < n)
        ok[ok] = (left[a[ok]] >= width) & (left[b[ok]] >= width)
        ok[ok] = levels[k][a[ok]] == levels[k][b[ok]]
        hit = live[ok]
        lcp[hit] += width
        i[hit] += width
        j[hit] += width
        # a run that reached its text's end can't go on
        live = live[~ok | ((i[live] < n) & (j[live] < n))]
        inside = (left[sa[:-1][live]] > lcp[live]) & (left[sa[1:][live]] > lcp[live])
        live = live[inside]
    out[sa[:-1]] = lcp
    out[sa[1:]] = np.maximum(out[sa[1:]], lcp)
    return out


def covered(runs: np.ndarray, least: int, cap: int | None = None) -> np.ndarray:
    """Positions inside the union of the spans [i, i + runs[i]) with runs[i] >= least (span length at most ``cap``)."""
    n = len(runs)
    add = np.zeros(n + 1, np.int64)
    at = np.flatnonzero(runs >= least)
    size = runs[at] if cap is None else np.minimum(runs[at], cap)
    np.add.at(add, at, 1)
    np.add.at(add, at + size, -1)
    return np.cumsum(add[:-1]) > 0


SCHEMA = ("doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
          "base_failed boolean, kept boolean, covered_words bigint, longest_repeat bigint")
_SYMBOLS = [x.encode() for x in "#*$%&|<>"]
_SPACES = [bytes([x]) for x in (0x20, *range(0x09, 0x0E))]


def _lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    if b"\n" not in text:
        return 0
    full = [x for x in text.split(b"\n") if x.split()]
    return len(full) - len(set(full))


def score(batch_texts: list[bytes], limits: Limits) -> dict[str, np.ndarray]:
    """The columns of ``repetition`` for a few texts."""
    words = [t.split() for t in batch_texts]
    n = np.array([len(w) for w in words], np.int64)
    codes = word_hashes([x for w in words for x in w])
    _, codes = np.unique(codes, return_inverse=True)
    doc = np.repeat(np.arange(len(n)), n)
    runs = repeats(codes, doc)
    add = lambda mask: np.bincount(doc[mask], minlength=len(n)).astype(np.int64)
    window = add(covered(runs, WINDOW, WINDOW))
    cover = add(covered(runs, limits.min_repeat))
    longest = np.zeros(len(n), np.int64)
    np.maximum.at(longest, doc, runs)
    longest[longest < limits.min_repeat] = 0
    base = (n < 20) | (100 * window > 30 * n)
    bad = (n >= limits.min_words) & ((cover > limits.max_covered * n) | (longest > limits.max_longest))
    return {"n_words": n, "word_chars": np.array([len(t.decode("utf-8")) - sum(map(t.count, _SPACES)) for t in batch_texts], np.int64),
            "n_symbols": np.array([sum(map(t.count, _SYMBOLS)) for t in batch_texts], np.int64),
            "n_dup_lines": np.array([_lines(t) for t in batch_texts], np.int64), "n_repeat_words": window,
            "base_failed": base, "kept": ~base & ~bad, "covered_words": cover, "longest_repeat": longest}


def repetition(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """One row per document: base counts, ``covered_words`` (words inside repeated spans of at least ``limits.min_repeat``
    words), ``longest_repeat`` and the verdict ``kept``.

    Null or empty text: all counts 0, base_failed, not kept. Repeated rows are judged each for
    itself; other columns are ignored. Map-only: no shuffle.
    """
    names = [f.split()[0] for f in SCHEMA.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [x or b"" for x in b.column("text").to_pylist()]
            at = 0
            while at < len(got):  # about 1 MB of text at a time
                to, size = at, 0
                while to < len(got) and (to == at or size + len(got[to]) < 1 << 20):
                    size += len(got[to])
                    to += 1
                cols = score(got[at:to], limits)
                yield pa.RecordBatch.from_arrays([b.column("doc_id").slice(at, to - at), *(pa.array(cols[c]) for c in names[1:])], names=names)
                at = to

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("text")).mapInArrow(run, SCHEMA)


def repeated_spans(text: str | None, min_repeat: int = 8) -> list[tuple[int, int]]:
    """The union of a text's repeated spans as (first word, one past the last word)."""
    words = (text or "").encode().split()
    if not words:
        return []
    _, codes = np.unique(word_hashes(words), return_inverse=True)
    mask = np.concatenate([[False], covered(repeats(codes, np.zeros(len(words), np.int64)), min_repeat), [False]])
    edge = np.flatnonzero(mask[1:] != mask[:-1])
    return list(zip(edge[::2].tolist(), edge[1::2].tolist()))
