"""Source divergence audit: how far the sources of a language differ in the terms they use.

1. Inside a task the word starts of an Arrow text buffer become pointers. They are sorted by multikey
   quicksort, with eight bytes as one character: every slice is sorted by the eight bytes at its depth, and the pointers
   that agree there are a slice of the next depth. Runs of equal words give each term's occurrences
   by source and the number of documents that hold it.
2. Shards are added up by (language, term, source); terms in too few documents of their language go.
3. A term's smoothed share of a source is an integer number of billionths. Sources are compared over all kept
   terms: what absent terms add is known from the sources' totals, and where two sources both have a term a
   block of terms is compared at once, so that no pair of sources is emitted per term.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from patchprofile.llm.common import materialize


@dataclass(frozen=True)
class Config:
    """``least_docs``: a term of a language is kept from this many of its documents on; ``smooth``: what every
    count gains; ``scale``: the unit of a share; ``top``: the ranks of telling terms a source reports.
    ``shard``: bytes of text sorted at once; ``cells``: terms x sources compared at once; ``rows``: rows a task hands on at once."""

    least_docs: int = 30
    smooth: int = 5
    scale: int = 1_000_000_000
    top: int = 50
    shard: int = 2 << 20
    cells: int = 2_000_000
    rows: int = 1 << 15


#: Bytes of a term: letters A-Z and a-z, and every byte of a character beyond ASCII.
_IN_TERM = np.zeros(256, bool)
_IN_TERM[65:91] = _IN_TERM[97:123] = _IN_TERM[128:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Keeps the first n bytes of eight, n from 0 to 8.
_FIRST = np.array([0] + [(1 << 64) - (1 << (64 - 8 * n)) for n in range(1, 9)], np.uint64)


def word_starts(buf: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and length of every term of ``buf``; ``cuts`` are the places where a text begins (no term runs over one)."""
    flag = np.zeros(len(buf) + 2, bool)
    flag[1:-1] = _IN_TERM[buf]
    begin, end = flag[1:] & ~flag[:-1], flag[:-1] & ~flag[1:]
    inner = cuts[(cuts > 0) & (cuts < len(buf))]
    inner = inner[flag[inner] & flag[inner + 1]]
    begin[inner] = end[inner] = True
    kind = _whole(len(buf))
    at = np.flatnonzero(begin).astype(kind)
    return at, np.flatnonzero(end).astype(kind) - at


def _whole(n: int) -> type:
    """The integers that places of ``n`` bytes are held in."""
    return np.int32 if n < 1 << 30 else np.int64


def sort_words(low: np.ndarray, at: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pointers in byte order of their words, and for every place of that order whether it begins a run of an equal word.

    ``low`` is padded with eight bytes. Slices of one pointer, or of words that ended, are not looked at again.
    """
    eight = np.ndarray((len(low) - 7,), ">u8", low, 0, (1,))

    def key(p: np.ndarray | slice, depth: int) -> np.ndarray:
        return eight[at[p] + depth].astype(np.uint64) & _FIRST[np.minimum(size[p] - depth, 8)]

    kind = _whole(len(low))
    order = np.argsort(key(slice(None), 0)).astype(kind)
    fresh = np.zeros(len(at), bool)
    place, part, depth = np.arange(len(at), dtype=kind), np.zeros(len(at), kind), 0
    while len(place):
        p = order[place]
        k = key(p, depth)
        if depth:
            by = np.lexsort((k, part))
            p, k = p[by], k[by]
            order[place] = p
        head = np.ones(len(place), bool)
        head[1:] = (k[1:] != k[:-1]) | (part[1:] != part[:-1])
        fresh[place] = head
        run = np.cumsum(head, dtype=kind) - 1
        # eight equal bytes: the next depth's slices (a word that ends there has the empty rest, which is least)
        more = (np.bincount(run)[run] > 1) & (size[p] - depth >= 8)
        place, part, depth = place[more], run[more], depth + 8
    return order, fresh


def shard_terms(buf: np.ndarray, cuts: np.ndarray, group: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """Terms of the texts that begin at ``cuts`` of ``buf``, each with its ``group`` number: (term, group, occurrences, documents)."""
    at, size = word_starts(buf, cuts)
    low = np.concatenate([_LOWER[buf], np.zeros(8, np.uint8)])
    order, fresh = sort_words(low, at, size)
    at, size = at[order], size[order]
    # documents: one entry for every (run, document)
    both = (np.cumsum(fresh) - 1) * len(cuts)
    both += np.searchsorted(cuts, at, "right") - 1
    both.sort()
    head = np.flatnonzero(np.r_[len(both) > 0, both[1:] != both[:-1]][: len(both)])
    pairs, times = both[head], np.diff(np.r_[head, len(both)])
    run_of, of = np.divmod(pairs, len(cuts))
    cell, where = np.unique(run_of * (int(group.max(initial=0)) + 1) + group[of], return_inverse=True)
    n, docs = np.bincount(where, times, len(cell)).astype(np.int64), np.bincount(where, minlength=len(cell))
    run_of, of = np.divmod(cell, int(group.max(initial=0)) + 1)
    first = np.flatnonzero(fresh)
    return _take(low, at[first], size[first], run_of), of, n, docs


def _take(low: np.ndarray, at: np.ndarray, size: np.ndarray, which: np.ndarray) -> pa.Array:
    """The words themselves as a binary Arrow array."""
    s = size[which]
    ends = np.concatenate([[0], np.cumsum(s)])
    data = low[np.repeat(at[which] - ends[:-1], s) + np.arange(ends[-1])]
    return pa.Array.from_buffers(pa.large_binary(), len(s), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(data)])


def _pieces(buf: np.ndarray, limit: int) -> Iterator[np.ndarray]:
    """One very long text cut between terms; a term longer than ``limit`` stays whole."""
    at = 0
    while at < len(buf):
        end = min(at + limit, len(buf))
        while end < len(buf) and _IN_TERM[buf[end]] and _IN_TERM[buf[end - 1]]:
            end += 1
        yield buf[at:end]
        at = end


def shards(docs: DataFrame, c: Config = Config()) -> DataFrame:
    """``lang, source, term, n, docs`` of every shard: occurrences, and rows that hold the term. Map-only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            pair = pa.StructArray.from_arrays([b.column("lang"), b.column("source")], ["lang", "source"])
            size = pa.compute.binary_length(b.column("text")).to_numpy(zero_copy_only=False)
            ends = np.cumsum(size)
            lo = 0
            while lo < len(size):
                base = ends[lo] - size[lo]
                hi = max(lo + 1, int(np.searchsorted(ends, base + c.shard, "right")))
                for found in _shard(b.column("text").slice(lo, hi - lo), pair.slice(lo, hi - lo), c.shard):
                    yield from (found.slice(at, c.rows) for at in range(0, found.num_rows, c.rows))
                lo = hi

    null = lambda x: F.coalesce(F.col(x).cast("string"), F.lit(""))
    rows = docs.select(null("lang").alias("lang"), null("source").alias("source"), null("text").cast("binary").alias("text"))
    found = rows.mapInArrow(run, "lang string, source string, term binary, n bigint, docs bigint")
    return found.withColumn("term", F.col("term").cast("string"))


def _shard(text: pa.Array, pair: pa.StructArray, limit: int) -> Iterator[pa.RecordBatch]:
    text = text.cast(pa.large_binary())
    offsets = np.frombuffer(text.buffers()[1], np.int64)[text.offset : text.offset + len(text) + 1]
    data = text.buffers()[2]
    buf = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    keys = pa.array([f"{len(a)}:{a}{s}" for a, s in zip(pair.field("lang").to_pylist(), pair.field("source").to_pylist())]).dictionary_encode()
    group = keys.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    first = np.unique(group, return_index=True)[1]
    if len(text) == 1 and len(buf) > limit:
        parts = [shard_terms(x, np.zeros(1, np.int64), group) for x in _pieces(buf, limit)]
        table = pa.table({"term": pa.chunked_array([p[0] for p in parts]), "n": np.concatenate([p[2] for p in parts])}).group_by("term").aggregate([("n", "sum")])
        term, n = table["term"].combine_chunks(), table["n_sum"].to_numpy()
        of, docs = np.zeros(len(n), np.int64), np.ones(len(n), np.int64)
    else:
        term, of, n, docs = shard_terms(buf, (offsets[:-1] - offsets[0]).astype(np.int64), group)
    name = pa.array(first[of])
    yield pa.RecordBatch.from_arrays([pair.field("lang").take(name), pair.field("source").take(name), term.cast(pa.binary()), pa.array(n, pa.int64()), pa.array(docs, pa.int64())],
                                     names=["lang", "source", "term", "n", "docs"])


def term_counts(docs: DataFrame, c: Config = Config()) -> DataFrame:
    """``lang, term, source, n`` (occurrences), ``total`` (in the language), ``first`` (one row of each term) of the kept terms."""
    added = shards(docs, c).groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    # a window over one term holds a row a source
    w = Window.partitionBy("lang", "term")
    seen = added.select("lang", "term", "source", "n", F.sum("docs").over(w).alias("in_docs"), F.sum("n").over(w).alias("total"),
                        (F.min("source").over(w) == F.col("source")).alias("first"))
    return seen.where(F.col("in_docs") >= c.least_docs).drop("in_docs")


def _share(count: Column, total: Column, terms: Column, c: Config) -> Column:
    """1 + floor(scale * (count + smooth) / (total + smooth * terms)), in whole numbers of 38 digits."""
    wide = "decimal(38,0)"
    up = (count + c.smooth).cast("decimal(27,0)") * F.lit(c.scale).cast("decimal(10,0)")
    return F.lit(1) + F.call_function("div", up.cast(wide), (total + c.smooth * terms).cast(wide)).cast("long")


def _both(rows: DataFrame, c: Config) -> DataFrame:
    """``lang, a, b, both`` for pairs of sources with a term in common: what their common terms add to the sum
    of differences beyond what each term adds by itself. ``rows``: lang, term, source, p, z (share of an absent term)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _blocks(batches, c.cells):
            a, b, s, lang = _block_sums(t)
            yield pa.RecordBatch.from_arrays([lang, a, b, s], names=["lang", "a", "b", "both"])

    dealt = rows.select("lang", "term", "source", "p", "z").repartition("lang", "term").sortWithinPartitions("lang", "term")
    sums = dealt.mapInArrow(run, "lang string, a string, b string, both bigint")
    return sums.groupBy("lang", "a", "b").agg(F.sum("both").alias("both"))


def _blocks(batches: Iterator[pa.RecordBatch], cells: int) -> Iterator[pa.Table]:
    """Tables of one language and whole terms, of at most about ``cells`` terms x sources."""
    rest: pa.Table | None = None
    for b in batches:
        t = pa.Table.from_batches([b]) if rest is None else pa.concat_tables([rest, pa.Table.from_batches([b])])
        # the last term may go on in the next batch
        new = _changes(t)
        cut = int(new[-1]) if len(new) else 0
        done, rest = t.slice(0, cut), t.slice(cut)
        yield from _languages(done, cells)
    if rest is not None:
        yield from _languages(rest, cells)


def _changes(t: pa.Table) -> np.ndarray:
    """The rows at which another (lang, term) begins."""
    if t.num_rows == 0:
        return np.zeros(0, np.int64)
    out = np.ones(t.num_rows, bool)
    if t.num_rows > 1:
        pc = pa.compute
        out[1:] = np.logical_or(*(pc.not_equal(t[x].slice(1), t[x].slice(0, t.num_rows - 1)).to_numpy() for x in ("lang", "term")))
    return np.flatnonzero(out)


def _languages(t: pa.Table, cells: int) -> Iterator[pa.Table]:
    new = _changes(t)
    at = 0
    while at < len(new):
        lang = t["lang"][int(new[at])]
        end, sources = at, set()
        while end < len(new):
            lo, hi = int(new[end]), int(new[end + 1]) if end + 1 < len(new) else t.num_rows
            grown = sources.union(t["source"].slice(lo, hi - lo).to_pylist())
            if end > at and (t["lang"][lo] != lang or len(grown) * (end + 1 - at) > cells):
                break
            sources, end = grown, end + 1
        lo, hi = int(new[at]), int(new[end]) if end < len(new) else t.num_rows
        yield t.slice(lo, hi - lo)
        at = end


def _block_sums(t: pa.Table) -> tuple[pa.Array, pa.Array, pa.Array, pa.Array]:
    code = t["source"].combine_chunks().dictionary_encode()
    names, col = code.dictionary, code.indices.to_numpy(zero_copy_only=False)
    row = t["term"].combine_chunks().dictionary_encode().indices.to_numpy(zero_copy_only=False)
    p, z = t["p"].to_numpy(), t["z"].to_numpy()
    zero = np.zeros(len(names), np.int64)
    zero[col] = z
    d = np.tile(zero, (int(row.max()) + 1, 1))
    d[row, col] = p
    ends, sums = [], []
    for i in range(len(names) - 1):
        x, y = d[:, i : i + 1], d[:, i + 1 :]
        zx, zy = zero[i], zero[i + 1 :]
        # 0 where either source lacks the term
        sums.append((np.abs(x - y) - np.abs(x - zy) - np.abs(zx - y)).sum(axis=0) + len(d) * np.abs(zx - zy))
        ends.append(np.arange(i + 1, len(names)))
    a = np.repeat(np.arange(len(names) - 1), [len(e) for e in ends]) if ends else np.zeros(0, np.int64)
    b = np.concatenate(ends) if ends else np.zeros(0, np.int64)
    s = np.concatenate(sums) if sums else np.zeros(0, np.int64)
    lang = pa.repeat(t["lang"][0], len(a))
    return names.take(pa.array(a)), names.take(pa.array(b)), pa.array(s, pa.int64()), lang


def divergence(docs: DataFrame, c: Config = Config()) -> DataFrame:
    """``lang, source, part, item, value, rank``.

    Part ``pair``: for each other source of the language the summed difference of the two sources' shares over all kept
    terms (0 where none is kept). Part ``term``: the ``top`` kept terms that the source has and uses more than its language
    does, by that difference. Ranks from 1, by value descending and item ascending in UTF-8.

    Null text, lang and source count as ''. Rows that repeat a doc_id are documents of their own; other columns are ignored.
    A source without any term still has its pairs; a language of one source has none. An empty table gives no row.
    Memory of a task: some twenty times ``shard`` bytes (a longer text is sorted in pieces), and the square of a
    language's sources, of which the result has one row each.
    """
    kept = materialize(term_counts(docs, c), "divergence-terms")
    null = lambda x: F.coalesce(F.col(x).cast("string"), F.lit("")).alias(x)
    groups = docs.select(null("lang"), null("source")).distinct()
    of_source = kept.groupBy("lang", "source").agg(F.sum("n").alias("n_source"))
    of_lang = kept.groupBy("lang").agg(F.sum("n").alias("n_lang"), F.count(F.when(F.col("first"), 1)).alias("terms"))
    stats = (groups.join(of_source, ["lang", "source"], "left").join(of_lang, "lang", "left")
             .select("lang", "source", *(F.coalesce(x, F.lit(0)).alias(x) for x in ("n_source", "n_lang", "terms"))))
    stats = stats.withColumn("z", F.when(F.col("terms") > 0, _share(F.lit(0), F.col("n_source"), F.col("terms"), c)).otherwise(F.lit(0)))
    stats = materialize(stats, "divergence-groups")

    rows = kept.join(stats, ["lang", "source"])
    rows = materialize(rows.select("lang", "term", "source", _share(F.col("n"), F.col("n_source"), F.col("terms"), c).alias("p"), "z",
                                   _share(F.col("total"), F.col("n_lang"), F.col("terms"), c).alias("q")), "divergence-shares")

    # a source's own terms against every other source's share of an absent term
    levels = rows.groupBy("lang", "source", "p", "z").agg(F.count(F.lit(1)).alias("m"))
    other = stats.select("lang", F.col("source").alias("item"), F.col("z").alias("zo"))
    gap = F.abs(F.col("p") - F.col("zo")) - F.abs(F.col("z") - F.col("zo"))
    alone = levels.join(other, "lang").where("source <> item").groupBy("lang", "source", "item").agg(F.sum(F.col("m") * gap).alias("v"))
    both = _both(rows, c)
    pairs = stats.select("lang", "source", "z", "terms").join(other, "lang").where("source <> item")
    parts = (pairs.select("lang", "source", "item", (F.col("terms") * F.abs(F.col("z") - F.col("zo"))).alias("v"))
             .unionByName(alone).unionByName(alone.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "v"))
             .unionByName(both.select("lang", F.col("a").alias("source"), F.col("b").alias("item"), F.col("both").alias("v")))
             .unionByName(both.select("lang", F.col("b").alias("source"), F.col("a").alias("item"), F.col("both").alias("v"))))
    pair = parts.groupBy("lang", "source", "item").agg(F.sum("v").alias("value"))
    w = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pair = pair.select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(w).alias("rank"))
    term = rows.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    term = term.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= c.top)
    return pair.unionByName(term)
