"""Benchmark decontamination: size-partitioned MinHash containment search.

Test items are short, documents long, so a whole document's MinHash says little about an
item. Items are parted by size into classes [m, 2m) of five-word shingles, and for each class every
document into overlapping windows of 2m..4m shingles, so that a window that holds an
item resembles it at a rate known from the class. The item and the window meet when they
agree in any one of ``samples`` minima; every meeting is then confirmed on exact shingles.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patchprofile.llm.common import materialize, running, shingles, word_hashes


@dataclass(frozen=True)
class Config:
    """``percent``: an item is found in a document that holds this share of its distinct shingles. A window with
    80 % of an item of its class resembles it by 0.19 at least and misses it in all 64 minima with
    probability 2e-6. ``block``: shingles of items broadcast at a time (8 bytes each)."""

    words: int = 5
    percent: int = 80
    samples: int = 64
    block: int = 1_000_000


def _parameters(samples: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(987_651)
    return (rng.integers(0, 1 << 31, samples, dtype=np.uint32) << np.uint32(1)) | np.uint32(1), rng.integers(0, 1 << 32, samples, dtype=np.uint32)


_NONE = np.zeros(0, np.uint64)


class Items:
    """A block of test items: their shingle sets, and per size class a table sample minimum -> items."""

    def __init__(self, items: list[tuple[int, list[int]]], c: Config):
        self.c = c
        self.a, self.b = _parameters(c.samples)
        self.ids = [i for i, _ in items]
        self.sets = [np.array(s, np.int64).view(np.uint64) for _, s in items]
        self.tag = np.arange(c.samples, dtype=np.uint64)[:, None] << np.uint64(32)
        by: dict[int, list[int]] = {}
        for k, s in enumerate(self.sets):
            by.setdefault(int(math.log2(len(s))), []).append(k)
        self.classes = {m: self._table(by[m]) for m in sorted(by)}

    def _table(self, members: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sorted (sample, minimum) keys, their items, and a filter on the minima's low bits for a fast no."""
        cuts = np.cumsum([0, *(len(self.sets[k]) for k in members[:-1])])
        mins = self._minima(np.concatenate([self.sets[k] for k in members]), cuts)
        bits = 1 << max(12, int(math.log2(len(members))) + 7)
        may = np.zeros((self.c.samples, bits), bool)
        may[np.arange(self.c.samples)[:, None], mins & np.uint32(bits - 1)] = True
        key = (mins | self.tag).ravel()
        order = np.argsort(key, kind="stable")
        return key[order], np.tile(np.array(members), self.c.samples)[order], may

    def _minima(self, s: np.ndarray, cuts: np.ndarray) -> np.ndarray:
        """samples x blocks: minima over the blocks of ``s`` that begin at ``cuts``."""
        low = (s >> np.uint64(32)).astype(np.uint32)
        out = np.empty((len(self.a), len(cuts)), np.uint32)
        for k in range(len(self.a)):
            out[k] = np.minimum.reduceat(low * self.a[k] + self.b[k], cuts)
        return out

    def search(self, docs: list[np.ndarray]) -> list[tuple[int, int, int, int]]:
        """(place in ``docs``, item, shared shingles, item's shingles) for the items found in shingle sequences."""
        docs_at = [i for i, s in enumerate(docs) if len(s)]
        if not docs_at or not self.classes:
            return []
        size = 1 << (next(iter(self.classes)) + 1)
        # blocks of twice the class's least size, never across documents
        count = np.array([-(-len(docs[i]) // size) for i in docs_at])
        begin = np.cumsum([0, *(len(docs[i]) for i in docs_at[:-1])])
        inner = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        mins = self._minima(np.concatenate([docs[i] for i in docs_at]), np.repeat(begin, count) + inner * size)
        owner = np.repeat(np.arange(len(docs_at)), count)
        met: set[tuple[int, int]] = set()
        for m in range(next(iter(self.classes)), max(self.classes) + 1):
            if m in self.classes:
                met |= self._meet(m, mins, owner)
            cuts = np.flatnonzero(inner % 2 == 0)  # blocks of the next class: two of this one's
            mins, owner, inner = np.minimum.reduceat(mins, cuts, axis=1), owner[cuts], inner[cuts] // 2
        out, sets = [], {}
        for d, k in sorted(met):
            i = docs_at[d]
            if i not in sets:
                sets = {i: np.unique(docs[i])}
            item = self.sets[k]
            n = int(np.isin(item, sets[i], assume_unique=True).sum())
            if 100 * n >= self.c.percent * len(item):
                out.append((i, self.ids[k], n, len(item)))
        return out

    def _meet(self, m: int, mins: np.ndarray, owner: np.ndarray) -> set[tuple[int, int]]:
        """(document, item) pairs that agree in a sample's minimum over a window: a block and the next of its document."""
        win = mins.copy()
        same = np.flatnonzero(owner[1:] == owner[:-1])
        win[:, same] = np.minimum(mins[:, same], mins[:, same + 1])
        keys, who, may = self.classes[m]
        met: set[tuple[int, int]] = set()
        mask = np.uint32(may.shape[1] - 1)
        for k in range(len(win)):
            at = np.flatnonzero(may[k][win[k] & mask])
            if len(at):
                key = win[k][at] | self.tag[k]
                lo, hi = np.searchsorted(keys, key), np.searchsorted(keys, key, side="right")
                for w, x, y in zip(at, lo, hi):
                    met.update((int(owner[w]), int(i)) for i in who[x:y])
        return met


def item_sets(benchmark: DataFrame, c: Config, null_ids: bool = False) -> DataFrame:
    """``item_id, set, n``: distinct five-word shingles. Items with fewer words have none and match nothing;
    items without an id can't be named and are left out unless ``null_ids``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = []
            for x in b.column("text"):
                w = (x.as_py() or b"").lower().split()
                sets.append(np.unique(shingles(word_hashes(w), c.words)).view(np.int64) if len(w) >= c.words else np.zeros(0, np.int64))
            yield pa.RecordBatch.from_arrays([b.column("item_id"), pa.array(sets, pa.list_(pa.int64())), pa.array([len(s) for s in sets], pa.int64())], names=["item_id", "set", "n"])

    rows = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(run, "item_id bigint, set array<bigint>, n bigint").where("n > 0" if null_ids else "n > 0 AND item_id IS NOT NULL")


def _blocks(benchmark: DataFrame, c: Config, null_ids: bool = False) -> Iterator[Broadcast]:
    """The items in blocks of at most ``c.block`` shingles (plus one item), broadcast one after the other."""
    order = ["item_id", "n"] if null_ids else ["item_id"]
    placed = materialize(running(item_sets(benchmark, c, null_ids), order, ["n"], "items").withColumn("blk", F.floor(F.col("n_before") / c.block)), "item-blocks")
    last = placed.agg(F.max("blk")).first()[0]
    for k in range(0 if last is None else last + 1):
        # at most c.block shingles plus one item: the stated bound of this collect and broadcast
        block = [(r.item_id, r["set"]) for r in placed.where(F.col("blk") == k).orderBy("item_id").collect()]
        yield benchmark.sparkSession.sparkContext.broadcast(block)


def _shingled(column: pa.Array, c: Config) -> list[np.ndarray]:
    words = [(x.as_py() or b"").lower().split() for x in column]
    return [shingles(word_hashes(w), c.words) if len(w) >= c.words else _NONE for w in words]


def find_items(docs: DataFrame, benchmark: DataFrame, c: Config = Config()) -> DataFrame:
    """``doc_id, item_id, shared, n_item`` for each document and test item found in it.

    A-Z lower-cased, words split at ASCII white space. Items go out in blocks of at most ``c.block``
    shingles (plus one item), one pass over the documents for each block, so the broadcast stays
    bounded however many items there are. Null or empty texts and items match nothing; rows that repeat a
    ``doc_id`` or ``item_id`` are searched each for itself; other columns are ignored.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("text"))
    schema = "doc_id bigint, item_id bigint, shared bigint, n_item bigint"
    out = None
    for sent in _blocks(benchmark, c):

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            found = Items(sent.value, c)
            for big in batches:
                for at in range(0, big.num_rows, 64):
                    b = big.slice(at, 64)
                    hits = found.search(_shingled(b.column("text"), c))
                    ids = b.column("doc_id").to_pylist()
                    cols = [[ids[h[0]] for h in hits], *([h[j] for h in hits] for j in (1, 2, 3))]
                    yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in cols], names=["doc_id", "item_id", "shared", "n_item"])

        hits = rows.mapInArrow(run, schema)
        out = hits if out is None else out.unionByName(hits)
    return spark.createDataFrame([], schema) if out is None else out


def contaminated(docs: DataFrame, benchmark: DataFrame, c: Config = Config()) -> DataFrame:
    """One row per document id with a test item in it: ``doc_id, n_items, items`` (sorted ids)."""
    hits = find_items(docs, benchmark, c)
    return hits.groupBy("doc_id").agg(F.countDistinct("item_id").alias("n_items"), F.sort_array(F.collect_set("item_id")).alias("items"))


def clean(docs: DataFrame, benchmark: DataFrame, c: Config = Config()) -> DataFrame:
    """The rows of ``docs`` in which no test item was found, with all their columns.

    Each row is judged by its own text, whatever its ``doc_id`` (null and repeated ids too); items without an id
    count as well. Map-only, one pass for each block of items.
    """
    out = docs
    for sent in _blocks(benchmark, c, null_ids=True):

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            found = Items(sent.value, c)
            for big in batches:
                leaks = np.zeros(big.num_rows, bool)
                for at in range(0, big.num_rows, 64):
                    text = big.column("text").slice(at, 64).cast(pa.binary())
                    leaks[[at + h[0] for h in found.search(_shingled(text, c))]] = True
                yield big.filter(pa.array(~leaks))

        out = out.mapInArrow(run, docs.schema)
    return out
