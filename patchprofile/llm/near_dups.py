"""MinHash near-duplicates with odd sketches.

1. Every text becomes its set of word shingles; equal sets are one node from here on.
2. ``bands x rows`` MinHash samples give the band keys; all samples folded into a parity bitmap
   (bit = hash of sample number and value, flipped once per sample) give the odd sketch: the
   XOR of two sketches has about as many bits as the samples differ.
3. In each band bucket every node meets one pivot; pairs whose sketches differ too much are
   dropped, the others are confirmed on their full sets. That joins nearly every group.
4. What still shares a bucket across different components is compared in bounded blocks, sketches
   first and then full sets; blocks that lie inside one component are left out, and only links come out.
5. Components of all confirmed links.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patchprofile.llm.common import WORD, materialize, mix, running, shingles, word_hashes
from patchprofile.llm.components import components


@dataclass(frozen=True)
class Config:
    """``percent``: link when 100 * shared >= percent * united. With 32 bands of 5 rows a pair at
    0.8 meets in no band with probability 3e-6. ``slack`` is five standard errors of the
    sketch's estimate. ``block`` bounds the shingles in one side of a block comparison. ``broadcast_rows``: up to so many
    texts to be read again are named to every task (some 64 bytes each); beyond, the texts are shuffled to be joined with their names."""

    words: int = 4
    percent: int = 80
    bands: int = 32
    rows: int = 5
    bits: int = 1024
    slack: float = 0.17
    block: int = 200_000
    broadcast_rows: int = 1_000_000


def shingle_set(text: bytes, words: int) -> np.ndarray:
    """Sorted distinct shingle hashes of a text, A-Z lower-cased."""
    return np.unique(shingles(word_hashes(text.lower().split()), words))


class Sketcher:
    def __init__(self, c: Config):
        k = c.bands * c.rows
        rng = np.random.default_rng(20240229)
        self.c = c
        self.a = (rng.integers(0, 1 << 31, k, dtype=np.uint32) << np.uint32(1)) | np.uint32(1)
        self.b = rng.integers(0, 1 << 32, k, dtype=np.uint32)
        self.salt = mix(np.arange(1, k + 1, dtype=np.uint64))
        self.band = mix(np.arange(1, c.bands + 1, dtype=np.uint64) << np.uint64(20))

    def samples(self, s: np.ndarray) -> np.ndarray:
        low = (s >> np.uint64(32)).astype(np.uint32)
        out = np.full(len(self.a), 0xFFFFFFFF, np.uint32)
        for i in range(0, len(low), 4096):
            np.minimum(out, (low[None, i : i + 4096] * self.a[:, None] + self.b[:, None]).min(axis=1), out=out)
        return out

    def bands(self, m: np.ndarray) -> np.ndarray:
        rows = m.reshape(self.c.bands, self.c.rows).astype(np.uint64)
        key = self.band.copy()
        for j in range(self.c.rows):
            key = mix(key ^ rows[:, j]) + np.uint64(j + 1)
        return key.view(np.int64)

    def odd(self, m: np.ndarray) -> bytes:
        bit = (mix(m.astype(np.uint64) ^ self.salt) % np.uint64(self.c.bits)).astype(np.int64)
        return np.packbits((np.bincount(bit, minlength=self.c.bits) & 1).astype(np.uint8)).tobytes()


def most_bits(c: Config) -> int:
    """The largest XOR population count of sketches that pass: expected at similarity percent/100 - slack."""
    differ = 2 * c.bands * c.rows * (1 - c.percent / 100 + c.slack)
    return int(np.ceil(c.bits / 2 * (1 - np.exp(-2 * differ / c.bits))))


def row_key(docs: DataFrame) -> Column:
    """Digest of a row's ``doc_id`` and text: rows share it only when they agree in both."""
    parts = [F.coalesce(F.col("doc_id").cast("long").cast("string"), F.lit("")), F.lit(":"), F.coalesce(F.col("text").cast("string"), F.lit(""))]
    return F.unhex(F.md5(F.concat(*parts)))


def signatures(docs: DataFrame, c: Config, keyed: bool = False) -> DataFrame:
    """``doc_id, n_shingles, node`` (128-bit digest of the set; null if empty), ``bands``, ``sketch``; with ``keyed`` also ``row``, the ``row_key``."""
    schema = "doc_id bigint, n_shingles bigint, node binary, bands array<bigint>, sketch binary" + (", row binary" if keyed else "")
    extra = ["row"] if keyed else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sk = Sketcher(c)
        for big in batches:
            for at in range(0, big.num_rows, 1000):
                b = big.slice(at, 1000)
                n, node, bands, odd = [], [], [], []
                for x in b.column("text"):
                    s = shingle_set(x.as_py() or b"", c.words)
                    n.append(len(s))
                    if len(s):
                        m = sk.samples(s)
                        node.append(xxhash.xxh3_128_digest(s.tobytes()))
                        bands.append(sk.bands(m))
                        odd.append(sk.odd(m))
                    else:
                        node.append(None), bands.append(None), odd.append(None)
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(n, pa.int64()), pa.array(node, pa.binary()),
                                                  pa.array(bands, pa.list_(pa.int64())), pa.array(odd, pa.binary()), *(b.column(x) for x in extra)],
                                                 names=["doc_id", "n_shingles", "node", "bands", "sketch", *extra])

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("text"), *(row_key(docs).alias(x) for x in extra))
    return rows.mapInArrow(run, schema)


def full_sets(docs: DataFrame, wanted: DataFrame, c: Config) -> DataFrame:
    """``node, set`` for the nodes of ``wanted`` (``node, rep``; a written table), made again from the texts of their representatives (``rep``: a ``doc_id``, or a ``row_key``)."""
    schema = "node binary, want binary, set array<bigint>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for at in range(0, big.num_rows, 500):
                b = big.slice(at, 500)
                sets = [shingle_set(x.as_py() or b"", c.words) for x in b.column("text")]
                yield pa.RecordBatch.from_arrays([pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()), b.column("want"),
                                                  pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))], names=["node", "want", "set"])

    rep = row_key(docs) if dict(wanted.dtypes)["rep"] == "binary" else F.col("doc_id").cast("long")
    rows = docs.select(rep.alias("rep"), F.col("text").cast("binary").alias("text"))
    want = wanted.select(F.col("node").alias("want"), F.col("rep").alias("_rep"))
    if wanted.count() <= c.broadcast_rows:
        want = F.broadcast(want)
    got = rows.join(want, F.col("rep").eqNullSafe(F.col("_rep"))).select("text", "want").mapInArrow(run, schema)
    return got.where("node = want").select("node", "set")


def _confirmed(pairs: DataFrame, sets: DataFrame, c: Config) -> DataFrame:
    left = pairs.join(sets.select(F.col("node").alias("a"), F.col("set").alias("sa")), "a")
    both = left.join(sets.select(F.col("node").alias("b"), F.col("set").alias("sb")), "b")
    shared = F.size(F.array_intersect("sa", "sb"))
    ok = both.where(100 * shared >= c.percent * (F.size("sa") + F.size("sb") - shared))
    return ok.select("a", "b")


def _bit_gap(x: str, y: str, c: Config):
    """Population count of the XOR of two sketches, on 64-bit words taken from their bytes."""
    word = lambda s, i: F.conv(F.hex(F.substring(s, 8 * i + 1, 8)), 16, -10).cast("long")
    return sum((F.bit_count(word(x, i).bitwiseXOR(word(y, i))) for i in range(c.bits // 64)), F.lit(0))


def _short(digest: str) -> Column:
    """The first 64 bits of a digest as a number. Two that agree in it only add a pair to be confirmed, or share a group of blocks."""
    return F.conv(F.hex(F.substring(digest, 1, 8)), 16, -10).cast("long")


def near_dups(docs: DataFrame, c: Config = Config()) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs`` (``doc_id, text``).

    Null, empty or wordless text: no shingles, linked with nothing, its own component. Rows that
    repeat a ``doc_id`` are nodes of their own with one id; a null ``doc_id`` never names a
    component that has another one. Other columns are ignored. ``kept``: doc_id = component_id; ``keep_one``
    chooses rows, not ids.
    """
    sig, named = _named(docs, c)
    out = sig.select("doc_id", "n_shingles", "node").join(named, F.col("node") == F.col("_node"), "left")
    component = F.coalesce("component_id", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept"))


def _named(docs: DataFrame, c: Config, by_row: bool = False) -> tuple[DataFrame, DataFrame]:
    """The signatures, and ``_node, component_id`` for every node; with ``by_row`` each node's ``component`` and ``best`` row instead."""
    sig = materialize(signatures(docs, c, by_row), "near-sig")
    # the row that stays in a group: the least id, null last, then the least key
    best = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row"))
    first = [best["row"].alias("rep"), best.alias("best")] if by_row else [F.min("doc_id").alias("rep")]
    nodes = materialize(sig.where("node IS NOT NULL").groupBy("node")
                        .agg(*first, F.first("n_shingles").alias("n"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch"))
                        .withColumn("nid", _short("node")), "near-nodes")

    # 3. one pivot per bucket; only bucket numbers and short node numbers are dealt out, and of buckets with one node nothing is kept
    keys = nodes.select("nid", F.explode("bands").alias("key"))
    pivots = keys.groupBy("key").agg(F.min("nid").alias("a"), F.max("nid").alias("z")).where("a <> z").select("key", "a")
    members = materialize(keys.join(pivots, "key").select("key", "a", "nid"), "near-members")
    met = members.where("nid <> a").select("a", F.col("nid").alias("b")).distinct()
    side = lambda x: nodes.select(F.col("nid").alias(x), F.col("node").alias(f"n{x}"), F.col("sketch").alias(f"k{x}"))
    near = met.join(side("b"), "b").join(side("a"), "a").where(_bit_gap("ka", "kb", c) <= most_bits(c))
    pairs = materialize(near.select(F.col("na").alias("a"), F.col("nb").alias("b")), "near-pairs")
    cand = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    # written first, so that its size is known when the texts are joined: they are only shuffled when it is large
    wanted = materialize(cand.join(nodes.select("node", "rep"), "node"), "near-wanted")
    sets = materialize(full_sets(docs, wanted, c), "near-sets")
    links = materialize(_confirmed(pairs, sets, c), "near-links")
    label = components(links, "near-cc")

    # 4. buckets that still hold several components
    tagged = materialize(nodes.select("node", "nid", "rep", "n", "sketch").join(label, "node", "left")
                         .withColumn("component", F.coalesce("component", "node")).withColumn("cid", _short("component")), "near-tagged")
    keyed = materialize(members.select("key", "nid").join(tagged.select("nid", "node", "component", "cid"), "nid").drop("nid"), "near-keyed")
    live = keyed.groupBy("key").agg(F.min("cid").alias("a"), F.max("cid").alias("z")).where("a <> z").select("key", "a")
    shared = materialize(keyed.join(live, "key").select("node", "component", "cid", "a").distinct(), "near-shared")
    more = _rest(docs, tagged, shared, c)
    if more is not None:
        # links between components: contract them, then rename
        over = more.join(tagged.select(F.col("node").alias("a"), F.col("component").alias("ca")), "a").join(tagged.select(F.col("node").alias("b"), F.col("component").alias("cb")), "b")
        joined = components(over.select(F.col("ca").alias("a"), F.col("cb").alias("b")), "near-cc").select(F.col("node").alias("component"), F.col("component").alias("to"))
        label = tagged.select("node", "component").join(joined, "component", "left").select("node", F.coalesce("to", "component").alias("component"))

    best = nodes.select("node", "rep", *(["best"] if by_row else [])).join(label, "node", "left").withColumn("component", F.coalesce("component", "node"))
    if by_row:
        return sig, best
    least = best.groupBy("component").agg(F.min("rep").alias("component_id"))
    return sig, materialize(best.join(least, "component").select(F.col("node").alias("_node"), "component_id"), "near-named")


def _rest(docs: DataFrame, tagged: DataFrame, shared: DataFrame, c: Config) -> DataFrame | None:
    """Links between components that share a bucket (``shared``: node, its component, that component's number, and the bucket's least number)."""
    if shared.isEmpty():
        return None
    group = components(shared.select(F.col("cid").alias("a"), F.col("a").alias("b")), "near-groups")
    members = (shared.select("node", "component", "cid").distinct()
               .join(group.select(F.col("node").alias("cid"), F.col("component").alias("grp")), "cid").drop("cid")
               .join(tagged.select("node", "rep", "n", "sketch"), "node")
               .withColumn("weight", F.greatest("n", F.lit(c.block // 500).cast("long"))))
    # blocks of bounded size in the order (group, component): large components fill whole blocks
    placed = running(members.select("grp", "component", "node", "rep", "sketch", "weight"), ["grp", "component", "node"], ["weight"], "near-placed")
    placed = materialize(placed.withColumn("blk", F.floor(F.col("weight_before") / c.block)), "near-blocks")
    blocks = placed.groupBy("grp", "blk").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
    x, y = blocks.alias("x"), blocks.alias("y")
    meet = x.join(y, "grp").where("x.blk <= y.blk AND NOT (x.lo = x.hi AND y.lo = y.hi AND x.lo = y.lo)")
    meet = materialize(meet.select("grp", F.col("x.blk").alias("i"), F.col("y.blk").alias("j")), "near-meet")
    sets = full_sets(docs, materialize(placed.select("node", "rep").distinct(), "near-wanted"), c)
    rows = materialize(placed.select("grp", "component", "node", "sketch", "blk").join(sets, "node"), "near-rows")
    sides = (meet.select("grp", "i", "j", F.col("i").alias("blk"))
             .unionByName(meet.where("i <> j").select("grp", "i", "j", F.col("j").alias("blk"))))
    bits, percent = most_bits(c), c.percent

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        return _block_links(pdf, bits, percent)

    more = materialize(sides.join(rows, ["grp", "blk"]).groupBy("grp", "i", "j").applyInPandas(compare, "a binary, b binary"), "near-more")
    return None if more.isEmpty() else more


_POP = np.array([bin(i).count("1") for i in range(256)], np.uint8)


def _block_links(pdf: pd.DataFrame, bits: int, percent: int) -> pd.DataFrame:
    """Links between different components of one block pair: enough of them to join what links join."""
    i, j = pdf["i"].iloc[0], pdf["j"].iloc[0]
    x, y = pdf[pdf["blk"] == i], pdf[pdf["blk"] == j]
    kx, ky = (np.frombuffer(b"".join(map(bytes, t["sketch"])), np.uint8).reshape(len(t), -1) for t in (x, y))
    cx, cy = (np.array([bytes(v) for v in t["component"]], "S16") for t in (x, y))
    nx, ny = [bytes(v) for v in x["node"]], [bytes(v) for v in y["node"]]
    sx, sy = [np.asarray(v) for v in x["set"]], [np.asarray(v) for v in y["set"]]
    names: dict[bytes, bytes] = {}

    def root(v: bytes) -> bytes:
        while names.get(v, v) != v:
            v = names[v]
        return v

    out = []
    for p in range(len(nx)):
        may = np.flatnonzero((cy != cx[p]) & (_POP[ky ^ kx[p]].sum(axis=1) <= bits))
        for q in may:
            a, b = root(cx[p]), root(cy[q])
            if a == b:
                continue
            both = len(np.intersect1d(sx[p], sy[q], assume_unique=True))
            if 100 * both >= percent * (len(sx[p]) + len(sy[q]) - both):
                names[a] = b
                out.append((nx[p], ny[q]))
    return pd.DataFrame(out, columns=["a", "b"])


def keep_one(docs: DataFrame, c: Config = Config(words=5)) -> DataFrame:
    """One row of every group of near-duplicates, with all its columns: that of the least ``doc_id`` (null last),
    ties by digest of the text. Ids name nothing here: rows with a null or a repeated ``doc_id`` are judged by
    their own text. Rows without words all stay."""
    sig, best = _named(docs, c, by_row=True)
    chosen = best.groupBy("component").agg(F.min("best").alias("best")).select(F.col("best.row").alias("row"))
    # rows that agree in id and text have one key
    keep = materialize(sig.select("row").join(chosen, "row", "left_semi").groupBy(F.col("row").alias("__row")).agg(F.count("*").alias("__n")), "near-keep")
    worded = F.coalesce(F.col("text").cast("string").rlike(WORD), F.lit(False))
    rows = docs.where(worded).withColumn("__key", row_key(docs)).join(keep, F.col("__key") == F.col("__row"))
    out = docs.where(~worded).unionByName(rows.where("__n = 1").select(*docs.columns))
    if keep.where("__n > 1").isEmpty():
        return out
    return out.unionByName(rows.where("__n > 1").dropDuplicates(["__key"]).select(*docs.columns))
