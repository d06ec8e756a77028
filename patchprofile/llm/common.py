"""Helpers shared by the operators: scratch tables, word hashing, running sums over a range sort."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patchprofile.session import work_dir

#: The words of every contract: runs of anything but space, tab, LF, VT, FF, CR.
#: ``bytes.split()`` cuts at exactly these six characters.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"

_P = np.uint64(0x9E3779B97F4A7C15)
_M1 = np.uint64(0xBF58476D1CE4E5B9)
_M2 = np.uint64(0x94D049BB133111EB)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the cluster's shared scratch folder and read it back.

    Cuts the lineage: a lost executor later re-reads files instead of
    recomputing, and every use sees the same rows.
    """
    spark = df.sparkSession
    path = work_dir(spark, f"llm-{name}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def n_words(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.size(F.filter(F.split(text, SPACE), lambda x: x != "")), F.lit(0)).cast("long")


def held_out(doc_id: Column) -> Column:
    """The evaluation fold: crc32(doc_id as text) mod 5 = 0 (a null id is never held out)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


class WordHash(dict):
    """word (bytes) -> 64-bit hash, kept while the worker lives, within a bounded size."""

    LIMIT = 250_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


_HASHES = WordHash()


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finalizer."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def shingles(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of ``k`` words; fewer words give one hash of the whole run; none give none."""
    n = len(hashes)
    if n == 0:
        return hashes
    k = min(k, n)
    out = hashes[: n - k + 1].copy()
    for j in range(1, k):
        out *= _P
        out += hashes[j : n - k + 1 + j]
    return mix(out + np.uint64(k))


def texts(batch: pa.RecordBatch, name: str = "text") -> Iterator[bytes]:
    """The text column (sent as binary) as bytes; null as empty."""
    for x in batch.column(name):
        yield x.as_py() or b""


def id_lists(known: list[bytes]) -> pa.ListArray:
    """Lists of ids from their bytes as 32-bit integers."""
    ends = np.cumsum([0, *map(len, known)]) // 4
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(np.frombuffer(b"".join(known), np.int32)))


def ids_by_piece(pieces: pa.ListArray, learn: Callable[[pa.StringArray], pa.ListArray]) -> pa.ListArray:
    """Ids of texts that are cut into pieces (a list of strings each): every different piece of the batch is looked up
    once, and its ids are put in its places by Arrow. ``learn`` gives the ids of pieces."""
    coded = pieces.flatten().dictionary_encode()
    lists = learn(coded.dictionary)
    size = pa.compute.list_value_length(lists).to_numpy()
    places = coded.indices
    # where a text's pieces end among the ids
    ends = np.concatenate([[0], np.cumsum(size[places.to_numpy(zero_copy_only=False)])]) if len(places) else np.zeros(1, np.int64)
    cut = np.concatenate([[0], np.cumsum(pa.compute.list_value_length(pieces).to_numpy(zero_copy_only=False))])
    return pa.ListArray.from_arrays(pa.array(ends[cut].astype(np.int32)), lists.take(places).flatten())


def by_bytes(batch: pa.RecordBatch, name: str, most: int) -> Iterator[pa.RecordBatch]:
    """The batch in slices whose column ``name`` holds at most ``most`` bytes, or one row."""
    size = pa.compute.fill_null(pa.compute.binary_length(batch.column(name)), 0).to_numpy(zero_copy_only=False)
    ends, lo = np.cumsum(size), 0
    while lo < len(size):
        hi = max(lo + 1, int(np.searchsorted(ends, ends[lo] - size[lo] + most, "right")))
        yield batch.slice(lo, hi - lo)
        lo = hi


def one_at_a_time(batches: Iterator[pa.RecordBatch], name: str | None = None, most: int = 0) -> Iterator[pa.RecordBatch]:
    """The batches (with ``name`` and ``most``: their ``by_bytes`` slices). Nothing of a batch is held here while the next one is
    read, and memory that Arrow has freed goes back to the system: a worker lives on, and would keep the most it ever needed.

    The caller drops its own name of a batch before it asks for the next. What earlier stages kept in this worker is given up first.
    """
    pool = pa.default_memory_pool()
    _HASHES.clear()
    pool.release_unused()
    batches = iter(batches)
    while (batch := next(batches, None)) is not None:
        parts = by_bytes(batch, name, most) if name else iter([batch])
        del batch
        while (part := next(parts, None)) is not None:
            yield part
            del part
            pool.release_unused()
        del parts
    pool.release_unused()


def running(df: DataFrame, order: list[str], values: list[str], name: str) -> DataFrame:
    """``df`` globally sorted by ``order`` with, per value column v, ``v_before``: the sum of v
    over all rows sorted earlier (rows equal in every order column stand in any order).

    One range shuffle; each task adds up its own run and the runs' totals (one row per
    partition, the only thing a single task sees) give the offsets. A hot value of the
    leading order column is cut by the following ones. Nulls sort first; null values count 0.
    """
    spark = df.sparkSession
    schema = T.StructType([*df.schema.fields, T.StructField("_part", T.IntegerType()),
                           *(T.StructField(f"{v}_before", T.LongType()) for v in values)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = dict.fromkeys(values, 0)
        for b in batches:
            cols = list(b.columns)
            for v in values:
                x = b.column(b.schema.get_field_index(v)).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
                ends = np.cumsum(x) + total[v]
                cols.append(pa.array(ends - x))
                total[v] = int(ends[-1]) if len(x) else total[v]
            yield pa.RecordBatch.from_arrays(cols, names=[*b.schema.names, *(f"{v}_before" for v in values)])

    n = shuffle_partitions(spark)
    ranged = df.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("_part", F.spark_partition_id())
    local = materialize(ranged.mapInArrow(run, schema), name)
    return with_offsets(local, "_part", values).drop("_part")


def with_offsets(local: DataFrame, part: str, values: list[str]) -> DataFrame:
    """Turn sums inside numbered partitions (``v_before``) into global ones."""
    from pyspark.sql import Window

    totals = local.groupBy(F.col(part).alias("_p")).agg(*(F.max(F.col(f"{v}_before") + F.coalesce(F.col(v), F.lit(0))).alias(f"_t_{v}") for v in values))
    w = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("_p", *(F.coalesce(F.sum(f"_t_{v}").over(w), F.lit(0)).alias(f"_b_{v}") for v in values))
    # one row per partition of the write: bounded by the partition count
    out = local.join(F.broadcast(bases), F.col(part) == F.col("_p"))
    return out.select(*(c for c in local.columns if c not in {f"{v}_before" for v in values}),
                      *((F.col(f"{v}_before") + F.col(f"_b_{v}")).alias(f"{v}_before") for v in values))
