"""Versioned profile snapshots in the shared folder.

Each merge writes a complete new version to its own folder (a path being read
is never overwritten), then publishes it by creating one small commit file
``_log/<version>-b<batch>.json``; the create is exclusive, so a version is committed
once, by one writer. Readers take the highest committed version. The batch id is
part of the record and of its name, so a replayed batch (a restarted stream re-delivering a
micro-batch) is recognised and skipped: exactly-once on top of at-least-once.
Writing the version to storage also cuts the lineage between batches, and a
lost executor only costs the tasks of the current write.

Two layouts spread a version by key hash (``buckets``):

* ``touched_only=False`` — each version is a Parquet table bucketed and sorted
  by the keys (Spark bucketing). Merges read the profile hash-partitioned, so
  any batch, however large, shuffles only itself.
* ``touched_only=True`` — each version folder holds only the hash buckets the
  batch touched (``pbucket=<b>`` folders); the commit record maps every bucket
  to the folder of its newest copy. A merge reads and rewrites only the
  touched buckets, so a small batch against a huge profile costs the size of
  its buckets, not of the profile.
"""

from __future__ import annotations

import hashlib
import json
import time
from datetime import datetime
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patchprofile.functions.ordering import q
from patchprofile.sources.fs import create_text, list_names, read_text

_LOG_SCHEMA = T.StructType([
    T.StructField("version", T.LongType()),
    T.StructField("batch_id", T.LongType()),
    T.StructField("path", T.StringType()),
    T.StructField("rows", T.LongType()),
    T.StructField("committed_at", T.DoubleType()),
])


class ProfileStore:
    """One writer per store (the job or stream that owns it). The log is listed once, when
    first needed, and only its newest record is read; both are then kept in step with this writer's
    own commits. The record holds the feed's mark, so a restarted job goes on where the last
    published version ended.

    With ``buckets`` set, every version is written as a Parquet table bucketed
    (and sorted) by the profile keys. A join on the keys then reads the profile
    already hash-partitioned: only the batch side is shuffled, even when the
    batch is too large to broadcast.
    The table definition is registered in the session catalog on first read,
    so a restarted process finds the same layout from the folders alone.
    """

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType | None = None,
                 buckets: int | None = None, keys: tuple[str, ...] = (), touched_only: bool = False):
        if buckets and not keys:
            raise ValueError("a bucketed store needs the key columns")
        if touched_only and not buckets:
            raise ValueError("touched-bucket rewrite needs buckets")
        self.touched_only = touched_only
        self.spark = spark
        self.root = root.rstrip("/")
        self.schema = schema
        self.buckets = buckets
        self.keys = tuple(keys)
        self._head: dict | None = None
        self._versions: dict[int, int] | None = None  # version -> batch id, from the record names
        self._tag = hashlib.sha1(self.root.encode()).hexdigest()[:12]

    def _table(self, version: int) -> str:
        return f"profile_{self._tag}_v{version}"

    def _register(self, name: str, path: str, schema: T.StructType) -> None:
        if self.spark.catalog.tableExists(name):
            return
        cols = ", ".join(f"{q(f.name)} {f.dataType.simpleString()}" for f in schema.fields)
        keys = ", ".join(q(k) for k in self.keys)
        self.spark.sql(f"CREATE TABLE {name} ({cols}) USING parquet CLUSTERED BY ({keys}) "
                       f"SORTED BY ({keys}) INTO {self.buckets} BUCKETS LOCATION '{path}'")

    def _load(self) -> dict[int, int]:
        """Committed versions and their batch ids: one listing; only the newest record is ever read."""
        if self._versions is None:
            names = [n[:-5].split("-b") for n in list_names(self.spark, self.log_path) if n.endswith(".json") and not n.startswith(".")]
            self._versions = {int(v): int(b) for v, b in names}
            if self._versions:
                v = max(self._versions)
                self._head = json.loads(read_text(self.spark, self._record(v, self._versions[v])))
        return self._versions

    def _record(self, version: int, batch_id: int) -> str:
        return f"{self.log_path}/{version:020d}-b{batch_id}.json"

    @property
    def log_path(self) -> str:
        return f"{self.root}/_log"

    def log(self) -> DataFrame:
        """The commit records as a DataFrame."""
        if not self._load():
            return self.spark.createDataFrame([], _LOG_SCHEMA)
        return self.spark.read.schema(_LOG_SCHEMA).json(self.log_path)

    def head(self) -> dict | None:
        """The newest commit record, or None before the first commit."""
        self._load()
        return self._head

    def mark(self) -> Any:
        """The high-water mark stored with the newest version (None when it has none)."""
        h = self.head()
        return decode_mark(h.get("mark")) if h else None

    def applied(self, batch_id: int) -> bool:
        return int(batch_id) in self._load().values()

    def _empty(self) -> DataFrame:
        if self.schema is None:
            h = self.head()
            if h is None or "schema" not in h:
                raise ValueError("empty store and no schema given")
            self.schema = T.StructType.fromJson(json.loads(h["schema"]))
        return self.spark.createDataFrame([], self.schema)

    def bucket_of(self) -> Column:
        """The hash bucket of a row's keys (Spark's own partitioning hash)."""
        keys = ", ".join(q(k) for k in self.keys)
        return F.expr(f"pmod(hash({keys}), {self.buckets})")

    def read_for(self, batch: DataFrame, touched: list | None = None) -> DataFrame:
        """The profile rows a merge with ``batch`` can change.

        With touched-bucket rewrite these are the buckets that hold a key of the
        batch (their ids, at most ``buckets`` integers, are the only thing
        collected; pass them as ``touched`` when they were observed already);
        otherwise the whole profile.
        """
        h = self.head()
        if not self.touched_only or h is None:
            return self.read()
        if touched is None:
            touched = [r[0] for r in batch.select(self.bucket_of()).distinct().collect()]
        touched = {str(b) for b in touched}
        paths = [p for b, p in h["buckets"].items() if b in touched]
        return self.spark.read.parquet(*paths) if paths else self._empty()

    def read(self) -> DataFrame:
        """The current profile; an empty frame of ``schema`` before the first commit."""
        h = self.head()
        if h is None:
            return self._empty()
        if self.touched_only:
            paths = list(h["buckets"].values())
            return self.spark.read.parquet(*paths) if paths else self._empty()
        if self.buckets:
            name = self._table(int(h["version"]))
            if not self.spark.catalog.tableExists(name):
                self._register(name, h["path"], self.spark.read.parquet(h["path"]).schema)
            return self.spark.table(name)
        return self.spark.read.parquet(h["path"])

    def publish(self, df: DataFrame, batch_id: int, rows: int | None = None, mark: Any = None, empty: bool = False,
                trigger: int | None = None) -> int:
        """Write ``df`` as the next version and commit it with the feed's ``mark`` and the stream's ``trigger``; returns the version.

        What an earlier try left under the version's path was never committed and
        belongs to nobody: it is overwritten.
        """
        h = self.head()
        version = 0 if h is None else int(h["version"]) + 1
        path = f"{self.root}/v{version:08d}-b{batch_id}"
        buckets = None
        if self.touched_only:
            # only the buckets present in ``df`` are written; the rest stay where they are
            # brought together by bucket first, else every task would write a file for every bucket
            # (not when known to be empty: re-planning an empty shuffle loses what is observed below it)
            put = df.withColumn(_BUCKET, self.bucket_of())
            ((put if empty else put.hint("rebalance", _BUCKET))
               .write.partitionBy(_BUCKET).mode("overwrite").parquet(path))
            buckets = dict(h["buckets"]) if h is not None else {}
            for name in list_names(self.spark, path):
                if name.startswith(f"{_BUCKET}="):
                    buckets[name.split("=", 1)[1]] = f"{path}/{name}"
        elif self.buckets:
            # No repartition here: a merge joined on the bucketed profile leaves every
            # key in the task of its bucket (the batch side is hash-partitioned by the
            # same function), so each task writes one bucket file without a shuffle.
            self.spark.sql(f"DROP TABLE IF EXISTS {self._table(version)}")
            (df.write.format("parquet").bucketBy(self.buckets, *self.keys).sortBy(*self.keys)
               .option("path", path).mode("overwrite").saveAsTable(self._table(version)))
        else:
            df.write.mode("overwrite").parquet(path)
        record = dict(zip(_LOG_SCHEMA.fieldNames(), (version, int(batch_id), path, rows, time.time())))
        record["schema"] = df.schema.json()
        record["mark"] = encode_mark(mark)
        record["trigger"] = trigger
        if buckets is not None:
            record["buckets"] = buckets
        if not create_text(self.spark, self._record(version, int(batch_id)), json.dumps(record)):
            raise RuntimeError(f"version {version} of {self.root} was committed by another writer")
        self._load()[version] = int(batch_id)
        self._head = record
        if self.schema is None:
            self.schema = df.schema
        return version


_BUCKET = "pbucket"


def encode_mark(mark: Any) -> list | None:
    """A mark as JSON: its kind and text."""
    if mark is None:
        return None
    if isinstance(mark, datetime):
        return ["timestamp", mark.isoformat()]
    if isinstance(mark, int):
        return ["integer", str(mark)]
    raise TypeError(f"a mark is an integer or a timestamp, not {type(mark).__name__}")


def decode_mark(stored: list | None) -> Any:
    if stored is None:
        return None
    kind, text = stored
    return datetime.fromisoformat(text) if kind == "timestamp" else int(text)
