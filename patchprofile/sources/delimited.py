"""Bulk load of comma-delimited objects named by a manifest.

Load semantics follow a warehouse bulk loader's defaults rather than Spark's
CSV reader: fields are positional, the delimiter is ``,``, a backslash escapes
the next character (so ``\\,`` is a literal comma and ``\\\\`` a backslash),
quote characters are plain text, and an empty field is NULL. A row with the
wrong number of fields, or a non-empty field that does not parse as its
column type, or a blank line, is not loaded; it goes to the rejects with its file, raw text
and reason, and every other row and file still loads.

The manifest, the listing of the objects and the comparison of the two are DataFrames
(``scan_manifest``, ``scan_objects``, ``match_manifest``). Only the names of the manifest's present objects reach the
driver, as the paths to scan: objects that no manifest names are not read, and no line is shuffled. Lines are split
and typed once, with built-in expressions (``split``, ``regexp_replace``, ``try_cast``), so there is no per-row Python.

An object is loaded whole or not at all: with ``skip_unreadable`` a damaged archive is found by decoding it
before the load (``probe_objects``) and leaves nothing behind.
"""

from __future__ import annotations

import re
import time
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patchprofile.functions.ordering import q
from patchprofile.sources.fs import path_exists

FILE = "_file"
REASON = "_reject_reason"
AT = "_read_at"
#: Paths of one scan; a longer manifest is the union of several scans.
PATHS_A_SCAN = 10_000
#: Objects with these endings are compressed: a reader decodes them from their first byte to their last.
COMPRESSED = (".gz", ".bz2", ".deflate", ".zst", ".lz4", ".snappy")
#: A compressed object above this size is decoded by a scan of its own instead of in one row.
PROBE_BYTES = 512 << 20
#: Fields of the lines that one writing task sorts by object (some tens of MB of short texts).
SORTED_FIELDS = 4_000_000


@dataclass
class LoadResult:
    """``checked`` holds every line once, typed, with its reject reason and the time it was read; ``good`` and ``rejects``
    are filters of it. ``manifest`` has one row per named object and how it fared (``error``: why it could not be decoded)."""
    checked: DataFrame
    schema: T.StructType
    manifest: DataFrame

    @property
    def good(self) -> DataFrame:
        return good_rows(self.checked)

    @property
    def rejects(self) -> DataFrame:
        return rejected_rows(self.checked)

    @property
    def missing(self) -> DataFrame:
        return self.manifest.where("NOT present").select("name")

    def stored(self, path: str) -> "LoadResult":
        """The lines written once under ``path``, split by whether they are rejected: reading
        good rows and rejects afterwards parses nothing again."""
        bad = F.col(REASON).isNotNull()
        self.checked.withColumn("rejected", bad).write.partitionBy("rejected").mode("overwrite").parquet(path)
        return LoadResult(self.checked.sparkSession.read.parquet(path), self.schema, self.manifest)


def object_key(name: Column) -> Column:
    """An object's name without its scheme, so that ``file:/a``, ``file:///a`` and ``/a`` are one object."""
    return F.regexp_replace(F.trim(name), r"^[A-Za-z][A-Za-z0-9+.\-]*:/*", "/")


def _listed_key(path: Column) -> Column:
    """The key of a path that Spark lists (it is percent-encoded there)."""
    return object_key(F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))))


def scan_manifest(spark: SparkSession, manifest: str) -> DataFrame:
    """Object names (``name``), one per non-empty line. A missing manifest means zero loads."""
    if not path_exists(spark, manifest):
        return spark.createDataFrame([], "name string")
    return spark.read.text(manifest).select(F.trim("value").alias("name")).where("name <> ''")


def scan_objects(spark: SparkSession, root: str) -> DataFrame:
    """The objects under ``root`` (``name``, ``bytes``, ``modified``), listed by Spark; contents are not read.

    A scan leaves out files without bytes, so the names come from the file index that Spark holds on the
    driver for the scan anyway, the sizes from the scan. ``modified`` is NULL for empty objects.
    """
    m = F.col("_metadata")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    sized = files.select(_listed_key(m["file_path"]).alias("_key"), m["file_size"].alias("bytes"), m["file_modification_time"].alias("modified"))
    names = spark.createDataFrame([(n,) for n in files.inputFiles()], "listed string")
    names = names.select(F.url_decode(F.replace("listed", F.lit("+"), F.lit("%2B"))).alias("name"), _listed_key(F.col("listed")).alias("_key"))
    return names.join(sized, "_key", "left").select("name", F.coalesce("bytes", F.lit(0)).alias("bytes"), "modified")


def match_manifest(manifest: DataFrame, objects: DataFrame) -> DataFrame:
    """Every name of the manifest once, with ``present`` and the object's ``bytes``."""
    found = objects.select(object_key(F.col("name")).alias("_key"), "bytes")
    named = manifest.select("name", object_key(F.col("name")).alias("_key")).dropDuplicates(["_key"])
    return named.join(found, "_key", "left").select("name", "_key", F.col("bytes").isNotNull().alias("present"), "bytes")


def _as_path(name: str) -> str:
    """A name as a path pattern that matches itself only."""
    return re.sub(r"([{}\[\]*?\\])", r"\\\1", name)


def _inflate(name: str, data: bytes) -> int:
    """Number of line ends of a compressed object; raises where it is damaged or cut off."""
    import bz2
    import gzip
    import io
    import zlib

    if name.endswith(".gz"):
        stream = gzip.GzipFile(fileobj=io.BytesIO(data))
    elif name.endswith(".bz2"):
        stream = bz2.BZ2File(io.BytesIO(data))
    elif name.endswith(".zst"):
        import zstandard

        got = zstandard.ZstdDecompressor().decompressobj(read_across_frames=True)
        lines = got.decompress(data).count(b"\n")
        if not got.eof and data:
            raise EOFError("the archive ends early")
        return lines
    else:
        got = zlib.decompressobj()
        lines = got.decompress(data).count(b"\n")
        if not got.eof:
            raise EOFError("the archive ends early")
        return lines
    lines = 0
    while block := stream.read(1 << 20):
        lines += block.count(b"\n")
    return lines


def probe_objects(spark: SparkSession, sized: list[tuple[str, int]]) -> DataFrame:
    """``_key, lines, error, decode_ns`` of the compressed ones among ``(name, bytes)``: each is decoded to its end, and only that comes back.

    A damaged or cut-off object has an ``error`` and no ``lines``. Objects above ``PROBE_BYTES``, or compressed in a way that
    Python has no decoder for, are counted by a scan of their own.
    """
    packed = [(n, b) for n, b in sized if n.lower().endswith(COMPRESSED)]
    small = [n for n, b in packed if b <= PROBE_BYTES and n.lower().endswith((".gz", ".bz2", ".deflate", ".zst"))]
    large = [n for n, _ in packed if n not in set(small)]
    schema = "_key string, lines bigint, error string, decode_ns bigint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for key, content in zip(b.column("_key"), b.column("content")):
                t0, lines, error = time.perf_counter_ns(), None, None
                try:
                    lines = _inflate(key.as_py().lower(), content.as_py())
                except Exception as exc:  # whatever a decoder says of a damaged object is the result
                    error = f"{type(exc).__name__}: {exc}"
                yield pa.RecordBatch.from_arrays([pa.array([key.as_py()]), pa.array([lines], pa.int64()), pa.array([error], pa.string()), pa.array([time.perf_counter_ns() - t0], pa.int64())],
                                                 names=["_key", "lines", "error", "decode_ns"])

    out = spark.createDataFrame([], schema)
    for at in range(0, len(small), PATHS_A_SCAN):
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load([_as_path(n) for n in small[at : at + PATHS_A_SCAN]])
        out = out.unionByName(files.select(_listed_key(F.col("_metadata.file_path")).alias("_key"), "content").mapInArrow(run, schema))
    rows = []
    for n in large:
        t0, lines, error = time.perf_counter_ns(), None, None
        try:
            lines = spark.read.text(_as_path(n)).count()
        except Exception as exc:
            error = f"{type(exc).__name__}: {str(exc)[:200]}"
        rows.append((n, lines, error, time.perf_counter_ns() - t0))
    if rows:
        one = spark.createDataFrame(rows, "name string, lines bigint, error string, decode_ns bigint")
        out = out.unionByName(one.select(object_key(F.col("name")).alias("_key"), "lines", "error", "decode_ns"))
    return out


def system_clock() -> Column:
    """Seconds since 1970 at which a row is read, taken where it is read."""
    return F.expr("CAST(java_method('java.lang.System', 'currentTimeMillis') AS BIGINT) / 1000")


def check_lines(lines: DataFrame, schema: T.StructType, sep: str = ",", text_col: str = "value", clock: Column | None = None) -> DataFrame:
    """Split and type delimited lines: file, raw text, read time, typed fields and the reject reason (NULL: good).

    Lines must not hold a line feed (a text scan gives none): where a line has backslashes, one is put before every
    escaped character in place of its backslash, so that a delimiter is a comma without one before it. Other lines are split
    on the plain delimiter. The struct of typed fields and the reason leave through ``inline``, which keeps Spark from
    evaluating them once more for a filter on the reason.
    """
    if sep != ",":
        raise ValueError("only the ',' delimiter is supported")
    raw = F.col(text_col)
    marked = F.regexp_replace(raw, r"(?s)\\(.)", "\n$1")
    whole = F.transform(F.split(marked, r"(?<!\n),", -1), lambda x: F.replace(x, F.lit("\n"), F.lit("")))
    parts = F.when(F.instr(raw, "\\") > 0, whole).otherwise(F.split(raw, ",", -1))
    n = len(schema.fields)
    rows = lines.select(F.col(FILE), raw.alias("_raw"), (system_clock() if clock is None else clock).alias(AT), parts.alias("_parts"))

    # SQL text: one call per column for wide schemas
    typed, bad = [], []
    for i, f in enumerate(schema.fields):
        text = f"nullif(get(_parts, {i}), '')"
        value = text if isinstance(f.dataType, T.StringType) else f"try_cast({text} AS {f.dataType.simpleString()})"
        typed.append(f"{value} AS {q(f.name)}")
        if not isinstance(f.dataType, T.StringType):
            bad.append(f"CASE WHEN get(_parts, {i}) <> '' AND {value} IS NULL THEN 'unparsable {f.name}' END")
    width = f"CASE WHEN size(_parts) < {n} THEN 'short row' WHEN size(_parts) > {n} THEN 'long row' END"
    reason = f"coalesce({', '.join([width, *bad])}) AS {REASON}" if bad else f"{width} AS {REASON}"
    return rows.select(F.col(FILE), F.col("_raw"), F.col(AT), F.expr(f"inline(array(struct({', '.join([*typed, reason])})))"))


def good_rows(checked: DataFrame) -> DataFrame:
    return checked.filter(F.col(REASON).isNull()).drop(REASON, "_raw", AT, "rejected")


def rejected_rows(checked: DataFrame) -> DataFrame:
    return checked.filter(F.col(REASON).isNotNull()).select(F.col(FILE), F.col("_raw").alias("raw_text"), F.col(REASON).alias("reason"))


def parse_lines(lines: DataFrame, schema: T.StructType, sep: str = ",",
                text_col: str = "value") -> tuple[DataFrame, DataFrame]:
    """(good rows, rejects) of delimited lines."""
    checked = check_lines(lines, schema, sep, text_col)
    return good_rows(checked), rejected_rows(checked)


def load_delimited(spark: SparkSession, manifest: DataFrame, root: str, schema: T.StructType,
                   skip_unreadable: bool = False, clock: Column | None = None) -> LoadResult:
    """The objects under ``root`` that ``manifest`` (column ``name``) names; missing ones are reported, not fatal.

    Only these objects are scanned. With ``skip_unreadable`` an object that cannot be decoded to its end (e.g. a damaged or
    cut-off ``.gz``) is left out whole and reported; without it, such an object fails the load.
    """
    named = match_manifest(manifest, scan_objects(spark, root))
    # names and sizes of the manifest's objects, as Spark's own index of the scan holds them
    sized = [(r["name"], r["bytes"]) for r in named.where("present AND bytes > 0").select("name", "bytes").collect()]
    probed = None
    if skip_unreadable and any(n.lower().endswith(COMPRESSED) for n, _ in sized):
        found = probe_objects(spark, sized).collect()  # a few numbers per compressed object
        probed = spark.createDataFrame(found, "_key string, lines bigint, error string, decode_ns bigint")
        bad = {r["_key"] for r in found if r["error"] is not None}
        sized = [(n, b) for n, b in sized if _plain_key(n) not in bad]
    if probed is None:
        probed = spark.createDataFrame([], "_key string, lines bigint, error string, decode_ns bigint")
    named = named.join(probed.select("_key", "error"), "_key", "left")
    reader = spark.read.option("recursiveFileLookup", "true")
    scans = [reader.text([_as_path(n) for n, _ in sized[at : at + PATHS_A_SCAN]]).select("value", F.col("_metadata.file_path").alias(FILE)) for at in range(0, len(sized), PATHS_A_SCAN)]
    lines = reduce(DataFrame.unionAll, scans) if scans else spark.createDataFrame([], f"value string, {FILE} string")
    return LoadResult(check_lines(lines, schema, clock=clock), schema, named)


def _plain_key(name: str) -> str:
    """``object_key`` of one name."""
    return re.sub(r"^[A-Za-z][A-Za-z0-9+.\-]*:/*", "/", name.strip(" "))


def ingest(spark: SparkSession, manifest: str, root: str, schema: T.StructType, skip_unreadable: bool = False, clock: Column | None = None) -> LoadResult:
    """Manifest -> existing objects -> typed rows and rejects."""
    return load_delimited(spark, scan_manifest(spark, manifest), root, schema, skip_unreadable, clock)


def stamp(df: DataFrame, load_id: Column | int, ingest_time: Column | None = None) -> DataFrame:
    """Columns the table fills at load time: commit number and ingest time."""
    lid = load_id if isinstance(load_id, Column) else F.lit(load_id).cast("long")
    ts = ingest_time if ingest_time is not None else F.localtimestamp()
    return df.withColumn("epoch", lid).withColumn("epoch_ts", ts)


def file_stats(load: LoadResult) -> DataFrame:
    """Rows loaded and rejected per present object, and when its first and last line were read: one aggregate over the
    lines, objects without a line included. ``state``: loaded, empty (no bytes), or unreadable (``error`` says why)."""
    per_file = load.checked.groupBy(_listed_key(F.col(FILE)).alias("_key")).agg(
        F.count(F.when(F.col(REASON).isNull(), 1)).alias("loaded"), F.count(REASON).alias("rejected"),
        F.min(AT).alias("started_at"), F.max(AT).alias("ended_at"))
    n = F.coalesce("loaded", F.lit(0)), F.coalesce("rejected", F.lit(0))
    state = F.when(F.col("error").isNotNull(), "unreadable").when(F.col("loaded").isNotNull(), "loaded").when(F.col("bytes") == 0, "empty").otherwise("unreadable")
    return (load.manifest.where("present").join(per_file, "_key", "left")
            .select(F.col("name").alias("file"), "bytes", n[0].alias("rows_loaded"), n[1].alias("rows_rejected"), state.alias("state"),
                    "started_at", "ended_at", "error"))


def copy_records(stats: DataFrame, batch_id: int) -> DataFrame:
    """One ``copy`` record per loaded object, in the columns of the step log (``lo``: the object's name)."""
    took = F.round((F.col("ended_at") - F.col("started_at")) * F.lit(1e9)).cast("long")
    return stats.where("state = 'loaded'").select(F.lit("copy").alias("step"), F.lit(batch_id).cast("long").alias("batch_id"), F.col("file").alias("lo"),
                                                  F.lit(None).cast("string").alias("hi"), F.col("rows_loaded").cast("long").alias("rows"), "started_at", "ended_at", took.alias("elapsed_ns"))


# ------------------------------------------------------------- writing ----

def _escape(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit(","), F.lit("\\,"))


def to_delimited_line(df: DataFrame, ts_format: str = "yyyy-MM-dd HH:mm:ss.SSSSSS") -> Column:
    """One delimited text line per row (NULL -> empty field), loader escapes applied."""
    parts = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            txt = F.date_format(c, ts_format)
        elif isinstance(f.dataType, T.StringType):
            txt = _escape(c)
        else:
            txt = c.cast("string")
        parts.append(F.coalesce(txt, F.lit("")))
    return F.concat_ws(",", *parts)


def write_objects(df: DataFrame, path: str, object_col: str) -> None:
    """Write ``df`` as delimited objects, one folder per ``object_col`` value."""
    body = df.drop(object_col)
    write_lines(df.select(to_delimited_line(body).alias("value"), F.col(object_col)), path, object_col, len(body.columns))


def write_lines(lines: DataFrame, path: str, object_col: str, fields: int) -> None:
    """Write delimited lines (``value``) of about ``fields`` fields each, one folder per ``object_col`` value.

    A task sorts its lines by object, so the lines are counted first (without being made) and dealt to as many tasks as
    keep each at about ``SORTED_FIELDS`` fields. A larger object is still one task.
    """
    tasks = max(lines.sparkSession.sparkContext.defaultParallelism, -(-lines.count() * fields // SORTED_FIELDS))
    lines.repartition(tasks, object_col).write.partitionBy(object_col).mode("error").text(path)


def write_manifest(names: DataFrame, manifest: str) -> None:
    """A manifest: one object name (column ``name``) per line."""
    names.select(F.col("name").alias("value")).write.text(manifest)
