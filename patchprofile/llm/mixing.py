"""Mixing sources to target weights by weighted fair queueing.

Each source's documents are shuffled by a seeded hash and repeated as often as its target asks.
A document's virtual finish time is its source's words up to and including it, divided by
the source's target; the queue is the global order of finish times, cut at the total budget.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patchprofile.llm.common import materialize, n_words, running

WEIGHTS = (5, 2, 1)
MOST = 3


def targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """``source, source_size, source_before, target`` for ``source, size``.

    Sources in code-point order, null last, weigh ``weights`` in turn and share the total size; a target stops at
    ``most`` times its source's size and the excess is shared again by weight until none is above.
    Each round is one aggregate over the source table; only sums reach the driver.
    """
    by = materialize(sized.groupBy("source").agg(F.coalesce(F.sum("size"), F.lit(0)).alias("source_size")), "mix-sources")
    by = by.withColumn("_last", F.col("source").isNull()).withColumn("one", F.lit(1).cast("long"))
    placed = running(by, ["_last", "source"], ["one", "source_size"], "mix-ranked")
    weight = F.element_at(F.array(*(F.lit(w) for w in weights)), (F.col("one_before") % len(weights) + 1).cast("int"))
    table = materialize(placed.select("source", "source_size", F.col("source_size_before").alias("source_before"), weight.cast("double").alias("w"),
                                      (F.col("source_size") * most).alias("cap")), "mix-weights")
    total = table.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    rate, capped = 0.0, -1
    while True:
        # a source once capped stays so: the rate only grows
        full = F.col("cap") <= F.lit(rate) * F.col("w")
        s = table.agg(F.count(F.when(full, 1)).alias("n"), F.coalesce(F.sum(F.when(full, F.col("cap"))), F.lit(0)).alias("c"),
                      F.coalesce(F.sum(F.when(~full, F.col("w"))), F.lit(0.0)).alias("w")).first()
        if s.n == capped or not s.w:
            break
        capped, rate = s.n, (total - s.c) / s.w
    return table.select("source", "source_size", "source_before", F.least(F.col("cap").cast("double"), F.lit(rate) * F.col("w")).alias("target"))


def mix(docs: DataFrame, size=None, *, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, seed: int = 42, keep_text: bool = False) -> DataFrame:
    """Every row of ``docs`` with ``size``, ``source_size``, ``target``, ``taken`` (its words in the mix, repeats counted) and
    ``copies`` (times it is in the mix); with ``keep_text`` all columns of ``docs`` (prefixed ``d_``), else ``doc_id``.

    ``size``: a column, the number of words by default (null text: 0). A document may start while its source is
    below target; finish times tie by source, place and round. Documents without words take nothing and
    are in the mix once, if their place comes up. Repeated rows are queued each for itself; reruns and other partitionings agree.
    No source is ever one task: the shuffled order is a range sort over (source, hash, ...), so a source with a third
    of all rows is cut across tasks.
    """
    size = n_words(F.col("text")) if size is None else size
    key = F.xxhash64(F.lit(seed), "doc_id", "text")
    cols = [F.col(c).alias(f"d_{c}") for c in docs.columns] if keep_text else [F.col("doc_id")]
    rows = docs.select(*cols, F.col("source").isNull().alias("_last"), F.col("source").alias("_source"), key.alias("_key"), F.col("doc_id").alias("_id"), size.cast("long").alias("size"))
    if not keep_text:  # small columns: written once, else every use would count the words again
        rows = materialize(rows, "mix-sized")
    table = targets(rows.select(F.col("_source").alias("source"), "size"), weights, most)
    rows = rows.withColumn("one", F.lit(1).cast("long"))
    placed = running(rows, ["_last", "_source", "_key", "_id", "size"], ["size", "one"], "mix-placed").withColumnRenamed("one_before", "_place")
    names = table.select(F.col("source").alias("_s"), "source_size", "source_before", "target")
    small = placed.select("_place", "_source", "size", "size_before")
    queue = _queue(small.join(names, F.col("_source").eqNullSafe(F.col("_s"))), most)
    total = table.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    ordered = running(queue.select("finish", "_place", "lap", "size"), ["finish", "_place", "lap"], ["size"], "mix-queue")
    cut = (ordered.where(F.col("size_before") + F.col("size") > total)
           .agg(F.min(F.struct("finish", "_place", "lap"))).first()[0])
    joined = placed.join(names, F.col("_source").eqNullSafe(F.col("_s")))
    start = [F.col("size_before") - F.col("source_before") + F.col("source_size") * lap for lap in range(most)]
    finish = [_finish(s) for s in start]

    def inside(lap: int):
        may = _may(start[lap], lap)
        if cut is None:
            return may
        before = (finish[lap] < cut[0]) | ((finish[lap] == cut[0]) & ((F.col("_place") < cut[1]) | ((F.col("_place") == cut[1]) & (F.lit(lap) < cut[2]))))
        return may & before

    copies = sum((F.when(inside(lap), 1).otherwise(0) for lap in range(most)), F.lit(0))
    out = [F.col(f"d_{c}") for c in docs.columns] if keep_text else [F.col("doc_id")]
    return joined.select(*out, "size", "source_size", "target", (copies * F.col("size")).cast("long").alias("taken"), copies.cast("int").alias("copies"))


def _finish(start):
    return F.when(F.col("target") > 0, (start + F.col("size")) / F.col("target")).otherwise(F.lit(0.0))


def _may(start, lap):
    """Whether a document may be queued: its source is still below target (a wordless one only in its first round)."""
    return ((start < F.col("target")) & (F.col("size") > 0)) | ((F.col("size") == 0) & (F.lit(lap) == 0) & (start <= F.col("target")))


def _queue(joined: DataFrame, most: int) -> DataFrame:
    laps = joined.withColumn("lap", F.explode(F.array(*(F.lit(i) for i in range(most)))))
    start = F.col("size_before") - F.col("source_before") + F.col("source_size") * F.col("lap")
    return laps.where(_may(start, F.col("lap"))).withColumn("finish", _finish(start))


def mixed_rows(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: rows of ``docs`` as often as they are taken, with the columns of ``docs``."""
    got = mix(docs, keep_text=True, **options).where("copies > 0")
    again = got.withColumn("_n", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return again.select(*(F.col(f"d_{c}").alias(c) for c in docs.columns))
