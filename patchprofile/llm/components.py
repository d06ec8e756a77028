"""Connected components by alternating stars, with every round written to the shared folder."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patchprofile.llm.common import materialize

#: Links that a task holds at once when it draws its own ones together.
SLICE = 200_000


def components(edges: DataFrame, name: str) -> DataFrame:
    """``node, component`` (the least node reachable) for every node of ``edges`` (columns ``a, b`` of one orderable type).

    Self links only name a node; null ends are dropped. Each round links all larger neighbours of a node to
    its least neighbour, then all smaller ones, until every link leads to a root. Minima are pre-aggregated
    before the shuffle and the hub of a star is an ordinary skewed join key, which AQE splits,
    so no task holds a whole neighbourhood. Between rounds each task draws its own links together, so that
    few rounds are left: every round is many stages, whose plans and tasks the driver keeps. One flag a round reaches the driver.
    """
    named = edges.where("a IS NOT NULL AND b IS NOT NULL")
    links = named.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    stars = materialize(_drawn(links).distinct(), name)
    while not _is_forest(stars):
        both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))))
        stars = materialize(_drawn(materialize(small, name)).distinct(), name)
    ends = stars.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = stars.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    single = named.where("a = b").select(F.col("a").alias("node"), F.col("a").alias("component")).distinct()
    linked = ends.unionByName(roots)
    return linked.unionByName(single.join(linked.select("node"), "node", "left_anti"))


def _drawn(links: DataFrame, most: int = SLICE) -> DataFrame:
    """Links ``u, v`` (u > v) with the same components: in every slice of at most ``most`` links each node is linked to the least one it reaches there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for big in batches:
            for at in range(0, big.num_rows, most):
                b = big.slice(at, most)
                if n + b.num_rows > most:
                    yield _stars(held)
                    held, n = [], 0
                held.append(b)
                n += b.num_rows
        if n:
            yield _stars(held)

    return links.mapInArrow(run, links.schema)


def _stars(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    """The links of some batches as stars around their least nodes."""
    t = pa.Table.from_batches(batches)
    coded = pa.chunked_array([*t.column("u").chunks, *t.column("v").chunks]).combine_chunks().dictionary_encode()
    order = pc.sort_indices(coded.dictionary)
    rank = np.empty(len(order), np.int64)
    rank[order.to_numpy()] = np.arange(len(order))
    ends = rank[coded.indices.to_numpy()]
    root = _least(ends[: t.num_rows], ends[t.num_rows :], len(order))
    node = np.flatnonzero(root != np.arange(len(root)))
    nodes = coded.dictionary.take(order)
    return pa.RecordBatch.from_arrays([nodes.take(pa.array(node)), nodes.take(pa.array(root[node]))], names=["u", "v"])


def _least(u: np.ndarray, v: np.ndarray, n: int) -> np.ndarray:
    """For each of the numbers under ``n`` the least one it reaches over the links ``u - v``. Every root beside a lesser one is hooked to it, so each turn at least halves those left."""
    root = np.arange(n)
    while True:
        a, b = root[u], root[v]
        if (a == b).all():
            return root
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while not (root[root] == root).all():
            root = root[root]


def _is_forest(stars: DataFrame) -> bool:
    """Every node has one link down, and none that has one is another's root."""
    ends = stars.select(F.col("u").alias("node"), F.lit(1).alias("down"), F.lit(0).alias("root"))
    roots = stars.select(F.col("v").alias("node"), F.lit(0).alias("down"), F.lit(1).alias("root"))
    seen = ends.unionByName(roots).groupBy("node").agg(F.sum("down").alias("down"), F.max("root").alias("root"))
    return seen.where("down > 1 OR (down = 1 AND root = 1)").isEmpty()
