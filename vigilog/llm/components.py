"""Connected components of a large graph."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigilog.session import durable

FLUSH = 1_000_000  # edges that a task looks at together


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Nodes that have an edge, with the smallest node they reach: ``node``, ``root``.

    Every round links the neighbours of a node to the smallest of them, first
    from below and then from above, until each component is one star. A task hands on
    what its own edges connect as stars, so that few rounds are left. A round
    writes its edges to shared storage. A node with very many neighbours is
    only ever aggregated (combined before the shuffle) and joined to one row.
    Self-loops count as nodes; null ends and repeated edges are ignored. Nodes are long.

    Joins are merged, not broadcast: each broadcast, however small, takes megabytes of the driver until its garbage is collected.
    """
    ends = edges.select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b")).where("a is not null and b is not null")
    links = durable(_stars_of_tasks(ends.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))).distinct(), "links")
    while not _all_stars(links):
        links = durable(_stars_of_tasks(_small_star(_large_star(links))).distinct(), "links")
    return links.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root"))


def _all_stars(links: DataFrame) -> bool:
    """Whether every node hangs on one node at most, and none of those on another."""
    ends = links.where("u <> v")
    nodes = ends.select(F.col("u").alias("node"), F.col("v").alias("above"), F.lit(False).alias("below")) \
        .union(ends.select("v", F.lit(None).cast("long"), F.lit(True)))
    return nodes.groupBy("node").agg(F.min("above").alias("low"), F.max("above").alias("high"), F.max("below").alias("below")) \
        .where("low <> high or low is not null and below").isEmpty()


def least_reached(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of some edges, and the smallest node each reaches by them."""
    nodes, at = np.unique(np.r_[u, v], return_inverse=True)
    i, j = at[:len(u)], at[len(u):]
    root = np.arange(len(nodes))
    while True:
        x, y = root[i], root[j]
        if (x == y).all():
            return nodes, nodes[root]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while (root[root] != root).any():
            root = root[root]


def _stars_of_tasks(links: DataFrame) -> DataFrame:
    """Edges that connect what the given ones do, FLUSH edges of a task at a time as stars; a star's root has an edge to itself."""
    most = FLUSH  # as the driver has it

    def connect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append([batch.column(i).to_numpy(zero_copy_only=False) for i in range(2)])
            size += batch.num_rows
            if size >= most:
                yield stars(held)
                held, size = [], 0
        if size:
            yield stars(held)

    def stars(held: list) -> pa.RecordBatch:
        nodes, roots = least_reached(*map(np.concatenate, zip(*held)))
        return pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(roots)], ["u", "v"])

    return links.mapInArrow(connect, "u long, v long")


def _large_star(links: DataFrame) -> DataFrame:
    both = links.union(links.where("u <> v").select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    larger = both.where("v >= u").join(least.hint("merge"), "u")
    return larger.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    joined = links.join(least.hint("merge"), "u").select("u", "v", "m")
    up = joined.select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = joined.select("u", F.col("m").alias("v"))
    return own.union(up).where("u >= v")
