"""Connected components of an edge table by alternating large and small stars.

Every round is two joins and two aggregations over edges that never grow in number; edges and the least neighbours are
checkpointed, so that both sides of each join are plain shuffles which adaptive execution can split where a node has very
many edges. Only a count and a checksum come to the driver. Small edge tables are kept in few files: a round's tables have
at most a partition for every ``ROWS`` edges.

A table of at most ``ONE_TASK`` distinct edges (16 MB of numbers, counted first) is closed by one task instead: the rounds
of joins cost hundreds of stages, whatever the table's size. Both ways give the same rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import compact, cut_lineage, map_arrow

ROWS = 100_000
ONE_TASK = 1 << 20


def _checksum(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())


def _star(edges: DataFrame, large: bool, parts: int) -> DataFrame:
    """Large: larger neighbours of u go to its least neighbour (or u). Small: smaller ones and u do."""
    if large:
        sided = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a"))
    else:
        sided = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = cut_lineage(sided.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m")).coalesce(parts))
    moved = sided.join(least, "u")
    if large:
        out = moved.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        out = moved.select(F.col("v").alias("a"), F.col("m").alias("b")).union(least.select("u", "m"))
    return cut_lineage(out.where("a <> b").coalesce(parts).distinct().coalesce(parts))


def _closed(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of all edges, in order, and the least node that each can reach."""
    nodes, at = np.unique(np.concatenate((a, b)), return_inverse=True)
    root, u, v = np.arange(len(nodes)), at[: len(a)], at[len(a) :]
    while True:
        low, high = np.minimum(root[u], root[v]), np.maximum(root[u], root[v])
        apart = low < high
        if not apart.any():
            return nodes, nodes[root]
        np.minimum.at(root, high[apart], low[apart])
        while not np.array_equal(up := root[root], root):
            root = up
        u, v = u[apart], v[apart]


def _in_one_task(edges: DataFrame) -> DataFrame:
    def run(batches):
        held = [(np.asarray(b.column(0), np.int64), np.asarray(b.column(1), np.int64)) for b in batches if b.num_rows]
        if held:
            node, root = _closed(*(np.concatenate(x) for x in zip(*held)))
            yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(root)], names=["node", "root"])

    return cut_lineage(map_arrow(edges.coalesce(1), run, "node long, root long"))


def components(edges: DataFrame, one_task: int = ONE_TASK) -> DataFrame:
    """(node, root) of every node that has an edge; the root is the least node it can reach, roots included."""
    edges = cut_lineage(edges.select("a", "b").where("a <> b").distinct())
    n = edges.count()
    if n <= one_task:
        return _in_one_task(edges)
    edges, before = edges.coalesce(1 + n // ROWS), None
    while (now := _checksum(edges)) != before:
        before = now
        parts = 1 + now[0] // ROWS
        edges = _star(_star(edges, True, parts), False, parts)
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(edges.select("b", "b"))
    return compact(roots.distinct())
