"""Connected components of a table of links, by large-star and small-star steps; a few links are joined in one task."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Workspace
from .words import tidy

MOST_ROUNDS = 60
#: Up to so many different links (16 bytes each) are joined in one task, which saves some ten Spark jobs a round.
FEW = 100_000


def _mark(links: DataFrame) -> tuple:
    r = links.agg(F.count("*").alias("n"), F.sum((F.xxhash64("a", "b") % (1 << 40)).cast("decimal(38,0)")).alias("h")).first()
    return r["n"], r["h"]


@tidy
def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, component) of all links at once, by union-find; the smaller root stays."""
    root: dict[int, int] = {}

    def top(x: int) -> int:
        while (up := root.setdefault(x, x)) != x:
            root[x] = x = root[up]
        return x

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            a, b = top(a), top(b)
            root[max(a, b)] = min(a, b)
    yield pa.RecordBatch.from_arrays([pa.array(list(root), pa.int64()), pa.array([top(x) for x in list(root)], pa.int64())], names=["node", "component"])


def components(links: DataFrame, work: Workspace, name: str = "components", few: int = FEW) -> DataFrame:
    """(node, component): the smallest node that a node of any link reaches. links: a, b (64-bit numbers; loops and repeats
    are allowed). Nodes without links are not returned.

    At most ``few`` links are joined in one task. Of more, each step points nodes at smaller ones that they reach; steps end when no link changes, after about log2 of
    the longest chain. A node with very many links is combined where its links are read, and its join is split by AQE.
    """
    at = work.put(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), f"{name}-0")
    nodes = at.select(F.col("a").alias("node")).union(at.select("b")).distinct()
    mark = _mark(at)
    if mark[0] <= few:
        return at.coalesce(1).mapInArrow(_joined, "node long, component long")
    for i in range(1, MOST_ROUNDS + 1):
        if not mark[0]:
            break
        # large star: every larger neighbour of a node points at the least of its neighbourhood
        both = at.union(at.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # (written, so that the join deals both sides anew and AQE can split a node with very many links)
        least = work.put(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), f"{name}-least-{i}")
        large = both.where("b > a").join(least.hint("merge"), "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        # small star: a node and its smaller neighbours point at the least of these
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least.hint("merge"), "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
        at = work.put(small.where("a <> b").distinct(), f"{name}-{i}")
        if (now := _mark(at)) == mark:
            break
        mark = now
    else:
        raise RuntimeError("components did not settle")
    roots = at.groupBy("a").agg(F.min("b").alias("b"))
    return nodes.join(roots.hint("merge"), F.col("node") == F.col("a"), "left").select("node", F.coalesce("b", "node").alias("component"))
