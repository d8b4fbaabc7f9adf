"""Nearest neighbours by inner product through a hierarchical k-means tree, best bin first.

* The tree is fitted on the driver to a sample (the vectors whose id hashes lowest, repeats left out): ``SAMPLE`` vectors, or 16 for
  each leaf, at most ``SAMPLE_MOST``; every vector is then sent down it to a leaf. It has about 2 * rows ** 0.5 leaves, at
  most ``SAMPLE_MOST / 16``, so its size is bounded and it may be broadcast.
* A query walks the tree with a priority queue of nodes, the most promising first (inner product with the node's centre plus
  ``SPREAD`` times the query's length times the node's mean radius), and visits leaves in the order in which they come up.
* How many leaves to visit is calibrated: the exact neighbours of up to ``CALIBRATION`` queries are found by brute
  force over all vectors, and visits are widened until ``RECALL`` of them stand in visited leaves. A query whose leaves hold
  too few vectors goes on until they hold enough.
* Leaves that follow each other in the tree share a bin of about ``BLOCK`` vectors; a query goes to a bin once, with the
  numbers of the leaves it visits there. A leaf of more vectors is cut into bins, and a bin that very many queries visit meets them
  in parts, so no task holds more than a bin and ``ASKS`` queries; each hands on its best k for each query.
* Before it goes to the bins, a query is held against the sample: with a sample of s of n vectors its k-th best score is, by all
  odds, over that of rank k s / n + 3 (k s / n) ** 0.5 + 4 in the sample. Bins hand on nothing below that, so what is handed on
  doesn't grow with the number of bins. Should a query find fewer than k this way, it is asked again without.
* A matrix product picks candidates, with a margin for its rounding; those are scored again one by one, in an order of summation
  that depends on nothing but the vectors' length. So scores and ties don't depend on how rows were dealt.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import Workspace
from .words import tidy

SAMPLE, SAMPLE_MOST, BRANCHES, CALIBRATION, RECALL, SPREAD, BLOCK, ASKS = 20_000, 200_000, 8, 128, 0.95, 0.5, 2048, 1024
K, EVERY = 20, 20


@dataclass
class Tree:
    """Nodes of the tree; node 0 is the root. ``leaf`` numbers the leaves, -1 for inner nodes."""

    centre: np.ndarray
    radius: np.ndarray
    children: list[list[int]]
    leaf: np.ndarray

    @property
    def leaves(self) -> int:
        return int(self.leaf.max()) + 1

    def assign(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each row: the nearest centre on each level."""
        out = np.full(len(x), -1, np.int64)
        todo = [(0, np.arange(len(x)))]
        while todo:
            node, rows = todo.pop()
            if self.leaf[node] >= 0:
                out[rows] = self.leaf[node]
                continue
            below = np.array(self.children[node])
            best = _nearest(x[rows], self.centre[below])
            todo += [(int(below[j]), rows[best == j]) for j in range(len(below)) if (best == j).any()]
        return out

    def visits(self, q: np.ndarray) -> Iterator[int]:
        """Leaves in the order in which a query visits them."""
        length = float(np.linalg.norm(q))
        queue = [(0.0, 0)]
        while queue:
            _, node = heapq.heappop(queue)
            if self.leaf[node] >= 0:
                yield int(self.leaf[node])
                continue
            below = self.children[node]
            promise = self.centre[below] @ q + SPREAD * length * self.radius[below]
            for j, c in enumerate(below):
                heapq.heappush(queue, (-float(promise[j]), c))


def _nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    out = np.empty(len(x), np.int64)
    norm = (centres**2).sum(axis=1) / 2
    for i in range(0, len(x), 8192):
        out[i : i + 8192] = (x[i : i + 8192] @ centres.T - norm).argmax(axis=1)
    return out


def _kmeans(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 10) -> np.ndarray:
    centres = x[rng.choice(len(x), k, replace=False)]
    for _ in range(rounds):
        best = _nearest(x, centres)
        count = np.bincount(best, minlength=k)
        sums = np.zeros_like(centres)
        np.add.at(sums, best, x)
        centres = np.where(count[:, None] > 0, sums / np.maximum(count, 1)[:, None], centres)
    return best


def build_tree(x: np.ndarray, leaf_rows: int, branches: int = BRANCHES, seed: int = 7) -> Tree:
    """Splits rows by k-means until a node has at most ``leaf_rows`` of them."""
    rng = np.random.default_rng(seed)
    centre, radius, children, leaf = [], [], [], []
    leaves = 0

    def grow(rows: np.ndarray) -> int:
        nonlocal leaves
        node = len(centre)
        centre.append(x[rows].mean(axis=0) if len(rows) else np.zeros(x.shape[1]))
        radius.append(float(np.sqrt(((x[rows] - centre[node]) ** 2).sum(axis=1).mean())) if len(rows) else 0.0)
        children.append([])
        leaf.append(-1)
        k = min(branches, -(-len(rows) // leaf_rows))
        if k > 1:
            best = _kmeans(x[rows], k, rng)
            parts = [rows[best == j] for j in range(k) if (best == j).any()]
            if len(parts) > 1:
                children[node] = [grow(p) for p in parts]
                return node
        leaf[node] = leaves
        leaves += 1
        return node

    grow(np.arange(len(x)))
    return Tree(np.array(centre), np.array(radius), children, np.array(leaf))


def usable(vector: Column) -> Column:
    """Neither null nor zero, and all components finite."""
    finite = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return vector.isNotNull() & finite & F.exists(vector, lambda v: v != 0)


def _matrix(column: pa.Array) -> np.ndarray:
    """The rows of a list column, all of one length, in double precision."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def scores(query: np.ndarray, x: np.ndarray) -> np.ndarray:
    """The inner product of a query with each row, each summed in the same order whatever the number of rows."""
    return np.add.reduce(np.ascontiguousarray(x * query), axis=1)


def _best(queries: np.ndarray, query_ids: np.ndarray, x: np.ndarray, ids: np.ndarray, k: int, asked: np.ndarray | None = None, leaf: np.ndarray | None = None, floor: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query_id, vec_id, score) of each query's k best rows but its own, ties to the smaller id.

    With ``asked`` (query, leaf pairs as rows, sorted by leaf) and the rows' ``leaf`` (sorted) only rows of asked leaves count;
    with ``floor`` (for each query) only scores from there on.
    """
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    length = float(np.sqrt((x * x).sum(axis=1).max())) if len(x) else 0.0
    rough = np.full((len(queries), len(x)), -np.inf) if asked is not None else queries @ x.T
    if asked is not None:
        starts = np.append(np.flatnonzero(np.append(True, leaf[1:] != leaf[:-1])), len(leaf)) if len(leaf) else np.zeros(1, np.int64)
        for a, b in zip(starts[:-1], starts[1:], strict=True):
            lo, hi = np.searchsorted(asked[:, 1], [leaf[a], leaf[a] + 1])
            who = asked[lo:hi, 0]
            rough[who, a:b] = queries[who] @ x[a:b].T
    for j, row in enumerate(rough):
        row[ids == query_ids[j]] = -np.inf
        found = int(np.isfinite(row).sum())
        if not found:
            continue
        edge = np.partition(row, len(row) - min(k, found))[len(row) - min(k, found)]
        margin = 1e-9 * length * float(np.linalg.norm(queries[j]))
        some = np.flatnonzero((row >= max(edge, -np.inf if floor is None else floor[j]) - margin) & np.isfinite(row))
        exact = scores(queries[j], x[some])
        at = np.lexsort((ids[some], -exact))[:k]
        out.append((np.full(len(at), query_ids[j]), ids[some[at]], exact[at]))
    return tuple(np.concatenate([o[c] for o in out]) if out else np.zeros(0, (np.int64, np.int64, float)[c]) for c in range(3))


FOUND = "query_id long, vec_id long, score double"


def _found(parts: tuple[np.ndarray, np.ndarray, np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(parts[0], pa.int64()), pa.array(parts[1], pa.int64()), pa.array(parts[2], pa.float64())], names=["query_id", "vec_id", "score"])


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def exact_neighbours(rows: DataFrame, ids: np.ndarray, queries: np.ndarray, k: int) -> DataFrame:
    """Brute force: a bounded number of queries against every row (vec_id, vector), block by block."""
    sent = rows.sparkSession.sparkContext.broadcast((ids, queries))

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, q = sent.value
        for batch in batches:
            for i in range(0, len(batch), BLOCK):
                part = batch.slice(i, BLOCK)
                yield _found(_best(q, own, _matrix(part.column("vector")), part.column("vec_id").to_numpy(), k))

    return _ranked(rows.select("vec_id", "vector").mapInArrow(run, FOUND), k)


def bins(held: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray]:
    """(first bin, number of bins) of each leaf: leaves that follow each other share a bin up to ``block`` vectors; a leaf with
    more has bins of its own."""
    first, many = np.zeros(len(held), np.int64), np.ones(len(held), np.int64)
    at, size = 0, 0
    for i, n in enumerate(held.tolist()):
        if size and size + n > block:
            at, size = at + 1, 0
        first[i], many[i] = at, max(1, -(-n // block))
        size += n
        if many[i] > 1:
            at, size = at + int(many[i]), 0
    return first, many


def search(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", query: Column | None = None, k: int = K, sample: int = SAMPLE, leaves: int | None = None, recall: float = RECALL, block: int = BLOCK, asks: int = ASKS, stats: dict | None = None) -> DataFrame:
    """Each query's k nearest rows found: query_id, rank (from 1), vec_id, score (inner product in double precision).

    ``query``: condition on the table for a row to be a query (by default: id divisible by 20); every other row is its candidate,
    rows with its own id are not. Largest inner product first, ties to the smaller id; all candidates if there are fewer
    than k. Null and zero vectors, vectors with a null or non-finite component or of another length than most in the sample, and
    rows with a null id take no part, as query or candidate. A repeated id is a candidate once for each row and one query for each row
    with the results of the first. Tables without queries or candidates give an empty result. Other columns are not read.
    ``stats`` is given leaves, visits and recall (of the calibration queries).
    """
    spark = table.sparkSession
    work = Workspace(spark)
    query = F.col(id_col) % EVERY == 0 if query is None else query
    rows = table.where(F.col(id_col).isNotNull() & usable(F.col(vector_col))).select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"), F.coalesce(query, F.lit(False)).alias("is_query"))
    nothing = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    total = rows.count()
    if not total:
        return nothing
    leaves = max(1, min(SAMPLE_MOST // 16, round(2 * total**0.5))) if leaves is None else leaves
    sample = min(SAMPLE_MOST, max(sample, 16 * leaves))
    order = F.pmod(F.xxhash64(F.lit("fit"), "vec_id"), F.lit(1 << 40))
    drawn = rows.where(order < int((1 << 40) * min(1.0, 1.2 * sample / total))).orderBy(order, "vec_id").limit(sample).select("vector").toArrow().column(0).combine_chunks()
    if not len(drawn):
        drawn = rows.limit(1).select("vector").toArrow().column(0).combine_chunks()
    lengths = np.diff(drawn.offsets.to_numpy())
    dim = int(np.bincount(lengths).argmax())
    rows = rows.where(F.size("vector") == dim)
    seen = _matrix(drawn.filter(pa.array(lengths == dim)))
    x = np.unique(seen, axis=0)
    tree = build_tree(x, max(16, -(-len(x) // leaves)) if leaves > 1 else len(x))
    sent = spark.sparkContext.broadcast(tree)

    @tidy
    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                leaf = pa.array(sent.value.assign(_matrix(batch.column("vector"))).astype(np.int32))
                yield pa.RecordBatch.from_arrays([*batch.columns, leaf], names=["vec_id", "vector", "is_query", "leaf"])

    index = work.put(rows.mapInArrow(assign, "vec_id long, vector array<double>, is_query boolean, leaf int"), "index")
    held = np.zeros(tree.leaves, np.int64)
    for r in index.groupBy("leaf").agg(F.count("*").alias("n")).collect():  # a row for each leaf
        held[r["leaf"]] = r["n"]
    asked = index.where("is_query").select(F.col("vec_id").alias("query_id"), F.col("vector").alias("query")).dropDuplicates(["query_id"])
    some = asked.orderBy(F.xxhash64(F.lit("calibrate"), "query_id"), "query_id").limit(CALIBRATION).collect()
    if not some:
        return nothing
    depth, reached = calibrate(index, tree, np.array([r["query_id"] for r in some]), np.array([r["query"] for r in some]), k, recall)
    if stats is not None:
        stats |= {"leaves": tree.leaves, "visits": depth, "recall": reached, "calibrated_on": [r["query_id"] for r in some]}
    first, many = bins(held, block)
    seen = seen[: SAMPLE].astype(np.float32)
    share = k * min(1.0, len(seen) / total)
    floor_rank = int(np.ceil(share + 3 * share**0.5)) + 4
    ways = spark.sparkContext.broadcast((held, depth, first, many, seen))

    @tidy
    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row for each query and bin that it visits, with the numbers of the leaves and the score below which nothing counts."""
        counts, visits, at_bin, n_bins, sample_rows = ways.value
        for batch in batches:
            at, to, which, least = [], [], [], []
            for i, q in enumerate(_matrix(batch.column("query")) if len(batch) else ()):
                n, mine = 0, {}
                for v, leaf in enumerate(sent.value.visits(q)):
                    if v >= visits and n > k:
                        break
                    for b in range(at_bin[leaf], at_bin[leaf] + n_bins[leaf]):
                        mine.setdefault(b, []).append(leaf)
                    n += counts[leaf]
                near = sample_rows @ q.astype(np.float32)
                floor = float(np.partition(near, len(near) - floor_rank)[len(near) - floor_rank]) if len(near) > floor_rank else -np.inf
                at += [i] * len(mine)
                to += list(mine)
                which += list(mine.values())
                least += [floor - 1e-4 * abs(floor)] * len(mine)  # the sample is held in single precision
            if at:
                yield pa.RecordBatch.from_arrays([batch.column("query_id").take(pa.array(at)), batch.column("query").take(pa.array(at)), pa.array(to, pa.int32()), pa.array(which, pa.list_(pa.int32())), pa.array(least, pa.float64())], names=["query_id", "query", "bin", "leaves", "floor"])

    steps = work.put(asked.mapInArrow(walk, "query_id long, query array<double>, bin int, leaves array<int>, floor double"), "steps")
    parts = np.ones(int((first + many).max()), np.int64)
    for r in steps.groupBy("bin").agg(F.count("*").alias("n")).collect():  # a row for each bin
        parts[r["bin"]] = -(-r["n"] // asks)
    leaf_ways = F.broadcast(spark.createDataFrame([(i, int(a), int(m)) for i, (a, m) in enumerate(zip(first, many, strict=True))], "leaf int, _first int, _many int"))
    bin_ways = F.broadcast(spark.createDataFrame([(i, int(n)) for i, n in enumerate(parts)], "bin int, _parts int"))
    place = lambda c, n: F.pmod(F.xxhash64(F.lit("block"), F.col(c)), F.col(n)).cast("int")
    vectors = index.join(leaf_ways, "leaf").withColumn("bin", F.col("_first") + place("vec_id", "_many")).join(bin_ways, "bin").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)))
    vectors = vectors.select("bin", "part", "leaf", F.lit(1).alias("kind"), F.col("vec_id").alias("id"), "vector", F.lit(None).cast("array<int>").alias("leaves"), F.lit(0.0).alias("floor"))

    @tidy
    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, q_ids, q, want, floors, asked_leaves = None, [], [], [], [], None
        for batch in batches:
            if not len(batch):
                continue
            keys = np.stack([batch.column(c).to_numpy() for c in ("bin", "part", "kind")], axis=1)
            edges = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(batch)]
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                key, kind = tuple(keys[a, :2].tolist()), keys[a, 2]
                part = batch.slice(a, b - a)
                if key != now:
                    now, q_ids, q, want, floors, asked_leaves = key, [], [], [], [], None
                if kind == 0:
                    q_ids.append(part.column("id").to_numpy())
                    q.append(_matrix(part.column("vector")))
                    want += part.column("leaves").to_pylist()
                    floors.append(part.column("floor").to_numpy())
                elif q:
                    if asked_leaves is None:
                        pairs = np.array([(i, leaf) for i, mine in enumerate(want) for leaf in mine], np.int64).reshape(-1, 2)
                        asked_leaves = pairs[np.argsort(pairs[:, 1], kind="stable")]
                        every, own = np.concatenate(q), np.concatenate(q_ids)
                    yield _found(_best(every, own, _matrix(part.column("vector")), part.column("id").to_numpy(), k, asked_leaves, part.column("leaf").to_numpy(), np.concatenate(floors)))

    def ask(some: DataFrame, name: str) -> DataFrame:
        asking = some.join(bin_ways, "bin").withColumn("part", place("query_id", "_parts"))
        both = vectors.unionByName(asking.select("bin", "part", F.lit(-1).alias("leaf"), F.lit(0).alias("kind"), F.col("query_id").alias("id"), F.col("query").alias("vector"), "leaves", "floor"))
        return work.put(_ranked(both.repartition("bin", "part").sortWithinPartitions("bin", "part", "kind", "leaf").mapInArrow(meet, FOUND), k), name)

    found = ask(steps, "found")
    full = found.groupBy("query_id").agg(F.count("*").alias("n")).where(F.col("n") >= min(k, total))
    rest = steps.join(full, "query_id", "left_anti").withColumn("floor", F.lit(float("-inf")))
    if not rest.isEmpty():  # their k-th best is under the floor, or there are fewer than k in all
        found = found.join(full, "query_id", "left_semi").unionByName(ask(rest, "found-again"))
    return found.select("query_id", F.col("rank").cast("int"), "vec_id", "score")


def calibrate(index: DataFrame, tree: Tree, ids: np.ndarray, queries: np.ndarray, k: int, recall: float) -> tuple[int, float]:
    """(leaves to visit, recall reached with them on the calibration queries)."""
    true = exact_neighbours(index, ids, queries, k).join(index.select("vec_id", "leaf"), "vec_id").select("query_id", "leaf").collect()
    place = {int(i): {leaf: n for n, leaf in enumerate(tree.visits(q))} for i, q in zip(ids, queries, strict=True)}
    needed = np.sort([place[r["query_id"]][r["leaf"]] + 1 for r in true])
    if not len(needed):
        return 1, 1.0
    depth = int(needed[min(len(needed) - 1, int(np.ceil(recall * len(needed))) - 1)])
    return depth, float((needed <= depth).mean())


def op2_ann(spark, sf_dir: str) -> DataFrame:
    return search(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
