"""Near-duplicate documents by MinHash bands and odd sketches, confirmed on full shingle sets.

1. One pass over the texts: the set of distinct 5-word shingles of each (as 64-bit hashes), its size, a 128-bit fingerprint,
   ``SAMPLES`` MinHash samples of which the first ``BANDS * ROWS`` make the band keys, and all are folded into an odd
   sketch: each sample flips one bit of a ``BITS``-bit map, so that equal samples of two documents cancel out in the XOR.
   Texts with the same set are one class from here on, numbered when the classes are written; links are between classes, never
   between ids, which may repeat.
2. Classes that share a band key are candidates. Band keys held by one class are dropped. In a bucket the sketches are
   compared: with d the share of bits set in the XOR of two sketches, 1 + BITS * ln(1 - 2 d) / (4 SAMPLES) estimates the
   similarity. Of the pairs over ``SKETCH_AT`` (6 standard errors under the threshold) only a spanning forest is handed on:
   candidate groups, not pairs.
3. Candidate groups are the components of those forests. Their texts are read once more for the sets, and pairs over SKETCH_AT whose
   ends aren't yet linked are confirmed on the full sets, so exactly the links that matter for components are looked at, however
   many copies there are.
4. Components of the confirmed links; a component's id is the smallest id of its classes' rows.

A bucket or group of more than a block of classes (``spanned``) is dealt out by block, a member to one task, with about
``PIVOTS`` of the group's members in every task as common ground. Most of a family of copies are linked to the same pivots there. Only
members that aren't go on to meet the other blocks, ``block`` of them at a time; so a large family moves once, not once for
each of its blocks, and no pair is left out.

Two steps can lose a link. A pair of similarity 0.75 shares no band with a chance of (1 - 0.75^4)^32 = 5e-6, and its sketches
estimate less than SKETCH_AT with a chance of 9e-7 (2e-7 at 0.76; computed from the law of odd bits for ideal hashing). Two
shingles count as equal if their 64-bit hashes are (5e-20 for a pair of shingles; the hash has no known structure to collide).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Workspace, by_key, fresh
from .components import components
from .words import _table, shingle_sets, tidy

BANDS, ROWS, SAMPLES, BITS = 32, 4, 256, 512
SIMILAR, OUT_OF = 75, 100
SKETCH_AT = 0.55
#: Classes in a block of a bucket; classes and shingles in one of a candidate group; members of a group that all its blocks see.
BLOCK, GROUP_MEMBERS, GROUP_WORDS, PIVOTS = 256, 128, 500_000, 16
_MULTIPLY = (_table(101, SAMPLES) >> np.uint64(20)).astype(np.uint32) | np.uint32(1)
_ADD = (_table(103, SAMPLES) >> np.uint64(20)).astype(np.uint32)
_COUNT = np.array([bin(i).count("1") for i in range(256)], np.uint8)
SIGNATURES = "id long, mark binary, n long, print binary, keys array<long>, sketch binary"


def samples(shingles: np.ndarray) -> np.ndarray:
    """MinHash: the least value of each of SAMPLES random maps over the set."""
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    out = np.full(SAMPLES, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(x), 512):
        out = np.minimum(out, (x[None, i : i + 512] * _MULTIPLY[:, None] + _ADD[:, None]).min(axis=1))
    return out


def band_keys(sample: np.ndarray) -> np.ndarray:
    """One 64-bit key for each band, different between bands."""
    s = sample[..., : BANDS * ROWS].reshape(*sample.shape[:-1], BANDS, ROWS).astype(np.uint64)
    place = _table(107, ROWS)
    with np.errstate(over="ignore"):
        x = (s * place).sum(axis=-1, dtype=np.uint64) + _table(109, BANDS)
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        return (x ^ (x >> np.uint64(32))).view(np.int64)


def odd_sketch(sample: np.ndarray) -> np.ndarray:
    """The parity bitmap, packed, of (place, value) of all samples."""
    with np.errstate(over="ignore"):
        x = (sample.astype(np.uint64) + (np.arange(SAMPLES, dtype=np.uint64) << np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    bit = ((x ^ (x >> np.uint64(31))) * np.uint64(0x94D049BB133111EB) >> np.uint64(64 - BITS.bit_length() + 1)).astype(np.int64)
    return np.packbits((np.bincount(bit, minlength=BITS) & 1).astype(np.uint8))


def estimate(one: np.ndarray, many: np.ndarray) -> np.ndarray:
    """Estimated similarity of one sketch (bytes) to many (rows of bytes)."""
    flips = _COUNT[many ^ one].sum(axis=1, dtype=np.int64)
    return _ESTIMATE[flips]


_ESTIMATE = 1 + BITS / (4 * SAMPLES) * np.log(np.maximum(1 - 2 * np.arange(BITS + 1) / BITS, 1e-9))


def fingerprint(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


@tidy
def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From (id, mark, text)."""
    names = ["id", "mark", "n", "print", "keys", "sketch"]
    for batch in batches:
        n, prints, keys, sketches, start = [], [], [], [], 0
        for i, s in enumerate(shingle_sets(batch.column(2))):
            n.append(len(s))
            prints.append(fingerprint(s))
            if len(s):
                m = samples(s)
                keys.append(band_keys(m))
                sketches.append(odd_sketch(m).tobytes())
            else:
                keys.append([])
                sketches.append(b"")
            if len(n) == 2000 or i + 1 == len(batch):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, len(n)), batch.column(1).slice(start, len(n)), pa.array(n, pa.int64()), pa.array(prints, pa.binary()), pa.array([list(k) for k in keys], pa.list_(pa.int64())), pa.array(sketches, pa.binary())], names=names)
                start += len(n)
                n, prints, keys, sketches = [], [], [], []


Rows = dict[str, np.ndarray]


def _arrays(batch: pa.RecordBatch) -> Rows:
    out: Rows = {}
    for name, column in zip(batch.schema.names, batch.columns, strict=True):
        if name == "sketch":
            ends = np.frombuffer(column.buffers()[1], np.int32, len(column) + 1, column.offset * 4)
            out[name] = np.frombuffer(column.buffers()[2], np.uint8)[ends[0] : ends[-1]].reshape(len(column), BITS // 8)
        elif name == "words":
            out[name] = np.empty(len(column), object)
            out[name][:] = column.to_pylist()
        else:
            out[name] = pc.fill_null(column, -2).to_numpy(zero_copy_only=False) if name == "label" else column.to_numpy(zero_copy_only=False)
    return out


def _cut(rows: Rows, at) -> Rows:
    return {c: x[at] for c, x in rows.items()}


def _runs(batches: Iterator[pa.RecordBatch], by: list[str]) -> Iterator[tuple[Rows, Rows | None]]:
    """(rows, None) of each value of ``by``, which stand together; or (first rows, second rows) of many values that have just two."""
    held: list[Rows] = []
    last = None
    for batch in batches:
        if not len(batch):
            continue
        rows = _arrays(batch)
        keys = np.stack([rows[c] for c in by], axis=1)
        bounds = np.concatenate([[0], np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1, [len(batch)]])
        if held and last != tuple(keys[0].tolist()):
            yield _whole(held), None
            held = []
        start = 0
        if held:
            held.append(_cut(rows, slice(0, bounds[1])))
            start = 1
            if len(bounds) > 2:
                yield _whole(held), None
                held = []
        inner = bounds[start:-1]  # the last one may go on in the next batch
        if len(inner):
            size = np.diff(inner)
            two = inner[:-1][size == 2]
            if len(two):
                yield _cut(rows, two), _cut(rows, two + 1)
            for i in np.flatnonzero(size != 2).tolist():
                yield _cut(rows, slice(inner[i], inner[i + 1])), None
            held = [_cut(rows, slice(inner[-1], bounds[-1]))]
        last = tuple(keys[-1].tolist())
    if held:
        yield _whole(held), None


def _whole(parts: list[Rows]) -> Rows:
    return parts[0] if len(parts) == 1 else {c: np.concatenate([p[c] for p in parts]) for c in parts[0]}


class Forest:
    """Union-find over 0..n-1."""

    def __init__(self, n: int) -> None:
        self.root = np.arange(n)

    def join(self, a: int, b: np.ndarray) -> None:
        roots = np.unique(np.append(self.root[b], self.root[a]))
        self.root[np.isin(self.root, roots)] = roots[0]


class Similar:
    """Members of a block: which of those after i are near it, by sketch and, if there are sets, by the sets themselves."""

    def __init__(self, size: np.ndarray, sketch: np.ndarray, sets: list[np.ndarray] | None) -> None:
        self.size, self.sketch, self.sets = size, sketch, sets
        if sets is not None:
            self.ends = np.concatenate([[0], np.cumsum(size)])
            values, number = np.unique(np.concatenate(sets), return_inverse=True)
            self.number, self.marked = number.astype(np.int32), np.zeros(len(values), bool)

    def near(self, i: int, rest: np.ndarray) -> np.ndarray:
        size = self.size
        rest = rest[(size[rest] * OUT_OF >= SIMILAR * size[i]) & (size[i] * OUT_OF >= SIMILAR * size[rest])]
        if len(rest):
            rest = rest[estimate(self.sketch[i], self.sketch[rest]) >= SKETCH_AT]
        if not len(rest) or self.sets is None:
            return rest
        ends, number = self.ends, self.number
        own = number[ends[i] : ends[i + 1]]
        self.marked[own] = True
        if len(rest) * 2 < len(size):
            span = np.concatenate([np.arange(ends[j], ends[j + 1]) for j in rest])
            both = np.add.reduceat(self.marked[number[span]].astype(np.int64), np.concatenate([[0], np.cumsum(size[rest])[:-1]]))
        else:  # most of them: in one go over all
            both = np.add.reduceat(self.marked[number].astype(np.int64), ends[:-1])[rest]
        self.marked[own] = False
        return rest[OUT_OF * both >= SIMILAR * (size[i] + size[rest] - both)]


def _members(rows: Rows) -> Similar:
    sets = [np.frombuffer(x, np.uint64) for x in rows["words"]] if "words" in rows else None
    return Similar(rows["n"], rows["sketch"], sets)


def _each(batches: Iterator[pa.RecordBatch], by: list[str]) -> Iterator[Rows]:
    for one, other in _runs(batches, by):
        if other is None:
            yield one
        else:
            for i in range(len(one["node"])):
                yield _whole([_cut(one, slice(i, i + 1)), _cut(other, slice(i, i + 1))])


def _span(order: np.ndarray, similar: Similar, forest: Forest, found: list[tuple[int, int]], until: int | None = None) -> None:
    """Compares each of ``order`` (the first ``until``, if given) with those after it in other trees; found: the edges that join trees."""
    for place, i in enumerate(order[:until].tolist()):
        rest = order[place + 1 :]
        near = similar.near(i, rest[forest.root[rest] != forest.root[i]])
        if len(near):
            _, once = np.unique(forest.root[near], return_index=True)  # one edge to each tree
            found += [(i, int(j)) for j in near[once]]
            forest.join(i, near)


SPANNED = "a long, b long, grp long, label long"


def _spanned_rows(edges: list[tuple[np.ndarray, np.ndarray]], left: list[tuple[int, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    """Links (a, b), and members (a) of a group that have no tree in common with its other blocks, with the pivot they hang on, if any."""
    a = np.concatenate([*(x for x, _ in edges), *(x for _, x, _ in left), np.zeros(0, np.int64)])
    links, open_ = sum(len(x) for x, _ in edges), sum(len(x) for _, x, _ in left)
    b = pa.concat_arrays([pa.array(np.concatenate([*(y for _, y in edges), np.zeros(0, np.int64)])), pa.nulls(open_, pa.int64())])
    grp = pa.concat_arrays([pa.nulls(links, pa.int64()), pa.array(np.concatenate([*(np.full(len(x), g) for g, x, _ in left), np.zeros(0, np.int64)]))])
    labels = np.concatenate([*(y for _, _, y in left), np.zeros(0, np.int64)])
    label = pa.concat_arrays([pa.nulls(links, pa.int64()), pa.array(labels, mask=labels < 0)])
    return pa.RecordBatch.from_arrays([pa.array(a), b, grp, label], names=["a", "b", "grp", "label"])


def _pairs(one: Rows, other: Rows) -> tuple[np.ndarray, np.ndarray]:
    """Links of groups of two members, by their sketches, all at once."""
    a, b = one["n"], other["n"]
    flips = _COUNT[one["sketch"] ^ other["sketch"]].sum(axis=1, dtype=np.int64)
    linked = (a * OUT_OF >= SIMILAR * b) & (b * OUT_OF >= SIMILAR * a) & (_ESTIMATE[flips] >= SKETCH_AT) & (one["node"] != other["node"])
    return one["node"][linked], other["node"][linked]


@tidy
def _inside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans each block of a group together with the group's pivots."""
    edges: list[tuple[np.ndarray, np.ndarray]] = []
    left: list[tuple[int, np.ndarray, np.ndarray]] = []

    def span(t: Rows) -> None:
        whole = t["blocks"][0] <= 1
        if len(t["node"]) < 2 and whole:
            return
        _, at = np.unique(t["node"], return_index=True)  # a class may have come from several rows
        t = _cut(t, at)
        node, pivot, similar = t["node"], t["pivot"], _members(t)
        forest, found = Forest(len(node)), []
        common = np.flatnonzero(pivot)
        _span(common, similar, forest, found)  # the same in every block of the group
        trees, counts = np.unique(forest.root[common], return_counts=True)
        anchor = int(common[forest.root[common] == trees[counts.argmax()]][0]) if len(common) else -1
        _span(np.concatenate([common, np.flatnonzero(~pivot)]), similar, forest, found)
        if found:
            edges.append((node[[i for i, _ in found]], node[[j for _, j in found]]))
        if not whole:
            away = np.flatnonzero(t["own"] & (forest.root != forest.root[anchor])) if anchor >= 0 else np.flatnonzero(t["own"])
            hangs = {int(forest.root[p]): int(node[p]) for p in common[::-1]}
            if len(away):
                left.append((int(t["grp"][0]), node[away], np.array([hangs.get(int(r), -1) for r in forest.root[away]], np.int64)))

    for one, other in _runs(batches, ["grp", "block"]):
        if other is None:
            span(one)
        elif "words" not in one and (one["blocks"] <= 1).all():
            edges.append(_pairs(one, other))
        else:
            for i in range(len(one["node"])):
                span(_whole([_cut(one, slice(i, i + 1)), _cut(other, slice(i, i + 1))]))
        if sum(len(x) for x, _ in edges) + sum(len(x) for _, x, _ in left) > 10_000:
            yield _spanned_rows(edges, left)
            edges.clear()
            left.clear()
    yield _spanned_rows(edges, left)


@tidy
def _across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans members that are left over (``asks``) with those of a block; who hangs on the same pivot is linked already."""
    edges: list[tuple[np.ndarray, np.ndarray]] = []
    for t in _each(batches, ["grp", "part", "block"]):
        order = np.lexsort((~t["asks"], t["node"]))
        _, first = np.unique(t["node"][order], return_index=True)  # one that asks may be of this block
        t = _cut(t, order[first])
        node, asks, label = t["node"], t["asks"], t["label"]
        if not asks.any() or len(node) < 2:
            continue
        similar, forest, found = _members(t), Forest(len(node)), []
        for x in np.unique(label[label != -2]):
            same = np.flatnonzero(label == x)
            forest.join(int(same[0]), same)
        asking = np.flatnonzero(asks)
        _span(np.concatenate([asking, np.flatnonzero(~asks)]), similar, forest, found, len(asking))
        if found:
            edges.append((node[[i for i, _ in found]], node[[j for _, j in found]]))
        if sum(len(x) for x, _ in edges) > 10_000:
            yield _spanned_rows(edges, [])
            edges = []
    yield _spanned_rows(edges, [])


def spanned(placed: DataFrame, sizes: DataFrame, about: DataFrame | None, work: Workspace, name: str, block: int) -> DataFrame:
    """Links (a, b) that span what is similar in each group.

    placed: grp, node and the members' other columns, or those in ``about`` by node. sizes: grp, members, blocks of the groups
    that count. ``about`` is joined after ``sizes``, so that members of no such group don't carry it along.

    Joins of two tables that both grow are shuffled (``merge``); Spark's estimates would have it broadcast exploded members.
    """
    numbers = lambda n: F.sequence(F.lit(0).cast("long"), F.col(n) - 1)
    of = lambda word, n: F.pmod(F.xxhash64(F.lit(word), "node"), F.col(n))

    def gather(groups: DataFrame) -> DataFrame:
        m = by_key(placed, groups, "grp", "members")
        return (m if about is None else m.join(about.hint("merge"), "node")).withColumn("_block", of("block", "blocks"))

    draw = F.pmod(F.xxhash64(F.lit("pivot"), "node"), F.lit(1 << 30)) / float(1 << 30)
    m = gather(sizes).withColumn("pivot", (F.col("blocks") > 1) & (draw < F.lit(float(PIVOTS)) / F.col("members")))
    m = m.withColumn("block", F.explode(F.when(F.col("pivot"), numbers("blocks")).otherwise(F.array("_block"))))
    m = m.withColumn("own", F.col("block") == F.col("_block")).drop("_block", "members")
    first = work.put(m.repartition("grp", "block").sortWithinPartitions("grp", "block").mapInArrow(_inside, SPANNED), f"{name}-inside")
    links, left = first.where("b is not null").select("a", "b"), first.where("b is null").select("grp", F.col("a").alias("node"), "label", F.lit(True).alias("asks"))
    asked = left.groupBy("grp").agg(F.ceil(F.count("*") / F.lit(block)).cast("long").alias("parts"))
    asked = work.put(sizes.join(asked.hint("merge"), "grp"), f"{name}-asked")
    if asked.isEmpty():
        return links
    # members without a tree in common with the other blocks meet all of them; the others hang together (label -1)
    m = gather(asked).join(left.hint("merge"), ["grp", "node"], "left").withColumn("asks", F.coalesce("asks", F.lit(False)))
    m = m.withColumn("label", F.when(F.col("asks"), F.col("label")).otherwise(-1)).drop("members")
    there = m.withColumn("part", F.explode(numbers("parts"))).withColumn("block", F.col("_block")).withColumn("asks", F.lit(False))
    going = m.where("asks").withColumn("part", of("part", "parts")).withColumn("block", F.explode(numbers("blocks")))
    both = there.unionByName(going).drop("_block", "blocks", "parts")
    second = both.repartition("grp", "part", "block").sortWithinPartitions("grp", "part", "block").mapInArrow(_across, SPANNED)
    return links.unionByName(work.put(second, f"{name}-across").select("a", "b"))


@tidy
def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(grp, node, n, sketch, words) from (text, print, grp, node, n, sketch): the sets of texts that have the class's fingerprint."""
    for batch in batches:
        at, words, size = [], [], 0
        rest = batch.drop_columns(["text", "print"])
        for i, (s, want) in enumerate(zip(shingle_sets(batch.column("text")), batch.column("print").to_pylist(), strict=True)):
            if fingerprint(s) == want:
                at.append(i)
                words.append(s.tobytes())
                size += len(words[-1])
            if words and (size > 4 << 20 or i + 1 == len(batch)):
                yield pa.RecordBatch.from_arrays([*rest.take(pa.array(at)).columns, pa.array(words, pa.binary())], names=["grp", "node", "n", "sketch", "words"])
                at, words, size = [], [], 0


def mark_of(text: Column) -> Column:
    """128 bits by which the texts of one id are told apart."""
    return F.unhex(F.concat(F.lpad(F.hex(F.xxhash64(text)), 16, "0"), F.lpad(F.hex(F.xxhash64(F.lit("mark"), text)), 16, "0")))


def _grouped(docs: DataFrame, id_col: str, text_col: str, block: int, group_members: int, group_words: int) -> DataFrame:
    """id, mark, n, component (smallest id reachable; null if none has an id) and grp (the component's number; null without words) of
    each row."""
    work = Workspace(docs.sparkSession)
    text = F.col(text_col)
    texts = docs.select(F.col(id_col).cast("long").alias("id"), mark_of(text).alias("mark"), text.alias("text"))
    rows = work.put(texts.mapInArrow(_signatures, SIGNATURES), "signatures")
    # numbers are given once, when the classes are written; any of a class's rows will do for its text
    classes = rows.where("n > 0").groupBy("print").agg(F.first("n").alias("n"), F.count("*").alias("copies"), F.min("id").alias("least"), F.min(F.struct("id", "mark")).alias("row"), F.first("sketch").alias("sketch"), F.first("keys").alias("keys"))
    classes = work.put(classes.withColumn("node", F.monotonically_increasing_id()), "classes")
    held = classes.select(F.explode("keys").alias("grp"), "node")
    shared = held.groupBy("grp").agg(F.count("*").alias("members")).where("members > 1").withColumn("blocks", F.ceil(F.col("members") / F.lit(block)).cast("long"))
    shared = work.put(shared, "shared")
    groups = components(spanned(held, shared, classes.select("node", "n", "sketch"), work, "near", block), work, "groups")
    members = classes.join(groups.hint("merge"), "node").select(F.col("component").alias("grp"), "node", "n", "sketch", "print", F.col("row.id").alias("id"), F.col("row.mark").alias("mark"))
    members = work.put(members, "members").withColumnsRenamed({"id": "_id", "mark": "_mark"})
    full = texts.join(members.hint("merge"), F.col("id").eqNullSafe(F.col("_id")) & (F.col("mark") == F.col("_mark"))).select("text", "print", "grp", "node", "n", "sketch")
    sets = work.put(full.mapInArrow(_sets, "grp long, node long, n long, sketch binary, words binary"), "sets")
    blocks = F.greatest(F.ceil(F.count("*") / F.lit(group_members)), F.ceil(F.sum("n") / F.lit(group_words)))
    sizes = work.put(sets.groupBy("grp").agg(F.count("*").alias("members"), blocks.cast("long").alias("blocks")), "sizes")
    links = components(spanned(sets, sizes, None, work, "links", group_members), work, "links")
    known = classes.select("print", "copies", "node", "least").join(links.hint("merge"), "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = known.groupBy("component").agg(F.min("least").alias("to"), F.count("*").alias("_classes"))
    known = by_key(known.select("print", "copies", "component"), work.put(least, "least"), "component", "_classes")
    known = work.put(known.select("print", "copies", F.col("to").alias("component"), F.col("component").alias("grp")), "known")
    some = by_key(rows.where("n > 0").select("id", "mark", "n", "print"), known, "print", "copies").select("id", "mark", "n", "component", "grp")
    return some.unionByName(rows.where("n = 0").select("id", "mark", "n", F.col("id").alias("component"), F.lit(None).cast("long").alias("grp")))


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK, group_members: int = GROUP_MEMBERS, group_words: int = GROUP_WORDS) -> DataFrame:
    """One row for each row of ``docs``: id, n_shingles, component_id (smallest id reachable over links, itself included), kept
    (id = component_id).

    Ids are 64-bit integers. A text of fewer than five words has its whole word sequence as its one shingle; null, empty and blank
    texts have none and link with nothing. Repeated rows have the same set, hence the same component; rows that repeat the
    smallest id are all kept, as nothing tells them apart, and rows that repeat an id with another text go by their own text. A
    row with a null id links as any other; its component is null, and it is kept, if no row that it reaches has an id. An empty table
    gives an empty result. Other columns are not read.
    """
    out = _grouped(docs, id_col, text_col, block, group_members, group_words)
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"), F.col("id").eqNullSafe(F.col("component")).alias("kept"))


def drop_near(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK, group_members: int = GROUP_MEMBERS, group_words: int = GROUP_WORDS) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: one of each group, and every row that links with nothing.

    Of a group the row with the smallest id stays; if several texts of the group have that id, the one with the smallest fingerprint, and
    of rows that repeat both one. A group without any id, and a text without words, keeps a row in the same way.
    """
    id_, mark, own, many = fresh(docs, "id", "mark", "own", "many")
    rows = _grouped(docs, id_col, text_col, block, group_members, group_words)
    some = rows.where("n > 0").groupBy("grp", "id", "mark").agg(F.count("*").alias("many"))
    row = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "mark", "many")).alias("row")
    picked = some.groupBy("grp").agg(row).select("row.id", "row.mark", "row.many")
    blank = rows.where("n = 0").select("id", "mark", F.lit(1).cast("long").alias("many")).distinct()
    picked = Workspace(docs.sparkSession).put(picked.union(blank).toDF(id_, mark, many), "picked")
    met = docs.withColumn(own, mark_of(F.col(text_col))).join(picked.hint("merge"), F.col(id_col).cast("long").eqNullSafe(F.col(id_)) & (F.col(own) == F.col(mark)))
    if picked.where(F.col(many) > 1).isEmpty():
        return met.select(*docs.columns)
    return met.where(F.col(many) == 1).select(*docs.columns).unionByName(met.where(F.col(many) > 1).dropDuplicates([id_, mark]).select(*docs.columns))


def op3_near_dedup(spark, sf_dir: str) -> DataFrame:
    return near_groups(spark.read.parquet(f"{sf_dir}/documents.parquet"))
