"""Sharding by a hierarchical weighted hash tree (DataFrame functions only).

A key descends region, rack and shard. On each level every child draws ``-ln(u) / weight`` with ``u`` hashed from
the key and the child's name, and the least draw wins, so a child gets its weight's share of keys. A draw depends on
nothing but the key, the child and the child's own weight: when a weight changes, keys move only into, out of or inside
the subtrees whose weights changed.

A tree grows by whole regions: ``balanced_tree(n + 1)`` leaves every region of ``balanced_tree(n)`` as it is and puts
the new shard into a region of its own when ``n`` fills the regions; then the new shard takes rows only into itself.
``grown_tree`` does that for any tree.
"""

from __future__ import annotations

import copy

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import running_start

#: region -> rack -> shard number -> weight
Tree = dict[str, dict[str, dict[int, float]]]
SHARDS, RACKS_IN_REGION, SHARDS_IN_RACK, OVERHEAD = 40, 2, 4, 16


def balanced_tree(shards: int, racks_in_region: int = RACKS_IN_REGION, shards_in_rack: int = SHARDS_IN_RACK) -> Tree:
    tree: Tree = {}
    for s in range(shards):
        rack = s // shards_in_rack
        tree.setdefault(f"region{rack // racks_in_region}", {}).setdefault(f"rack{rack}", {})[s] = 1.0
    return tree


def grown_tree(tree: Tree, weight: float = 1.0) -> Tree:
    """The tree with one more shard, in a new region; all that moves, moves into it."""
    new = copy.deepcopy(tree)
    number = max(s for racks in tree.values() for shards in racks.values() for s in shards) + 1
    new[f"added{number}"] = {f"added{number}": {number: weight}}
    return new


def _weight(node) -> float:
    return sum(_weight(x) for x in node.values()) if isinstance(node, dict) else float(node)


def _children(node: dict, path: str) -> Column:
    """A constant array of what can be drawn under a node; a child without weight takes no part."""
    made = [F.struct(F.lit(f"{path}/{name}").alias("name"), F.lit(_weight(child)).alias("weight"), F.lit(i).alias("at")) for i, (name, child) in enumerate(node.items()) if _weight(child) > 0]
    return F.array(*made) if made else F.array(F.struct(F.lit("").alias("name"), F.lit(1.0).alias("weight"), F.lit(0).alias("at")))


def _winner(key: Column, children: Column) -> Column:
    """The place of the child with the least draw."""

    def draw(child: Column) -> Column:
        u = (F.shiftrightunsigned(F.xxhash64(key, child["name"]), 11) + F.lit(0.5)) / F.lit(float(1 << 53))
        return F.struct((-F.log(u) / child["weight"]).alias("draw"), child["at"].alias("at"))

    return F.array_min(F.transform(children, draw))["at"]


def place(df: DataFrame, key: str, tree: Tree, name: str = "shard") -> DataFrame:
    """Adds the shard of each row, one draw for each child of the nodes on its way down."""
    if not _weight(tree) > 0:
        raise ValueError("no shard has a weight")
    k = F.col(key)
    racks = F.array(*[_children(node, region) for region, node in tree.items()])
    shards = F.array(*[F.array(*[_children(node, f"{region}/{rack}") for rack, node in below.items()]) for region, below in tree.items()])
    numbers = F.array(*[F.array(*[F.array(*[F.lit(int(s)) for s in node]) for node in below.values()]) for below in tree.values()])
    out = df.withColumn("_region", _winner(k, _children(tree, "")))
    out = out.withColumn("_rack", _winner(k, F.get(racks, F.col("_region"))))
    out = out.withColumn("_leaf", _winner(k, F.get(F.get(shards, F.col("_region")), F.col("_rack"))))
    return out.withColumn(name, F.get(F.get(F.get(numbers, F.col("_region")), F.col("_rack")), F.col("_leaf"))).drop("_region", "_rack", "_leaf")


def shard_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tree: Tree | None = None) -> DataFrame:
    """Law ``key``: one row for each row of ``docs`` with its shard, slot in the shard, and its shard after growth.

    size = UTF-8 bytes of the text + 16 (null and empty text: 16); text_crc32 of a null text is that of the empty one.
    A null id is a key like any other. Rows with the same id share a shard; they take neighbouring slots.
    Equal texts are not held together: only the id and the tree decide. An empty table gives an empty result.
    Columns other than the two named ones are not read.

    Slots are numbered in two levels (see ``running_start``), so no task holds a whole shard.
    """
    tree = tree or balanced_tree(SHARDS)
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("_id"), (F.octet_length(text).cast("long") + OVERHEAD).alias("size"), F.crc32(text).cast("long").alias("text_crc32"))
    rows = place(place(rows, "_id", tree, "shard"), "_id", grown_tree(tree), "grown_shard")
    rows = rows.withColumn("_key", F.xxhash64(F.lit("slot"), "_id", "text_crc32"))
    rows = running_start(rows, ["shard"], "_key", ["_id", "text_crc32", "size"], F.lit(1), "slot")
    return rows.select(F.col("_id").alias(id_col), "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def op7_sharding(spark, sf_dir: str) -> DataFrame:
    return shard_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
