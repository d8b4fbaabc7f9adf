"""Keyed merge, merge-on-read: deletes by key applied to earlier commits."""

from __future__ import annotations

from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

if TYPE_CHECKING:
    from ..store import Meta, Table


def apply_deletes(table: Table, meta: Meta, prune: Column | None, only: set[str] | None = None) -> DataFrame:
    """The current rows (of the commits ``only``, if given): a row goes if a later commit deletes its key, null keys included.

    Delete folders with the same key columns meet in one anti-join, with each key's latest delete. Commits after the last
    delete skip the join; its data side reads only key and needed columns of the others. Where commits and deletes interleave, their
    order comes from a broadcast table with a row for each commit.
    """
    data = [p for p in meta.live if p.kind == "data" and (only is None or p.commit in only)]
    first = min((p.seq for p in data), default=0)
    deletes = [p for p in meta.live if p.kind == "delete" and p.seq > first]
    last = max((p.seq for p in deletes), default=0)
    old, new = [p for p in data if p.seq < last], [p for p in data if p.seq >= last]

    def read(parts):
        df = table._read(meta, parts)
        return df if prune is None else df.where(prune)

    def numbered(df, parts, name):
        known = table.spark.createDataFrame([(p.commit, p.seq) for p in parts], f"commit string, {name} long")
        return df.join(F.broadcast(known), "commit")

    if not old:
        return read(new)
    columns = read(old[:1]).columns
    rows = read(old)
    mixed = max(p.seq for p in old) > min(p.seq for p in deletes)  # some commit came after some delete
    if mixed:
        rows = numbered(rows, old, "_seq")
    for keys in dict.fromkeys(p.keys for p in deletes):
        own = [p for p in deletes if p.keys == keys]
        types = [T.StructField(k, meta.schema[k].dataType) for k in keys]
        schema = T.StructType([*types, T.StructField("commit", T.StringType())])
        dead = table.spark.read.schema(schema).option("basePath", f"{table.path}/deletes").parquet(*[f"{table.path}/deletes/commit={p.commit}" for p in own])
        if mixed:
            dead = numbered(dead, own, "_dead")
        named = [F.col(f"`{k}`").alias(f"_k{i}") for i, k in enumerate(keys)]
        dead = dead.select(*named, *["_dead"] * mixed)
        on = F.col("_seq") < F.col("_dead") if mixed else F.lit(True)
        if len(own) > 1:
            names = [f"_k{i}" for i in range(len(keys))]
            dead = dead.groupBy(*names).agg(F.max("_dead").alias("_dead")) if mixed else dead.distinct()
        for i, k in enumerate(keys):
            on = on & rows[f"`{k}`"].eqNullSafe(dead[f"_k{i}"])
        rows = rows.join(dead, on, "left_anti")
    rows = rows.select(*[F.col(f"`{c}`") for c in columns])
    return rows.unionByName(read(new)) if new else rows
