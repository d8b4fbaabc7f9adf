"""Exact deduplication by an extendible-hash index on shared files (DataFrame functions only).

The index maps 64-bit keys of normalised texts to entries, one for each different text. Its directory doubles where
buckets are overfull: a bucket is the range of keys with the same leading ``depth`` bits, and one with more than its capacity
of keys is split into the two ranges one bit deeper, until all fit or a bucket holds a single key.

Texts go through the directory to the owner task of their bucket, which alone tells them apart: inside a bucket the texts of a
key form a chain, compared by their bytes (the grouping compares whole texts, hashes only route), and each different text is one
entry. Owners write their buckets, in order, to the index in the shared folder. Rows are then looked up in their bucket, by
key and digest; where two entries of a key share a digest, by bytes.

Keys of which more than a share of 1 / ``HOT`` of all rows are copies (fewer than HOT, however large the table) don't move
row by row: they are combined where they are read, and their owner gets a row for each text and reading task.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import Workspace, fresh, lower_ascii

#: Keys in a bucket: at least so many, and so many that the directory keeps to about MOST_BUCKETS entries.
CAPACITY, MOST_BUCKETS = 100, 1 << 15
#: A key is hot if more than this many rows, and more than 1 / HOT of all rows, have it.
HOT_ROWS, HOT = 1_000, 10_000
#: Bits by which the count of keys looks ahead each time a bucket may have to be split.
LOOK_AHEAD = 8


@dataclass(frozen=True)
class Bucket:
    """Keys whose leading ``depth`` bits (unsigned) are ``prefix``."""

    depth: int
    prefix: int


def _leading(key: Column, bits: int) -> Column:
    return F.shiftrightunsigned(key, 64 - bits) if bits else F.lit(0).cast("long")


def directory(keys: DataFrame, capacity: int) -> list[Bucket]:
    """Splits the one bucket of depth 0 until none of several keys is overfull. ``keys``: distinct keys, column ``key``.

    Only counts by prefix reach the driver: (buckets that are still overfull) * 2**LOOK_AHEAD rows at a time, and the capacity
    bounds the number of buckets whatever the number of keys.
    """
    done: list[Bucket] = []
    total = keys.count()
    keys = keys.select("key")
    over: dict[Bucket, int] = {Bucket(0, 0): total}
    while over:
        depth = next(iter(over)).depth
        if depth >= 64 or all(n <= capacity for n in over.values()):
            done += over
            break
        deeper = min(64, depth + LOOK_AHEAD)
        todo = keys.where(_leading(F.col("key"), depth).isin([b.prefix - (1 << 64) if b.prefix >= 1 << 63 else b.prefix for b in over])) if depth else keys
        counts = {int(p) % (1 << 64): n for p, n in todo.groupBy(_leading(F.col("key"), deeper).alias("p")).count().collect()}
        level = over
        while level and next(iter(level)).depth < deeper:
            done += [b for b, n in level.items() if n <= capacity]
            halves: dict[Bucket, int] = {}
            for b in (b for b, n in level.items() if n > capacity):
                for prefix in (2 * b.prefix, 2 * b.prefix + 1):
                    shift = deeper - b.depth - 1
                    halves[Bucket(b.depth + 1, prefix)] = sum(counts.get(p, 0) for p in range(prefix << shift, (prefix + 1) << shift))
            level = halves
        done += [b for b, n in level.items() if n <= capacity]
        over = {b: n for b, n in level.items() if n > capacity}
    return sorted(done, key=lambda b: b.prefix << (64 - b.depth))


def with_bucket(df: DataFrame, buckets: list[Bucket]) -> DataFrame:
    """Adds the bucket number of each key through the directory, a table with a row for each bucket (bounded by MOST_BUCKETS and
    the capacity); one lookup for each depth that occurs, which are few, as keys are hashes."""
    signed = lambda p: p - (1 << 64) if p >= 1 << 63 else p
    table = df.sparkSession.createDataFrame([(b.depth, signed(b.prefix), i) for i, b in enumerate(buckets)], "_depth int, _prefix long, bucket int")
    # a depth's prefixes cover only its buckets' keys, so just one of a key's prefixes is in the directory
    deep = sorted({b.depth for b in buckets})
    for d in deep:
        own = F.broadcast(table.where(F.col("_depth") == d).select(F.col("_prefix").alias(f"_prefix{d}"), F.col("bucket").alias(f"_bucket{d}")))
        df = df.withColumn(f"_own{d}", _leading(F.col("key"), d)).join(own, F.col(f"_own{d}") == F.col(f"_prefix{d}"), "left")
    return df.withColumn("bucket", F.coalesce(*[F.col(f"_bucket{d}") for d in deep])).drop(*[f"{c}{d}" for d in deep for c in ("_own", "_prefix", "_bucket")])


def text_key(norm: Column) -> Column:
    return F.xxhash64(norm)


def text_digest(norm: Column) -> Column:
    return F.unhex(F.sha2(norm, 256))


def group_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", normalise: Callable[[Column], Column] = lower_ascii, key: Callable[[Column], Column] = text_key, digest: Callable[[Column], Column] = text_digest, capacity: int = CAPACITY, hot_rows: int = HOT_ROWS) -> DataFrame:
    """One row for each row of ``docs``: id, keep_id, group_size, kept, text_sha256 (of the normalised text).

    Null texts count as empty, and empty texts equal each other. Of equal texts the largest id stays; a null id stays only if
    its group has no other. Rows that repeat both text and the id that stays are all marked kept, as nothing tells
    them apart. An empty table gives an empty result. Columns other than the two named ones are not read.
    """
    work = Workspace(docs.sparkSession)
    text = normalise(F.coalesce(F.col(text_col), F.lit("")))
    texts = docs.select(F.col(id_col).alias("id"), text.alias("norm")).withColumn("key", key(F.col("norm")))
    rows = work.put(texts.select("id", "key", digest(F.col("norm")).alias("digest"), F.sha2("norm", 256).alias("sha")), "rows")
    keys = work.put(rows.groupBy("key").agg(F.count("*").alias("n")), "keys")
    count, total = keys.agg(F.count("*"), F.sum("n")).first()
    buckets = directory(keys, max(capacity, count // MOST_BUCKETS))
    hot = F.broadcast(keys.where(F.col("n") > max(hot_rows, (total or 0) // HOT)).select("key", F.lit(True).alias("hot")))  # fewer than HOT
    told = with_bucket(texts.join(hot, "key", "left"), buckets)
    one = told.where("hot is null").select("bucket", "key", "norm", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("n"))
    many = told.where("hot").groupBy("bucket", "key", "norm").agg(F.max("id").alias("keep_id"), F.count("*").alias("n"))
    owned = one.unionByName(many).repartition("bucket")
    entries = owned.groupBy("bucket", "key", "norm").agg(F.max("keep_id").alias("keep_id"), F.sum("n").alias("group_size"))
    entries = entries.select("bucket", "key", digest(F.col("norm")).alias("digest"), "keep_id", "group_size")
    chain = Window.partitionBy("bucket", "key").orderBy("digest", "keep_id")
    clash = F.coalesce(F.lag("digest").over(chain) == F.col("digest"), F.lit(False)) | F.coalesce(F.lead("digest").over(chain) == F.col("digest"), F.lit(False))
    index = work.put(entries.withColumn("chain", F.row_number().over(chain) - 1).withColumn("clash", clash).sortWithinPartitions("bucket", "key", "chain"), "index")
    asked = with_bucket(rows.join(hot, "key", "left"), buckets)
    entry = index.where("not clash").select("bucket", "key", "digest", "keep_id", "group_size")
    found = asked.where("hot is null").drop("hot").join(entry, ["bucket", "key", "digest"])
    known = entry.join(hot, "key").drop("hot")  # as many as hot keys, unless those hold other texts as well
    known = F.broadcast(known) if known.count() <= 2 * HOT else known
    found = found.unionByName(asked.where("hot").drop("hot").join(known, ["bucket", "key", "digest"]))
    out = found.select("id", "keep_id", "group_size", "sha")
    clash = index.where("clash").select("bucket", "key", "digest").distinct()
    if not clash.isEmpty():  # different texts of one key and digest: their rows are looked up by their bytes
        held = told.withColumn("digest", digest(F.col("norm"))).join(clash, ["bucket", "key", "digest"], "left_semi")
        exact = held.groupBy("norm").agg(F.max("id").alias("keep_id"), F.count("*").alias("group_size"))
        out = out.unionByName(held.join(exact, "norm").select("id", "keep_id", "group_size", F.sha2("norm", 256).alias("sha")))
    kept = F.col("id").eqNullSafe(F.col("keep_id"))
    return out.select(F.col("id").alias(id_col), "keep_id", F.col("group_size").cast("long"), kept.alias("kept"), F.col("sha").alias("text_sha256"))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; rows that repeat id and normalised text of a kept row go too."""
    own, id_, sha = fresh(docs, "own", "id", "sha")
    kept = group_copies(docs, id_col, text_col, **how).where("kept").select(F.col(id_col).alias(id_), F.col("text_sha256").alias(sha)).distinct()
    hashed = docs.withColumn(own, F.sha2(how.get("normalise", lower_ascii)(F.coalesce(F.col(text_col), F.lit(""))), 256))
    met = hashed.join(kept, F.col(id_col).eqNullSafe(F.col(id_)) & (F.col(own) == F.col(sha)), "left_semi")
    return met.dropDuplicates([id_col, own]).select(*docs.columns)


def op1_exact_dedup(spark, sf_dir: str) -> DataFrame:
    return group_copies(spark.read.parquet(f"{sf_dir}/documents.parquet"))


SQL = """
WITH t AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm FROM documents
), g AS (SELECT norm, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY norm)
SELECT doc_id, keep_id, CAST(group_size AS BIGINT) AS group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, sha256(norm) AS text_sha256
FROM t JOIN g USING (norm)
"""
