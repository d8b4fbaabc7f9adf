"""What the corpus operators share: written intermediate tables and distributed numbering."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: A word: a run of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
#: Hash bins of two-level numbering; fixed, so that the table of bin totals has a fixed size for each group.
BINS = 4096
HOT_ROWS, HOT = 1_000, 10_000


def shared_dir(spark: SparkSession) -> str:
    """A new folder under ``spark.checkpoint.dir``, which driver and executors share.

    Only where that setting is absent (a local session, as in tests) a temporary folder is used.
    """
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="lakeweave-")
    return f"{root.rstrip('/')}/lakeweave-{uuid.uuid4().hex}"


class Workspace:
    """Intermediate tables of one run: each is written once as Parquet in the shared folder and read again.

    A written table cuts lineage: a lost executor costs only the tasks that ran on it.
    """

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self.root = spark, shared_dir(spark)

    def put(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(path)  # nobody asks for the mark
        return self.spark.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names that the table doesn't have in any case, made from the given ones."""
    taken, out = {c.lower() for c in df.columns}, []
    for n in names:
        n = f"__{n}"
        while n in taken:
            n += "_"
        out.append(n)
        taken.add(n)
    return out


def lower_ascii(text: Column) -> Column:
    """Lower-cases A-Z only; texts that are plain ASCII take the built-in ``lower``."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def count_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def bin_of(key: Column, bins: int = BINS) -> Column:
    """The leading bits of a signed 64-bit hash, so that bins are ranges of it."""
    return F.shiftrightunsigned(key, 64 - (bins - 1).bit_length()).cast("int")


def by_key(rows: DataFrame, groups: DataFrame, key: str, count: str) -> DataFrame:
    """``rows`` joined with ``groups``, which has one row for each key and in ``count`` how many of ``rows`` have it.

    Up to HOT groups meet their rows by broadcast, where the rows are. Of more a key is hot if more than HOT_ROWS rows and more
    than 1 / HOT of all that are counted have it; so fewer than HOT are. Hot keys are broadcast; the others meet by a
    shuffle in which no key weighs much. What is broadcast goes by counted rows: a size that Spark estimates leaves out what ``explode`` adds.
    """
    counted = groups.agg(F.sum(count), F.count("*")).first()
    if counted[1] <= HOT:
        return rows.join(F.broadcast(groups), key)
    is_hot = F.col(count) > max(HOT_ROWS, (counted[0] or 0) // HOT)
    hot = F.broadcast(groups.where(is_hot))
    if hot.isEmpty():
        return rows.join(groups.hint("merge"), key)
    cold = rows.join(F.broadcast(groups.where(is_hot).select(key)), key, "left_anti").join(groups.where(~is_hot).hint("merge"), key)
    return rows.join(hot, key).unionByName(cold)


def running_start(df: DataFrame, group: list[str], key: str, order: list[str], amount: Column, name: str) -> DataFrame:
    """Adds ``name``: the sum of ``amount`` over the rows that stand before a row in its group, by ``key`` (a 64-bit
    hash) and ``order``.

    Two levels, so that no task ever holds a whole group: rows are summed in hash bins, the bins' totals
    (BINS for each group at most) are accumulated, and rows are accumulated in their bin. Totals and rows are shuffled, as there
    are nearly as many of them in a small table or one of many groups.
    """
    binned = df.withColumn("_bin", bin_of(F.col(key))).withColumn("_amount", amount.cast("long"))
    parts = [*group, "_bin"]
    totals = binned.groupBy(*parts).agg(F.sum("_amount").alias("_total"))
    ahead = Window.partitionBy(*group).orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(*parts, F.coalesce(F.sum("_total").over(ahead), F.lit(0)).alias("_before"))
    inside = Window.partitionBy(*parts).orderBy(key, *order).rowsBetween(Window.unboundedPreceding, -1)
    rows = binned.withColumn("_inside", F.coalesce(F.sum("_amount").over(inside), F.lit(0)))
    met = rows.alias("r").join(totals.hint("merge").alias("t"), [F.col(f"r.{c}").eqNullSafe(F.col(f"t.{c}")) for c in parts])
    kept = [c for c in df.columns]
    return met.select(*[F.col(f"r.{c}") for c in kept], (F.col("_before") + F.col("_inside")).cast("long").alias(name))
