"""Relational operators that Spark SQL has no word for."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def asof_join(left: DataFrame, right: DataFrame, on: Sequence[str], left_time: str, right_time: str, tiebreak: str, columns: Sequence[str]) -> DataFrame:
    """Each left row with ``columns`` of the last right row of the same key that isn't later; nulls if there is none.

    One shuffle of both sides by key and a running last value: no row is paired with more than one other. Of
    equally late right rows the one with the largest ``tiebreak`` counts. Rows with a null key or time find nothing.
    """
    key = [F.col(c) for c in on]
    found = F.struct(*[F.col(c) for c in columns])
    r = right.where(F.col(right_time).isNotNull()).select(*key, F.col(right_time).alias("_t"), F.lit(0).alias("_side"), F.col(tiebreak).alias("_tie"), found.alias("_found"))
    row = F.struct(*[F.col(c) for c in left.columns])
    l_ = left.select(*key, F.col(left_time).alias("_t"), F.lit(1).alias("_side"), row.alias("_row"))
    both = l_.unionByName(r, allowMissingColumns=True)
    order = Window.partitionBy(*on).orderBy("_t", "_side", "_tie").rowsBetween(Window.unboundedPreceding, 0)
    usable = F.lit(True)
    for c in on:
        usable = usable & F.col(c).isNotNull()
    met = both.withColumn("_last", F.when(usable & F.col("_t").isNotNull(), F.last("_found", ignorenulls=True).over(order))).where("_side = 1")
    return met.select("_row.*", *[F.col(f"_last.{c}").alias(c) for c in columns])


def groups_frame(df: DataFrame, partition: Sequence[str], order: str, before: int, after: int, value: Column, name: str) -> DataFrame:
    """``value`` (an aggregate) over a GROUPS frame: the peers of the row's order value and those of so many values around it."""
    rank = Window.partitionBy(*partition).orderBy(order)
    over = Window.partitionBy(*partition).orderBy("_group").rangeBetween(-before, after)
    return df.withColumn("_group", F.dense_rank().over(rank)).withColumn(name, value.over(over)).drop("_group")


def last_rows(df: DataFrame, partition: Sequence[str], order: str, tie: str, before: int, value: Column, name: str, every: str = "hour") -> DataFrame:
    """``value`` (an aggregate) over the row and the ``before`` rows that stand before it in its partition, by ``order`` (a time) and ``tie``;
    nulls come last.

    Rows are dealt out by partition and ``every`` of time, so that a partition isn't one task. A piece of time also gets the last ``before`` rows
    that stand before it, of which it is enough to look at the last ``before`` of each piece.
    """
    piece = ["_key", "_piece"]
    key = F.struct(*[F.col(c).alias(c) for c in partition])
    rows = df.withColumn("_key", key).withColumn("_piece", F.date_trunc(every, F.col(order))).withColumn("_own", F.lit(True))
    ranks = [F.col(order).asc_nulls_last(), F.col(tie).asc_nulls_last()]
    backwards = Window.partitionBy(*piece).orderBy(F.col(order).desc_nulls_first(), F.col(tie).desc_nulls_first())
    ends = rows.withColumn("_back", F.row_number().over(backwards)).where(F.col("_back") <= before)
    along = Window.partitionBy("_key").orderBy(F.col("_piece").asc_nulls_last(), F.col("_back").desc())
    row = F.struct(*[F.col(c) for c in df.columns])
    ahead = ends.select("_key", "_piece", "_back", F.collect_list(row).over(along.rowsBetween(-before, -1)).alias("_ahead"), F.max("_back").over(Window.partitionBy(*piece)).alias("_first"))
    ahead = ahead.where("_back = _first").select("_key", "_piece", F.explode("_ahead").alias("_row")).select("_row.*", "_key", "_piece", F.lit(False).alias("_own"))
    over = Window.partitionBy(*piece).orderBy("_own", *ranks).rowsBetween(-before, 0)
    return rows.unionByName(ahead).withColumn(name, value.over(over)).where("_own").drop("_key", "_piece", "_own")


def count_within(df: DataFrame, partition: Sequence[str], order: str, back: str, name: str, every: str = "hour") -> DataFrame:
    """How many rows of the partition have an ``order`` (a time) from the row's own less the interval ``back`` up to its own; rows without a
    time count each other. As count(*) over a RANGE frame, which looks at each of the frame's rows for each row.

    Different times are counted once and summed up along the time: in pieces of ``every``, on top of the sum of the pieces before. A time's
    count is the sum up to it less the sum before its frame begins.
    """
    key = F.struct(*[F.col(c).alias(c) for c in partition])
    times = df.groupBy(key.alias("_key"), F.col(order).alias("_time")).agg(F.count("*").alias("_n"))
    known = times.where("_time is not null")
    # at: a place on the time axis; times that ask stand before those that count there
    counting = known.select("_key", "_time", F.col("_time").alias("_at"), F.lit(1).alias("_kind"), "_n")
    asking = known.select("_key", "_time", (F.col("_time") - F.expr(back)).alias("_at"), F.lit(0).alias("_kind"), F.lit(0).cast("long").alias("_n"))
    marks = counting.unionByName(asking).withColumn("_piece", F.date_trunc(every, F.col("_at")))
    inside = Window.partitionBy("_key", "_piece").orderBy("_at", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    pieces = marks.groupBy("_key", "_piece").agg(F.sum("_n").alias("_n"))
    before = Window.partitionBy("_key").orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.select("_key", "_piece", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    summed = marks.withColumn("_sum", F.sum("_n").over(inside)).join(pieces, ["_key", "_piece"])
    upto = (F.col("_sum") + F.col("_before")) * F.when(F.col("_kind") == 1, 1).otherwise(-1)
    found = summed.groupBy("_key", "_time").agg(F.sum(upto).alias(name)).unionByName(times.where("_time is null").select("_key", "_time", F.col("_n").alias(name)))
    met = df.withColumn("_key", key)
    return met.join(found.withColumnRenamed("_key", "_of").hint("merge"), F.col("_key").eqNullSafe(F.col("_of")) & F.col(order).eqNullSafe(F.col("_time"))).drop("_key", "_of", "_time")


def qualify(df: DataFrame, value: Column, condition) -> DataFrame:
    """Rows for whose window value the condition holds."""
    return df.withColumn("_value", value).where(condition(F.col("_value"))).drop("_value")
