"""Mixing sources to target weights by a low-discrepancy schedule (DataFrame functions only).

* Each source's documents are shuffled by hash and laid on a line of words, which is cut into blocks of
  ``block_words`` (the last of a source may be shorter).
* The schedule is a list of slots. Slot i has the golden-ratio point frac((i + 1/2) * phi), and the source whose stretch
  of the cumulative target weights holds that point owns the slot. A slot's rank among its source's slots says
  which block it takes: rank r takes block r modulo the number of blocks, so a source is repeated only after it has
  been used up, and any stretch of the schedule is mixed as the whole.
* The rank at which a source's target is reached is its last; that slot takes only the words still missing. Should
  the drawn slots fall short of the target (their number is off by the points' discrepancy, a few slots), the
  missing ranks follow at the schedule's end.
* Slots and the blocks' pieces of documents are joined on (source, block).

Only tables with a row for each source or cell are broadcast, up to BROADCAST_SOURCES sources. What grows with the documents is
joined by a shuffle (``merge``); Spark's estimates would have the driver broadcast exploded pieces.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import Workspace, count_words, fresh, running_start

WEIGHTS, SHARE, REPEATS, BLOCK_WORDS = (3, 1, 2), 1.5, 2, 1024
#: The golden ratio less 1, and the fraction of 2**20 times it: slot numbers are split there to keep points precise.
GOLDEN, GOLDEN_20 = 0.6180339887498949, 0.6077874097403709
#: Cells of the unit interval on which points and the sources' stretches are matched.
CELLS = 1 << 16
#: Up to so many sources tables with a row for each source (under 100 bytes), and that of cells (CELLS more), are broadcast.
BROADCAST_SOURCES = 20_000


def targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, repeats: float = REPEATS) -> DataFrame:
    """From (source, source_size): each source's target; the sources share ``share`` of all sizes by weight, and what a
    source can't use (over ``repeats`` times its size) is shared anew among the others.

    Weights repeat over the sources in order of code points, null last. The table has a row for each source, so
    one task numbers them; rows of documents have been summed before.
    """
    order = Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    s = sizes.withColumn("_no", F.row_number().over(order) - 1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("_no") % len(weights) + 1).cast("int"))
    s = s.withColumn("weight", weight).withColumn("_cap", F.col("source_size") * float(repeats))
    # Sharing anew until none is above its cap ends with target = min(cap, level * weight): sources
    # are capped in order of cap / weight, and the level follows from those that aren't.
    by = Window.orderBy(F.col("_cap") / F.col("weight"), "_no")
    upto, everything = by.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    s = s.withColumn("_below", F.coalesce(F.sum("_cap").over(upto), F.lit(0.0))).withColumn("_lighter", F.coalesce(F.sum("weight").over(upto), F.lit(0.0)))
    goal = F.sum("source_size").over(everything) * float(share)
    s = s.withColumn("_level", (goal - F.col("_below")) / (F.sum("weight").over(everything) - F.col("_lighter")))
    # the first source in that order which its level doesn't cap sets the level of all
    level = F.min(F.when(F.col("_level") * F.col("weight") < F.col("_cap"), F.struct((F.col("_cap") / F.col("weight")).alias("r"), "_no", F.col("_level").alias("level")))).over(everything)["level"]
    target = F.when(level.isNull(), F.col("_cap")).otherwise(F.least(F.col("_cap"), level * F.col("weight")))
    return s.withColumn("target", target).select("source", "source_size", "weight", "target", "_no")


def _small(goals: DataFrame, sources: int) -> DataFrame:
    return F.broadcast(goals) if sources <= BROADCAST_SOURCES else goals.hint("merge")


def schedule(goals: DataFrame, sources: int, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(slot, _no, rank, block, take): the slots of the mix; goals has _no, source_size, quota."""
    spark = goals.sparkSession
    total = goals.agg(F.sum("quota")).first()[0] or 0
    slots = math.ceil(total / block_words)
    end = F.sum("quota").over(Window.orderBy("_no").rowsBetween(Window.unboundedPreceding, 0))
    edges = goals.where("quota > 0").withColumn("_end", end).select("_no", ((F.col("_end") - F.col("quota")) / float(max(total, 1))).alias("_from"), (F.col("_end") / float(max(total, 1))).alias("_to"))
    cells = edges.withColumn("_cell", F.explode(F.sequence(F.floor(F.col("_from") * CELLS), F.least(F.floor(F.col("_to") * CELLS), F.lit(CELLS - 1)))))
    i = F.col("slot") + F.lit(0.5)
    high = F.floor(i / float(1 << 20))
    point = (high * F.lit(GOLDEN_20) + (i - high * float(1 << 20)) * F.lit(GOLDEN)) % F.lit(1.0)
    drawn = spark.range(slots).withColumnRenamed("id", "slot").withColumn("_point", point).withColumn("_cell", F.floor(F.col("_point") * CELLS))
    drawn = drawn.join(_small(cells, sources), "_cell").where((F.col("_point") >= F.col("_from")) & (F.col("_point") < F.col("_to"))).select("slot", "_no")
    drawn = drawn.withColumn("_key", F.shiftleft("slot", 63 - max(slots, 1).bit_length()))
    drawn = Workspace(spark).put(running_start(drawn, ["_no"], "_key", [], F.lit(1), "rank").select("slot", "_no", "rank"), "drawn")
    size, quota = F.col("source_size"), F.col("quota")
    need = goals.where("quota > 0").withColumn("_blocks", F.ceil(size / block_words)).withColumn("_ranks", F.floor(quota / size) * F.col("_blocks") + F.ceil((quota % size) / block_words))
    have = drawn.groupBy("_no").agg(F.count("*").alias("_have"))
    missing = need.join(_small(have, sources), "_no", "left").select("_no", "_ranks", F.coalesce("_have", F.lit(0)).alias("_have")).where("_have < _ranks")
    missing = missing.select(F.lit(slots).cast("long").alias("slot"), "_no", F.explode(F.sequence("_have", F.col("_ranks") - 1)).alias("rank"))
    s = drawn.unionByName(missing).join(_small(need, sources), "_no")
    s = s.withColumn("block", F.col("rank") % F.col("_blocks"))
    before = F.floor(F.col("rank") / F.col("_blocks")) * size + F.col("block") * block_words
    length = F.least(F.lit(block_words), size - F.col("block") * block_words)
    return s.withColumn("take", F.least(length, quota - before).cast("long")).where("take > 0").select("slot", "_no", "rank", "block", "take")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: Sequence[float] = WEIGHTS, share: float = SHARE, repeats: float = REPEATS, block_words: int = BLOCK_WORDS) -> tuple[DataFrame, DataFrame]:
    """(rows, pieces) of the mix.

    rows: id, source, size, source_size, target, _no, _start (place on its source's line) of each document.
    pieces: slot, rank, block, source number, id, _start, first_word (0-based in the document), words: what each slot takes
    of which document; the mix itself, in slot order.

    A null source is a source of its own, after all others. Null and empty texts have size 0 and no pieces. Repeated rows
    are documents of their own. With no words at all every target is 0. An empty table gives empty results. Other columns
    are not read. Reruns agree: order comes from hashes of id and text.
    """
    work = Workspace(docs.sparkSession)
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = work.put(docs.select(F.col(id_col).alias("_id"), F.col(source_col).alias("source"), count_words(text).alias("size"), F.xxhash64(F.lit("mix"), F.col(id_col), text).alias("_key")), "rows")
    goals = targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, repeats)
    goals = work.put(goals.withColumn("quota", F.floor(F.col("target") + 0.5).cast("long")), "goals")
    sources = goals.count()
    known = _small(goals.withColumnRenamed("source", "_source"), sources)
    rows = rows.join(known, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    rows = work.put(running_start(rows, ["_no"], "_key", ["_id", "size"], F.col("size"), "_start"), "line")
    block = F.explode(F.sequence(F.floor(F.col("_start") / block_words), F.floor((F.col("_start") + F.col("size") - 1) / block_words)))
    pieces = rows.where("size > 0").select("_no", "_id", "_start", "size", block.alias("block"))
    at = F.col("block") * block_words
    pieces = pieces.withColumn("_from", F.greatest(F.col("_start") - at, F.lit(0))).withColumn("_upto", F.least(F.col("_start") + F.col("size") - at, F.lit(block_words)))
    met = schedule(goals, sources, block_words).join(pieces.hint("merge"), ["_no", "block"]).withColumn("words", F.least("_upto", "take") - F.col("_from")).where("words > 0")
    return rows, met.select("slot", "rank", "block", "_no", "_id", "_start", (F.col("_from") + F.col("block") * block_words - F.col("_start")).alias("first_word"), "words")


def mix_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **how) -> DataFrame:
    """One row for each row of ``docs``: id, size, source_size, target of its source, taken (words in the mix)."""
    rows, pieces = mix(docs, id_col, text_col, source_col, **how)
    taken = pieces.groupBy("_no", "_start").agg(F.sum("words").alias("taken"))
    # rows without words share a start; they meet no pieces, and are spread over the tasks
    rows = rows.withColumn("_at", F.when(F.col("size") > 0, F.col("_start")).otherwise(-1 - F.pmod(F.col("_key"), F.lit(1 << 30))))
    rows = rows.join(taken.withColumnRenamed("_start", "_at").hint("merge"), ["_no", "_at"], "left")
    return rows.select(F.col("_id").alias(id_col), "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def mixed_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **how) -> DataFrame:
    """The mix in whole documents: each row of ``docs`` as often as its taken words come to its size, rounded half up.

    Rows without words stay once. Rows with the same id must have the same size for their copies to be told apart; copies of
    rows that repeat an id are decided by their mean.
    """
    own, copies, copy = fresh(docs, "id", "copies", "copy")
    decided = mix_documents(docs, id_col, text_col, source_col, **how)
    decided = decided.groupBy(F.col(id_col).alias(own)).agg(F.sum("size").alias("_size"), F.sum("taken").alias("_taken"))
    times = F.when(F.col("_size") == 0, 1).otherwise(F.floor(F.col("_taken") / F.col("_size") + 0.5))
    decided = decided.select(own, times.cast("int").alias(copies)).where(F.col(copies) > 0)
    met = docs.join(decided.hint("merge"), F.col(id_col).eqNullSafe(F.col(own)))
    return met.withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(copies)))).select(*docs.columns)


def op4_mixing(spark, sf_dir: str) -> DataFrame:
    return mix_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
