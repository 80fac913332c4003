"""Surrogate keys without a single-partition window over the data.

Dense keys follow the order of a natural key whose rows lie in range buckets:
``start + rows in earlier buckets + position in the bucket``. The buckets are
stored with the rows (written once, so every later read agrees), and the sizes
of earlier buckets come from one row per bucket, joined back.

Row ids need no order. Rows are stored with the task that wrote them and their
position in it; rows in earlier tasks, from one count per task, and that position
make the id. Nothing in it is limited in bits but the id itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Parts whose counts are summed in one group.
PARTS_IN_BLOCK = 10_000


def with_dense_keys(rows: DataFrame, key_column: str, order: str, bucket: str, start: int = 0) -> DataFrame:
    """Append ``key_column`` = start+1, start+2, ... in the order of ``order``, whose ranges ``bucket`` numbers."""
    position = F.row_number().over(Window.partitionBy(bucket).orderBy(order))
    ahead = Window.orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)  # one row per bucket
    sizes = rows.groupBy(bucket).agg(F.count(F.lit(1)).alias("_n"))
    sizes = sizes.select(bucket, F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_ahead"))
    numbered = rows.withColumn("_pos", position).join(sizes, bucket)
    key = F.lit(start).cast("long") + F.col("_ahead") + F.col("_pos")
    return numbered.withColumn(key_column, key.cast("long")).drop("_pos", "_ahead")


def placed(rows: DataFrame) -> DataFrame:
    """``rows`` with _part (the task that evaluates them) and _pos (from 0 within it), to be stored with them."""
    part = F.spark_partition_id()
    position = F.monotonically_increasing_id().bitwiseAND(F.lit(2**33 - 1))
    return rows.withColumn("_part", part).withColumn("_pos", position)


def parts_ahead(counts: DataFrame) -> DataFrame:
    """_part and _ahead, the rows in parts before it, from a table of _part and _n.

    Sums are taken within blocks of parts and over blocks, so no task sees all parts.
    """
    blocks = counts.withColumn("_block", F.floor(F.col("_part") / PARTS_IN_BLOCK))
    before = Window.partitionBy("_block").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    ahead = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)  # one row per block
    sums = blocks.groupBy("_block").agg(F.sum("_n").alias("_n"))
    sums = sums.select("_block", F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_blocks_ahead"))
    inside = blocks.select("_block", "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_in_block"))
    return inside.join(sums, "_block").select("_part", (F.col("_in_block") + F.col("_blocks_ahead")).alias("_ahead"))


def with_row_ids(stored: DataFrame, key_column: str, start: int, fresh: Column) -> DataFrame:
    """Give rows of a stored ``placed`` table for which ``fresh`` holds ids above ``start``; other rows keep theirs.

    An id is ``start`` + rows of earlier parts + position, so it is unique for any number
    of tasks and rows. Ids of parts that hold rows with ids of their own have gaps.
    """
    counts = stored.groupBy("_part").agg((F.max("_pos") + 1).alias("_n"))
    numbered = stored.join(F.broadcast(parts_ahead(counts)), "_part")  # one row per task: the stored rows stay where they are
    own = F.lit(start).cast("long") + F.col("_ahead") + F.col("_pos") + 1
    return numbered.withColumn(key_column, F.when(fresh, own).otherwise(F.col(key_column))).drop("_part", "_pos", "_ahead")
