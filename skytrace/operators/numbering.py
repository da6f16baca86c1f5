"""Dense numbers and running totals in a global order, without one task that sees all rows.

A running total over N rows is split into blocks: totals inside a block run in
parallel, and only the block totals (N / block rows) are summed in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

BLOCK = 1 << 16


def running_offset(df: DataFrame, value: str, order: str, by: list[str], name: str, block: int = BLOCK) -> DataFrame:
    """``df`` (few columns, a long ``order`` unique within ``by``) plus the sum of ``value`` over all rows before each."""
    keyed = df.withColumn("block_", F.floor(F.col(order) / block))
    totals = keyed.groupBy(*by, "block_").agg(F.sum(value).alias("total_"))
    outer = Window.partitionBy(*by).orderBy("block_").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.withColumn("before_", F.coalesce(F.sum("total_").over(outer), F.lit(0))).drop("total_")
    inner = Window.partitionBy(*by, "block_").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    own = F.coalesce(F.sum(value).over(inner), F.lit(0))
    return keyed.withColumn("own_", own).join(offsets, [*by, "block_"]).withColumn(name, (F.col("before_") + F.col("own_")).cast("long")).drop("block_", "own_", "before_")


def rank_by_digest(df: DataFrame, digest: Column, tie: str, name: str) -> DataFrame:
    """``df`` plus its 1-based rank by a hexadecimal digest and then ``tie``; ranked in 65,536 ranges of the digest."""
    keyed = df.withColumn("digest_", digest).withColumn("range_", F.conv(F.substring("digest_", 1, 4), 16, 10).cast("int"))
    counts = keyed.groupBy("range_").agg(F.count("*").alias("n_"))
    outer = Window.partitionBy().orderBy("range_").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("before_", F.coalesce(F.sum("n_").over(outer), F.lit(0))).drop("n_")
    inner = Window.partitionBy("range_").orderBy("digest_", tie)
    return keyed.withColumn("own_", F.row_number().over(inner)).join(offsets, "range_").withColumn(name, (F.col("before_") + F.col("own_")).cast("long")).drop("digest_", "range_", "own_", "before_")
