"""Gapless positions for the rows of a table without bringing them to one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def positions(df: DataFrame, cells: list[str], group: list[str], within: list[Column], target: int, name: str = "position") -> DataFrame:
    """Adds the 0-based place of each row in the order of the cell columns, rows of a group side by side.

    cells: few integer columns that order the rows coarsely; their number of distinct values must be bounded by design.
    Groups of one cell are dealt by a hash to as many pieces as keep about `target` rows in each. Only a group that is
    larger than `target` itself (rows / target of them at most) is dealt further, by a hash of `within`, as a part of
    the order of its own. Inside a piece the order is that of the group and then of `within`. Only one count for each
    piece is summed up in one task.
    """
    counts = df.groupBy(*cells, *group).agg(F.count("*").alias("_n"))
    split = F.broadcast(counts.groupBy(*cells).agg(F.ceil(F.sum("_n") / target).cast("long").alias("_k")))  # a row for each cell
    large = F.broadcast(counts.filter(F.col("_n") > target).select(*cells, *group, F.ceil(F.col("_n") / target).cast("long").alias("_parts")))  # rows / target at most
    dealt = df.join(split, cells).join(large, [*cells, *group], "left")
    piece = F.pmod(F.xxhash64(*group), F.col("_k")).alias("_piece")
    own = F.when(F.col("_parts").isNotNull(), F.xxhash64(F.lit(1), *group)).alias("_own")
    part = F.coalesce(F.pmod(F.xxhash64(*within), F.col("_parts")), F.lit(0).cast("long")).alias("_part")
    dealt = dealt.select(*df.columns, piece, F.coalesce(own, F.lit(0).cast("long")).alias("_own"), part)
    keys = [*cells, "_piece", "_own", "_part"]
    sums = dealt.groupBy(*keys).agg(F.count("*").alias("_n"))
    upto = F.sum("_n").over(Window.orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1))
    starts = F.broadcast(sums.select(*keys, F.coalesce(upto, F.lit(0).cast("long")).alias("_start")))  # a row for each piece
    inside = F.row_number().over(Window.partitionBy(*keys).orderBy(*group, *within)) - 1
    numbered = dealt.withColumn("_in", inside).join(starts, keys)
    return numbered.withColumn(name, (F.col("_start") + F.col("_in")).cast("long")).drop("_piece", "_own", "_part", "_start", "_in")
