"""Tables that are written once, and numbers for all rows of a table in order, without one task that sees them all."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def saved(df: DataFrame, tag: str) -> DataFrame:
    """A table in the shared checkpoint folder; a local session without one (tests) gets a folder of its own."""
    spark: SparkSession = df.sparkSession
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        shared = "file://" + tempfile.mkdtemp(prefix="brindle-")
    path = f"{shared.rstrip('/')}/brindle/{tag}-{uuid.uuid4().hex}"
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(at)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def dropped(*tables: DataFrame | None) -> None:
    """Removes the files of tables made by saved() that nothing will read any more."""
    for table in tables:
        if table is None:
            continue
        spark = table.sparkSession
        for name in {f.rpartition("/")[0] for f in table.inputFiles()}:
            if "/brindle/" in name:
                at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
                at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def number_rows(df: DataFrame, order: Sequence[str | Column], name: str = "number") -> DataFrame:
    """Numbers all rows from 1 on in a total order; a written table.

    Rows are dealt by ranges of the order and sorted there; each has its place in its range, and the ranges' counts (a
    row for each partition) are added up to offsets. The ranges are written before they are counted, so both agree.
    """
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = saved(placed.withColumns({"_part": F.spark_partition_id(), "_at": F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)}), "numbered")
    return _with_offsets(placed, "_part", F.col("_at") + 1, name).drop("_part", "_at")


def renumber(df: DataFrame, number: str, name: str, width: int = 50_000) -> DataFrame:
    """Numbers rows from 1 on in the order of a distinct whole number: places inside ranges of `width`, and offsets."""
    return sum_before(df, number, F.lit(1), name, width).withColumn(name, F.col(name) + 1)


def sum_before(df: DataFrame, number: str, value: Column, name: str, width: int = 50_000) -> DataFrame:
    """Adds the sum of a value over all rows with a smaller number: sums inside ranges of `width`, and offsets."""
    ranged = df.withColumns({"_part": F.floor(F.col(number) / width), "_value": value})
    inside = F.sum("_value").over(Window.partitionBy("_part").orderBy(number).rowsBetween(Window.unboundedPreceding, -1))
    ranged = ranged.withColumn("_at", F.coalesce(inside, F.lit(0)))
    return _with_offsets(ranged, "_part", F.col("_at"), name, F.sum("_value")).drop("_part", "_at", "_value")


def _with_offsets(df: DataFrame, part: str, at: Column, name: str, size: Column | None = None) -> DataFrame:
    sizes = df.groupBy(part).agg((F.count("*") if size is None else size).alias("_n"))  # a row for each range
    before = F.sum("_n").over(Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select(part, F.coalesce(before, F.lit(0)).cast("long").alias("_before"))
    return df.join(F.broadcast(offsets), part).withColumn(name, F.col("_before") + at).drop("_before")
