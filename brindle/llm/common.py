"""Helpers that several corpus operators share: scratch tables, folds and batch sizes."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORD = "[^\\x20\\x09-\\x0D]+"


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder that the cluster names in spark.checkpoint.dir; a local one only where that is unset (tests)."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        shared = "file://" + tempfile.mkdtemp(prefix="brindle-")
        spark.conf.set("spark.checkpoint.dir", shared)
    return shared.rstrip("/")


def scratch_path(spark: SparkSession, tag: str) -> str:
    """A new path under the shared folder, removed when the application ends."""
    path = f"{scratch_dir(spark)}/brindle/{tag}-{uuid.uuid4().hex}"
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(at)
    return path


def written(df: DataFrame, tag: str) -> DataFrame:
    """Writes df as a table in the shared folder and reads it back: lineage is cut, and any executor may be lost."""
    spark = df.sparkSession
    path = scratch_path(spark, tag)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(table: DataFrame) -> None:
    """Removes the files of a table made by written() that nothing will read any more."""
    spark = table.sparkSession
    for name in {f.rpartition("/")[0] for f in table.inputFiles()}:
        if "/brindle/" in name:
            at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
            at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


#: A key with over this share of all rows is hot; there are fewer than 256 such keys by that.
HOT_SHARE = 1 / 256


def looked_up(rows: DataFrame, table: DataFrame, key: str, copies: str, total: int) -> DataFrame:
    """rows with the columns of table (one row for each key; null for keys that it lacks), without a hot key in one task.

    copies: the table's number of rows with a key (dropped); total: of all rows. Keys with over HOT_SHARE of all rows are
    fewer than 1 / HOT_SHARE, so these are broadcast; the others are joined by shuffling, and null keys not at all.
    """
    hot = F.broadcast(table.filter(F.col(copies) > max(1, total) * HOT_SHARE))
    rest = table.filter(F.coalesce(copies, F.lit(0)) <= max(1, total) * HOT_SHARE).drop(copies)
    warm = rows.join(hot.drop(copies), key)
    cold = rows.filter(F.col(key).isNotNull()).join(F.broadcast(hot.select(key)), key, "left_anti").join(rest, key, "left")
    none = rows.filter(F.col(key).isNull()).select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in rest.schema if f.name != key])
    columns = [key, *[c for c in rows.columns if c != key], *[c for c in rest.columns if c != key]]
    return warm.select(*columns).unionByName(cold.select(*columns)).unionByName(none.select(*columns))


def small_batches(spark: SparkSession, rows: int = 512) -> None:
    """Texts may be very long: fewer rows go to a Python worker at a time."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def fold(key: Column, folds: int) -> Column:
    """crc32 of the key as text, modulo the number of folds; null keys are in no fold."""
    return F.crc32(key.cast("string")) % folds


def labelled_sample(labels: DataFrame, label: str, learn: Column, per_class: int, seed: int) -> DataFrame:
    """At most per_class ids of each class, smallest seeded hash first.

    Null ids and labels are left out; an id with both labels counts as class 0 only if no row says 1.
    The result has at most 2 * per_class rows, which is what allows it to be broadcast.
    """
    known = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
        .filter(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & learn)
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
        .withColumn("h", F.xxhash64(F.lit(seed), F.col("doc_id")))
    )
    parts = [known.filter(F.col("label") == k).orderBy("h", "doc_id").limit(per_class) for k in (0, 1)]
    return parts[0].unionByName(parts[1])
