"""Scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_leads_csv(spark: SparkSession, path: str) -> DataFrame:
    """An upload with a header; fields trimmed, blank lines skipped, a malformed file fails as a whole.

    Column names are kept apart by case (email and Email), so the session must be case sensitive while they are used.
    """
    spark.conf.set("spark.sql.caseSensitive", "true")
    return spark.read.csv(path, header=True, ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True, mode="FAILFAST")


def read_text_table(spark: SparkSession, path: str) -> DataFrame:
    """A CSV file with all columns as text; malformed rows are kept as far as they go."""
    return spark.read.csv(path, header=True, inferSchema=False, mode="PERMISSIVE")


def read_history(spark: SparkSession, path: str) -> DataFrame:
    """S3."""
    return spark.read.parquet(path)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """page_id, url and html."""
    return spark.read.parquet(path).select("page_id", "url", "html")


def read_candidates(spark: SparkSession, path: str) -> DataFrame:
    """Items with vectors and scores."""
    return spark.read.parquet(path)


def explode_seeds(spark: SparkSession, path: str) -> DataFrame:
    """Rows (index, folder, game, place, id) of one JSON object of seed lists."""
    kinds = "map<string, struct<folder: string, game: string, ids: array<string>>>"
    rows = spark.read.text(path, wholetext=True).select(F.from_json("value", kinds).alias("m")).select(F.explode("m").alias("index", "s"))
    return rows.select(F.col("index").cast("int").alias("index"), "s.folder", "s.game", F.posexplode("s.ids").alias("place", "id"))


def read_jsonl_lenient(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of JSON lines; lines that are none are skipped. file_pos is the order of the lines of a file."""
    lines = with_file_pos(spark.read.text(path))
    parsed = lines.filter(F.trim("value").startswith("{")).withColumn("r", F.from_json("value", schema, {"columnNameOfCorruptRecord": "_bad"}))
    return parsed.filter(F.col("r").isNotNull() & F.get_json_object("value", "$").isNotNull()).select("file_pos", "r.*")


def read_dir_with_source(spark: SparkSession, path: str) -> DataFrame:
    """All CSV files of a folder with the name and size of each row's file."""
    df = spark.read.csv(path, header=True, inferSchema=False)
    return df.select("*", F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_size").alias("bytes"))


def with_file_pos(df: DataFrame) -> DataFrame:
    """Rows of a scan numbered in file order (increasing, with gaps between partitions)."""
    return df.withColumn("file_pos", F.monotonically_increasing_id())


def lookup(df: DataFrame, key: str, value: object) -> DataFrame:
    """The row of a key, or none; the condition is pushed to the files."""
    return df.filter(F.col(key) == value)


def first_columns(df: DataFrame, n: int) -> DataFrame:
    """the first n columns."""
    return df.select(*[F.col(f"`{c}`") for c in df.columns[:n]])
