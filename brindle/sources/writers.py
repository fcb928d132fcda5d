"""Sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brindle.functions.text import default_falsy


def log_defaults(df: DataFrame) -> DataFrame:
    """K1: variant 'A' and status 'sent' where they are null or empty."""
    return df.withColumn("variant", default_falsy(F.col("variant"), F.lit("A"), "")).withColumn("status", default_falsy(F.col("status"), F.lit("sent"), ""))


def append_logs(df: DataFrame, path: str) -> None:
    """K1: appends log rows, in a folder for each day."""
    log_defaults(df).withColumn("sent_date", F.to_date("sent_at")).write.mode("append").partitionBy("sent_date").parquet(path)


def prior_cells(cells: DataFrame, buyers: DataFrame) -> DataFrame:
    """K2: the priors as one row for each cell: section, key and the cell's JSON.

    Sections are country_cpv (keys "country|division") and buyers ("country|buyer" with the country in lower case).
    """
    c = cells.select(F.lit("country_cpv").alias("section"), F.concat_ws("|", "country", "division").alias("key"), F.to_json(F.struct("sample_size", "unique_buyers", "priority_bonus")).alias("cell"))
    return c.unionByName(buyers.select(F.lit("buyers").alias("section"), F.concat_ws("|", F.lower("country"), "buyer_key").alias("key"), F.to_json(F.struct("sample_size", "cpv_diversity", "priority_bonus")).alias("cell")))


def write_priors_document(cells: DataFrame, buyers: DataFrame, columns: dict[str, str], path: str) -> None:
    """K2: the document in parts: path/cells with a JSON line for each cell in the order of section and key, dealt to
    files by ranges of them, and path/head with one line of what it is made from (the columns used, cells by section).

    No list or map of all cells is built anywhere; read_priors_document() gives the cells back.
    """
    rows = prior_cells(cells, buyers)
    line = F.concat(F.lit('{"section":'), F.to_json(F.array("section")).substr(F.lit(2), F.length(F.to_json(F.array("section"))) - 2), F.lit(',"key":'), F.to_json(F.array("key")).substr(F.lit(2), F.length(F.to_json(F.array("key"))) - 2), F.lit(',"cell":'), F.col("cell"), F.lit("}"))
    rows.repartitionByRange("section", "key").sortWithinPartitions("section", "key").select(line.alias("value")).write.mode("overwrite").text(f"{path}/cells")
    used = F.create_map(*[F.lit(x) for kv in columns.items() for x in kv]) if columns else F.create_map()
    counts = rows.agg(*[F.count(F.when(F.col("section") == n, 1)).alias(n) for n in ("country_cpv", "buyers")])
    counts.select(F.to_json(F.struct(used.alias("columns"), F.struct("country_cpv", "buyers").alias("cells"))).alias("value")).write.mode("overwrite").text(f"{path}/head")


def read_priors_document(spark: SparkSession, path: str) -> DataFrame:
    """K2: section, key and the cell as JSON of a document that write_priors_document() wrote."""
    rows = spark.read.text(f"{path}/cells")
    return rows.select(F.get_json_object("value", "$.section").alias("section"), F.get_json_object("value", "$.key").alias("key"), F.get_json_object("value", "$.cell").alias("cell"))


def priors_document(cells: DataFrame, buyers: DataFrame, columns: dict[str, str], most: int = 100_000) -> DataFrame:
    """K2: the priors as one JSON text, for export; at most `most` cells (checked), larger ones are written in parts."""
    rows = prior_cells(cells, buyers)
    if rows.limit(most + 1).count() > most:
        raise ValueError(f"over {most} cells are no single text: use write_priors_document()")

    def as_map(df: DataFrame, key: Column, value: Column) -> DataFrame:
        return df.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(key.alias("k"), value.alias("v"))))).alias("m"))

    c = as_map(cells, F.concat_ws("|", "country", "division"), F.struct("sample_size", "unique_buyers", "priority_bonus"))
    b = as_map(buyers, F.concat_ws("|", F.lower("country"), "buyer_key"), F.struct("sample_size", "cpv_diversity", "priority_bonus"))
    used = F.create_map(*[F.lit(x) for kv in columns.items() for x in kv]) if columns else F.create_map()
    both = c.select(F.col("m").alias("country_cpv")).crossJoin(b.select(F.col("m").alias("buyers")))  # one row each
    return both.select(F.to_json(F.struct("country_cpv", "buyers", used.alias("columns"))).alias("document"))


def write_manifest(df: DataFrame, path: str) -> None:
    """K3: as JSON and as CSV, columns in the order of df."""
    df.write.mode("overwrite").json(f"{path}/json")
    df.write.mode("overwrite").csv(f"{path}/csv", header=True)


def write_profile(df: DataFrame, path: str) -> None:
    """K4."""
    df.write.mode("overwrite").json(path)


def write_summary(df: DataFrame, path: str) -> None:
    """K5."""
    df.write.mode("overwrite").json(path)


def encrypt_columns(df: DataFrame, columns: list[str], key: str | None) -> DataFrame:
    """columns as 'iv:ciphertext' in hexadecimal digits, AES with a key of 32 bytes; without a key nothing changes."""
    if not key:
        return df

    def encrypted(c: str) -> Column:
        h = F.lower(F.hex(F.aes_encrypt(F.col(c).cast("binary"), F.lit(key), F.lit("CBC"), F.lit("PKCS"))))
        return F.regexp_replace(h, "^(.{32})", "$1:")

    return df.withColumns({c: encrypted(c) for c in columns})


def decrypt_columns(df: DataFrame, columns: list[str], key: str | None) -> DataFrame:
    """the reverse; values that cannot be decrypted stay as they are."""
    if not key:
        return df

    def plain(c: str) -> Column:
        data = F.when(F.col(c).rlike("^[0-9a-f]{32}:[0-9a-f]+$"), F.unhex(F.replace(F.col(c), F.lit(":"), F.lit(""))))
        return F.coalesce(F.try_aes_decrypt(data, F.lit(key), F.lit("CBC"), F.lit("PKCS")).cast("string"), F.col(c))

    return df.withColumns({c: plain(c) for c in columns})
