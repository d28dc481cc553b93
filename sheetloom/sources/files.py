"""File sources and sinks: recursive scans, JSON documents, JSON lines and CSV reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def scan_files(spark: SparkSession, root: str, suffix: str = ".pdf", exclude: tuple[str, ...] = (), content: bool = False) -> DataFrame:
    """Files below root by suffix (case ignored), without those below an excluded prefix: path, length, modified (and
    content and its SHA-256). Without content the bytes are never read."""
    x = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    x = x.where(F.lower("path").endswith(suffix.lower()))
    for prefix in exclude:
        x = x.where(~F.col("path").contains(prefix.rstrip("/") + "/"))
    columns = ["path", "length", F.col("modificationTime").alias("modified")]
    return x.select(*columns, "content", F.sha2("content", 256).alias("sha256")) if content else x.select(*columns)


def read_json_documents(spark: SparkSession, root: str, pattern: str = "*_structured.json") -> DataFrame:
    """One row per JSON file: path, text as written (key order matters to some readers) and doc (VARIANT, null if faulty)."""
    x = spark.read.option("wholetext", "true").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).text(root)
    return x.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"), F.try_parse_json("value").alias("doc"))


def write_json_lines(df: DataFrame, path: str, drop: tuple[str, ...] = ("raw_json",)) -> None:
    """One JSON object per line, nulls left out, without the columns in drop."""
    df.drop(*drop).write.mode("overwrite").option("ignoreNullFields", "true").json(path)


def write_report(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", "true").csv(path)
