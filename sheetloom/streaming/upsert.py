"""Keyed merge of a stream of document files into a table."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType


def latest(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Of rows with one key the last by order (ties by all columns); partial aggregates keep hot keys small."""
    rest = [c for c in df.columns if c != key and c not in order]
    return df.groupBy(key).agg(F.max(F.struct(*order, *rest)).alias("_m")).select(key, "_m.*").select(*df.columns)


def merge_stream(spark: SparkSession, source: str, schema: StructType, target: str, checkpoint: str, key: str = "id", order: str = "written_at", form: str = "json", pattern: str = "*", files: int = 1000) -> StreamingQuery:
    """Reads files from source as they arrive; each micro-batch adds a version folder to target with the last row of each
    of its keys. Repeated and late deliveries change nothing that is newer, however late they are: read_merged() gives the current
    rows, compact() unites the versions."""
    stream = spark.readStream.schema(schema).format(form).option("pathGlobFilter", pattern).option("maxFilesPerTrigger", files).load(source)

    def write(batch: DataFrame, number: int) -> None:
        latest(batch, key, [order]).write.mode("overwrite").parquet(f"{target}/batch={number}")  # a retried batch replaces itself

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _versions(spark: SparkSession, target: str) -> tuple[int, list[str]]:
    """Number of the last batch that compact() united (-1 for none), and the folders that hold the current rows."""
    path = spark._jvm.org.apache.hadoop.fs.Path(target)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []
    whole = [n for n in names if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(path, f"{n}/_SUCCESS"))]
    united = max((int(n[5:]) for n in whole if re.fullmatch(r"upto=\d+", n)), default=-1)
    later = [n for n in whole if re.fullmatch(r"batch=\d+", n) and int(n[6:]) > united]
    return united, [f"{target}/{n}" for n in ([f"upto={united}"] if united >= 0 else []) + later]


def read_merged(spark: SparkSession, target: str, schema: StructType, key: str = "id", order: str = "written_at") -> DataFrame:
    """The current row of each key; none if nothing was merged yet."""
    _, folders = _versions(spark, target)
    return latest(spark.read.schema(schema).parquet(*folders), key, [order]) if folders else spark.createDataFrame([], schema)


def compact(spark: SparkSession, target: str, schema: StructType, key: str = "id", order: str = "written_at") -> None:
    """Unites all versions in one folder, which readers take from then on; a failed attempt leaves the versions in use."""
    united, folders = _versions(spark, target)
    last = max([united, *[int(f.rsplit("=", 1)[1]) for f in folders]], default=-1)
    if len(folders) > 1:
        latest(spark.read.schema(schema).parquet(*folders), key, [order]).write.mode("overwrite").parquet(f"{target}/upto={last}")
