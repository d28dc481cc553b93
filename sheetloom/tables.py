"""Access to the input tables and the shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """Folder that all executors share: spark.checkpoint.dir, or, where it is unset and all runs in one process (tests), a
    temporary one. RuntimeError on a cluster without it."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        jsc = spark.sparkContext._jsc.sc()
        if jsc.getCheckpointDir().isDefined():
            found = jsc.getCheckpointDir().get()
        elif spark.sparkContext.master.split("[")[0] == "local":
            found = tempfile.mkdtemp(prefix="sheetloom-")
        else:
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        spark.conf.set("spark.checkpoint.dir", found)
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(found)
    return found


def new_path(spark: SparkSession) -> str:
    """A path in the shared folder that is deleted when the application ends."""
    path = f"{shared_dir(spark).rstrip('/')}/sheetloom-{uuid.uuid4().hex}"
    own = spark._jvm.org.apache.hadoop.fs.Path(path)
    own.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(own)
    return path


def materialise(df: DataFrame) -> DataFrame:
    """Writes df as a table in the shared folder and reads it again: lineage is cut and a lost executor loses nothing."""
    spark = df.sparkSession
    path = new_path(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
