"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir; in local mode, where that is unset, a folder of our own. A cluster without the setting raises."""
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not at:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        at = getattr(shared_dir, "own", None) or tempfile.mkdtemp(prefix="costloom-")
        shared_dir.own = at
    return at.rstrip("/")


def stored(df: DataFrame) -> DataFrame:
    """Write df as Parquet into the shared folder and read it back: lineage ends there, so a lost executor costs no recomputation.

    The files go when the session's JVM ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(at)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def dropped(*tables: DataFrame) -> None:
    """Delete the files of tables that `stored` made and that nothing will read again."""
    for df in tables:
        at = df.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(df._stored_at)
        at.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
