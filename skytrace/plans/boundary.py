"""Stage boundaries: results that several later steps read are written once to the shared folder."""

from __future__ import annotations

import atexit
import re
import uuid

from pyspark.sql import DataFrame, SparkSession

_written: list[tuple[SparkSession, str]] = []


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; where a local session names none, as in tests, one of our own is set."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        named = "/tmp/checkpoints"
        spark.sparkContext.setCheckpointDir(named)
    return named.rstrip("/")


def scratch(spark: SparkSession, tag: str) -> str:
    """A new path in the shared folder; it is deleted when the driver's Python ends."""
    path = f"{shared_folder(spark)}/{tag}-{uuid.uuid4().hex}"
    if not _written:
        atexit.register(sweep)
    _written.append((spark, path))
    return path


def sweep() -> None:
    """Deletes what was written, as far as the sessions still run."""
    while _written:
        spark, path = _written.pop()
        if spark.sparkContext._jsc is not None:
            remove(spark, path)


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a path in whatever file system holds it; nothing happens if there is none."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def boundary(df: DataFrame) -> DataFrame:
    """``df`` as written to and read from the shared folder; the plan before it runs once."""
    spark = df.sparkSession
    path = scratch(spark, "stage")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
