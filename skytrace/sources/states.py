"""Readers of hourly state files and of the aircraft registry."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skytrace.functions.numeric import nan_to_null
from skytrace.schemas import REGISTRY, STATES

log = logging.getLogger("skytrace")

#: Texts that stand for a missing value.
MISSING = ["", "nan", "NaN", "NA", "NULL", "null", "None"]


def _tidy(df: DataFrame) -> DataFrame:
    for f in df.schema:
        if f.dataType.typeName() == "string" and f.name not in ("source_file", "date"):
            df = df.withColumn(f.name, F.when(~F.col(f.name).isin(MISSING), F.col(f.name)))
        elif f.dataType.typeName() == "double":
            df = df.withColumn(f.name, nan_to_null(F.col(f.name)))
    return df


def hourly_files(spark: SparkSession, archive_dir: str, date: str) -> int:
    """How many hourly files a date has, in whatever file system holds them."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{archive_dir}/states_{date}-*.csv")
    found = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern)
    return len(found) if found is not None else 0


def hourly_states(spark: SparkSession, archive_dir: str, dates: tuple[str, ...], strict: bool = False) -> DataFrame:
    """All hourly files of the dates, with ``date`` and ``source_file`` from the file's name and the order of rows.

    Columns are taken by place; ``strict`` makes a header that differs an error.
    ``event_id`` orders rows by file name and place in the file.  A date without
    files has no rows, and that is logged; so has a run without any.
    """
    paths = []
    for d in dates:
        found = hourly_files(spark, archive_dir, d)
        log.info("%s: %d files", d, found)
        if found:
            paths.append(f"{archive_dir}/states_{d}-*.csv")
        else:
            log.warning("no files for %s", d)
    if not paths:
        file = T.StructType([T.StructField("file", T.StringType()), T.StructField("block", T.LongType()), T.StructField("row", T.LongType())])
        return spark.createDataFrame([], T.StructType([*STATES.fields, *(T.StructField(c, T.StringType()) for c in ("date", "source_file")), T.StructField("event_id", file)]))
    raw = spark.read.schema(STATES).option("header", True).option("enforceSchema", not strict).csv(paths)
    name = F.col("_metadata.file_name")
    date = F.regexp_extract(name, r"^states_(\d{4}-\d{2}-\d{2})", 1)
    # a file's rows keep their order: splits start in order and rows count up within one
    ordinal = F.struct(name.alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"))
    return _tidy(raw.select("*", date.alias("date"), name.alias("source_file"), ordinal.alias("event_id")))


def registry(spark: SparkSession, path: str, columns: tuple[str, ...] = ("icao24", "manufacturername", "model")) -> DataFrame:
    """The registry's columns by name; others in the file aren't read."""
    raw = spark.read.option("header", True).csv(path)
    wanted = [f for f in REGISTRY if f.name in columns]
    return _tidy(raw.select(*(F.col(f.name).cast(f.dataType) for f in wanted)))
