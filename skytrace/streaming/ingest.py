"""Incremental ingest: new hourly files, as they arrive, filtered and appended by date."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from skytrace.operators.registry import keep_registered
from skytrace.schemas import STATES


def arriving_states(spark: SparkSession, archive_dir: str, files_per_batch: int = 24) -> DataFrame:
    """Rows of hourly files under ``archive_dir`` as a stream, with ``date`` and ``source_file``."""
    stream = spark.readStream.schema(STATES).option("header", True).option("maxFilesPerTrigger", files_per_batch).csv(archive_dir)
    name = F.element_at(F.split(F.input_file_name(), "/"), -1)
    return stream.withColumn("source_file", name).withColumn("date", F.regexp_extract("source_file", r"^states_(\d{4}-\d{2}-\d{2})", 1))


def ingest(spark: SparkSession, archive_dir: str, registry: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Processes what has arrived, each file once, and stops; call again for more.

    A batch that is run again after a failure replaces its own files only.
    """

    def write(batch: DataFrame, number: int) -> None:
        kept = keep_registered(batch, registry)
        kept.withColumn("batch", F.lit(number)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("date", "batch").parquet(out)

    return arriving_states(spark, archive_dir).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
