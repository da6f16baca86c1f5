"""Shared plumbing: tables, shared scratch space and column-name safety."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skytrace.plans.boundary import remove, scratch

#: Rows and bytes in an Arrow batch handed to a Python operator, at most; a longer single row is a batch of its own.
BATCH_ROWS = 1000
BATCH_BYTES = 32 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def prepare(spark: SparkSession) -> None:
    """Session settings the Python operators rely on; smaller limits that are set already stay.

    They hold for the session, since a plan reads them when it runs.
    """
    for key, most in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        name = f"spark.sql.execution.arrow.{key}"
        now = spark.conf.get(name).rstrip("b")
        if not now.isdigit() or not 0 < int(now) <= most:
            spark.conf.set(name, str(most))
    spark.conf.set("spark.sql.execution.arrow.useLargeVarTypes", "true")


def extended(df: DataFrame, columns: str) -> T.StructType:
    """The schema of ``df`` and then ``columns`` (``name type, ...``)."""
    return T.StructType([*df.schema.fields, *T.StructType.fromDDL(columns).fields])


def with_columns(df: DataFrame, run, columns: str) -> DataFrame:
    """``df`` plus ``columns``, which ``run`` appends to its Arrow batches; names that a batch function can't take are changed on the way."""
    names = df.columns
    plain = df.toDF(*(f"column {i}" if "." in n or "`" in n else n for i, n in enumerate(names)))
    return plain.mapInArrow(run, extended(plain, columns)).toDF(*names, *T.StructType.fromDDL(columns).names)


def quoted(names: list[str]) -> list:
    """Columns by name, whatever characters it holds."""
    return [F.col("`" + n.replace("`", "``") + "`") for n in names]


def materialise(df: DataFrame, tag: str, *partition_by: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage: what is read afterwards survives the loss of any executor
    and is the same for every reader.  Shuffle files of the write are dropped
    when it ends.
    """
    spark = df.sparkSession
    path = scratch(spark, tag)
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        writer = df.write.mode("overwrite").option("compression", "zstd")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(path)
    finally:
        spark.conf.set(key, before)
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch_path = path
    return out


def release(df: DataFrame) -> None:
    """Deletes a table of ``materialise`` that nothing reads any more."""
    remove(df.sparkSession, df.scratch_path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def slots(spark: SparkSession, n: int) -> list[int]:
    """For each of ``n`` partitions a long that ``repartition(n, column)`` sends there, so that numbers, not their hashes, deal."""
    found = spark.range(32 * n, numPartitions=1).groupBy(F.pmod(F.hash("id"), F.lit(n)).alias("p")).agg(F.min("id").alias("id")).collect()
    of = {r["p"]: r["id"] for r in found}
    return [of.get(p, p) for p in range(n)]
