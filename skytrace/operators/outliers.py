"""Dropping whole segments whose speed or acceleration is implausible."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from skytrace.config import Cleaning
from skytrace.operators.kinematics import SEGMENT_KEY, with_accel
from skytrace.operators.quality import ORDINAL
from skytrace.schemas import ACCEL_COLUMNS

METRICS = ["mean_speed_mps", "p95_speed_mps", "max_speed_mps", "mean_accel_mps2", "p95_accel_mps2", "max_accel_mps2"]


def drop_reason(n: Column, speed: Column, accel: Column, p: Cleaning) -> Column:
    """Class of a segment by its maxima; a missing maximum is no outlier."""
    fast = F.coalesce(speed > p.max_speed_mps, F.lit(False))
    hard = F.coalesce(accel > p.max_accel_mps2, F.lit(False))
    return F.when(n < 3, "too_few_points").when(fast & hard, "speed_and_accel_outlier").when(fast, "speed_outlier").when(hard, "accel_outlier").otherwise("keep")


def cleaning_summary(rows: DataFrame, p: Cleaning, key: list[str] = SEGMENT_KEY, ordinal: str = ORDINAL) -> DataFrame:
    """One row a segment with exact percentiles and ``drop_reason``; metrics are null under three points."""
    moved = with_accel(rows, key, ordinal)
    out = moved.groupBy("segment_id").agg(
        F.count("*").alias("n_points"),
        F.min("time").alias("start_time"),
        F.max("time").alias("end_time"),
        (F.max("time") - F.min("time")).alias("duration_s"),
        F.avg("speed_mps").alias("mean_speed_mps"),
        F.percentile("speed_mps", 0.95).alias("p95_speed_mps"),
        F.max("speed_mps").alias("max_speed_mps"),
        F.avg("accel_mps2").alias("mean_accel_mps2"),
        F.percentile("accel_mps2", 0.95).alias("p95_accel_mps2"),
        F.max("accel_mps2").alias("max_accel_mps2"),
    )
    out = out.withColumns({m: F.when(F.col("n_points") >= 3, F.col(m)) for m in METRICS})
    return out.withColumn("drop_reason", drop_reason(F.col("n_points"), F.col("max_speed_mps"), F.col("max_accel_mps2"), p))


def clean_segments(rows: DataFrame, p: Cleaning, key: list[str] = SEGMENT_KEY, ordinal: str = ORDINAL) -> DataFrame:
    """Rows of segments that are kept, with speed and acceleration; windows only, no join."""
    w = Window.partitionBy(*key)
    moved = with_accel(rows, key, ordinal)
    moved = moved.withColumn("reason_", drop_reason(F.count("*").over(w), F.max("speed_mps").over(w), F.max("accel_mps2").over(w), p))
    kept = moved.where("reason_ = 'keep'").drop("reason_")
    return kept.select(*[c for c in kept.columns if c not in ACCEL_COLUMNS], *ACCEL_COLUMNS)


def dropped(summary: DataFrame) -> DataFrame:
    return summary.where("drop_reason <> 'keep'")


def reason_histogram(summary: DataFrame) -> DataFrame:
    return summary.groupBy("drop_reason").agg(F.count("*").alias("segments")).orderBy(F.desc("segments"), "drop_reason")
