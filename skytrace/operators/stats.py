"""Run key figures."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skytrace.functions.numeric import one_decimal


def run_kpis(registry: DataFrame, cleaned: DataFrame, summary: DataFrame) -> DataFrame:
    """(Metric, Value) as text: registry size, aircraft seen after the row filters, segments, pings, durations."""
    one = F.lit(1).alias("one_")
    a = registry.agg(F.count("*").alias("registry")).select("registry", one)
    b = cleaned.agg(F.count_distinct("icao24").alias("aircraft")).select("aircraft", one)
    minutes = F.col("duration_seconds") / 60
    c = summary.agg(
        F.count("*").alias("segments"), F.coalesce(F.sum("n_points"), F.lit(0)).alias("pings"), F.avg(minutes).alias("mean"), F.median(minutes).alias("median"), F.max(minutes).alias("max")
    ).select("*", one)
    text = lambda c: F.concat(one_decimal(c), F.lit(" min"))
    metrics = [
        ("Aircraft in registry", F.col("registry").cast("string")),
        ("Aircraft observed", F.col("aircraft").cast("string")),
        ("Trajectory segments", F.col("segments").cast("string")),
        ("Pings in segments", F.col("pings").cast("string")),
        ("Mean segment duration", text(F.col("mean"))),
        ("Median segment duration", text(F.col("median"))),
        ("Max segment duration", text(F.col("max"))),
    ]
    joined = a.join(b, "one_").join(c, "one_")
    return joined.select(F.inline(F.array(*(F.struct(F.lit(n).alias("Metric"), v.alias("Value")) for n, v in metrics))))
