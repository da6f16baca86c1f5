"""Local east-north-up coordinates and their time derivatives, by window expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from skytrace.functions.geodesy import ecef, enu, norm3
from skytrace.functions.numeric import derivative, nan_to_null
from skytrace.operators.quality import ORDINAL
from skytrace.schemas import ENU_COLUMNS

#: Grouping by day and aircraft too keeps the partitioning that segmentation left; the segment alone decides.
SEGMENT_KEY = ["date", "icao24", "segment_id"]


def altitude_column(columns: list[str]) -> str:
    return "geoaltitude" if "geoaltitude" in columns else "altitude"


def _window(key: list[str], ordinal: str):
    return Window.partitionBy(*key).orderBy("time", ordinal)


def first_of_time(rows: DataFrame, key: list[str], ordinal: str) -> DataFrame:
    before = F.lag(F.struct("time")).over(_window(key, ordinal))
    return rows.withColumn("first_", before.isNull() | (before["time"] != F.col("time"))).where("first_").drop("first_")


def gradient(rows: DataFrame, values: dict[str, str], key: list[str], ordinal: str) -> DataFrame:
    """``rows`` plus derivatives by time: ``values`` maps the new column to the one it derives."""
    w = _window(key, ordinal)
    before, after = (f("time").over(w) for f in (F.lag, F.lead))
    return rows.withColumns({new: derivative(F.col(y), F.col("time"), F.lag(y).over(w), before, F.lead(y).over(w), after) for new, y in values.items()})


def with_enu(rows: DataFrame, key: list[str] = SEGMENT_KEY, ordinal: str = ORDINAL) -> DataFrame:
    """All usable pings with coordinates, velocities and ``skip_reason`` (null where the segment is valid)."""
    alt = altitude_column(rows.columns)
    usable = rows.where(" and ".join(f"{c} is not null and not isnan({c})" if c in ("lat", "lon", alt) else f"{c} is not null" for c in ("segment_id", "time", "lat", "lon", alt)))
    usable = first_of_time(usable, key, ordinal)
    w = _window(key, ordinal)
    whole = Window.partitionBy(*key)
    usable = usable.withColumn("ecef_", F.struct(*(c.alias(n) for c, n in zip(ecef(F.col("lat"), F.col("lon"), F.col(alt)), "xyz"))))
    usable = usable.withColumn("origin_", F.first(F.struct("lat", "lon", "ecef_")).over(w))
    parts = lambda s: (F.col(f"{s}.x"), F.col(f"{s}.y"), F.col(f"{s}.z"))
    east, north, up = enu(parts("ecef_"), parts("origin_.ecef_"), F.col("origin_.lat"), F.col("origin_.lon"))
    placed = usable.withColumns({"E_m": east, "N_m": north, "U_m": up}).drop("ecef_", "origin_")
    moved = gradient(placed, {"vE_mps": "E_m", "vN_mps": "N_m", "vU_mps": "U_m"}, key, ordinal)
    n = F.count("*").over(whole)
    missing: Column = F.lit(False)
    for c in ENU_COLUMNS:
        missing = missing | F.col(c).isNull() | F.isnan(c)
    moved = moved.withColumns({"n_": n, "missing_": F.bool_or(missing).over(whole), "at_": F.row_number().over(w)})
    # an origin that isn't a number is no error of the origin but of the output
    off = F.max(F.when(F.col("at_") == 1, F.greatest(*(F.abs(nan_to_null(F.col(c))) for c in ("E_m", "N_m", "U_m"))))).over(whole)
    moved = moved.withColumn("off_", off)
    reason = (
        F.when(F.col("n_") < 3, F.format_string("too_few_points (%d)", "n_"))
        .when(F.col("off_") > 1e-3, F.format_string("origin_error (%.2e m)", "off_"))
        .when(F.col("missing_"), "nan_in_output")
    )
    return moved.withColumn("skip_reason", reason).drop("n_", "missing_", "at_", "off_")


def valid_enu(rows: DataFrame, key: list[str] = SEGMENT_KEY, ordinal: str = ORDINAL) -> DataFrame:
    return with_enu(rows, key, ordinal).where("skip_reason is null").drop("skip_reason")


def enu_summary(rows: DataFrame) -> DataFrame:
    speed = norm3(F.col("vE_mps"), F.col("vN_mps"), F.col("vU_mps"))
    return rows.groupBy("segment_id").agg(
        F.count("*").alias("n_points"),
        F.min("time").alias("start_time"),
        F.max("time").alias("end_time"),
        (F.max("time") - F.min("time")).alias("duration_s"),
        *(F.max(F.abs(c)).alias(f"max_abs_{c}") for c in ("E_m", "N_m", "U_m")),
        F.avg(speed).alias("mean_speed_mps"),
        F.max(speed).alias("max_speed_mps"),
    )


def skip_report(rows: DataFrame) -> DataFrame:
    """How many segments each reason skips; ``rows`` come from ``with_enu``."""
    return rows.where("skip_reason is not null").groupBy("skip_reason").agg(F.count_distinct("segment_id").alias("segments"))


def origin_audit(rows: DataFrame, ordinal: str = ORDINAL) -> DataFrame:
    """Largest offset of any segment's first known point, and missing values in the outputs."""
    order = F.struct("time", ordinal)
    firsts = rows.groupBy("segment_id").agg(
        *(F.abs(F.min_by(c, F.when(F.col(c).isNotNull(), order))).alias(c) for c in ("E_m", "N_m", "U_m")), *(F.count_if(F.col(c).isNull() | F.isnan(c)).alias(f"n_{c}") for c in ENU_COLUMNS)
    )
    nulls = F.lit(0)
    for c in ENU_COLUMNS:
        nulls = nulls + F.sum(f"n_{c}")
    return firsts.agg(F.max(F.greatest("E_m", "N_m", "U_m")).alias("max_origin_m"), F.coalesce(nulls, F.lit(0)).cast("long").alias("nulls"))


def with_accel(rows: DataFrame, key: list[str] = SEGMENT_KEY, ordinal: str = ORDINAL) -> DataFrame:
    """Speed, acceleration by axis and its norm."""
    unique = first_of_time(rows, key, ordinal)
    out = gradient(unique, {"aE_mps2": "vE_mps", "aN_mps2": "vN_mps", "aU_mps2": "vU_mps"}, key, ordinal)
    return out.withColumns({"speed_mps": norm3(F.col("vE_mps"), F.col("vN_mps"), F.col("vU_mps")), "accel_mps2": norm3(F.col("aE_mps2"), F.col("aN_mps2"), F.col("aU_mps2"))})


def null_nan(rows: DataFrame, *columns: str) -> DataFrame:
    return rows.withColumns({c: nan_to_null(F.col(c)) for c in columns})
