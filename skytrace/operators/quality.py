"""Row filters and first-in-order de-duplication, in one pass over (date, icao24)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from skytrace.config import Trajectory
from skytrace.functions.numeric import nan_to_null

#: The order of rows within a file; breaks ties in time.
ORDINAL = "event_id"
KEY = ["date", "icao24"]


def by_time(*keys: str | Column, ordinal: str = ORDINAL):
    return Window.partitionBy(*(keys or KEY)).orderBy("time", ordinal)


def normalise(pings: DataFrame) -> DataFrame:
    """NaN is missing: it never passes a comparison and counts as null."""
    doubles = [f.name for f in pings.schema if f.dataType.typeName() == "double"]
    return pings.withColumns({c: nan_to_null(F.col(c)) for c in doubles})


def unnamed_part() -> Column:
    """Spreads rows without an aircraft by their time, as they would all be one group; 0 for all others."""
    return F.when(F.col("icao24").isNull(), F.pmod(F.xxhash64("time"), F.lit(1024)) + 1).otherwise(0)


def is_first(*keys: str | Column, ordinal: str = ORDINAL) -> Column:
    """Whether a row is the first of its time within the keys, in row order (missing times are alike)."""
    before = F.lag(F.struct("time")).over(by_time(*keys, ordinal=ordinal))
    return before.isNull() | ~before["time"].eqNullSafe(F.col("time"))


def grounded() -> Column:
    """On the ground, or not known to be off it."""
    return F.coalesce("onground", F.lit(True))


def with_step(pings: DataFrame, p: Trajectory, ordinal: str = ORDINAL) -> DataFrame:
    """``pings`` plus ``step``: the first filter that a row fails, or ``after_filter``.

    Rows without a position are dropped before duplicates are looked for, and
    duplicates before the filters on ground and altitude.  A row whose
    ``onground`` is missing counts as on the ground, as in ``clean``.
    """
    placed = F.col("lat").isNotNull() & F.col("lon").isNotNull()
    first = is_first(*KEY, F.col("placed_"), F.col("part_"), ordinal=ordinal)
    step = (
        F.when(~F.col("placed_"), "lat_lon")
        .when(~first, "duplicates")
        .when(grounded(), "onground")
        .when(F.col("geoaltitude").isNull(), "alt_missing")
        .when(~F.col("geoaltitude").between(p.min_alt_m, p.max_alt_m), "alt_range")
        .otherwise("after_filter")
    )
    return normalise(pings).withColumns({"placed_": placed, "part_": unnamed_part()}).withColumn("step", step).drop("placed_", "part_")


def clean(pings: DataFrame, p: Trajectory, ordinal: str = ORDINAL, null_callsign: str | None = None, identified: bool = False) -> DataFrame:
    """Rows that pass all filters, with altitude and trimmed callsign (``null_callsign`` stands for a missing one).

    Rows without an aircraft pass too but never enter a segment: ``identified``
    leaves them out before anything is shuffled, and keeps the partitioning by
    (date, aircraft) that segmentation needs.
    """
    rows = normalise(pings).where("lat is not null and lon is not null")
    if identified:
        rows, first = rows.where("icao24 is not null"), is_first(ordinal=ordinal)
    else:
        first = is_first(*KEY, unnamed_part(), ordinal=ordinal)
    rows = rows.withColumn("first_", first).where(F.col("first_") & ~grounded())
    rows = rows.where(F.col("geoaltitude").between(p.min_alt_m, p.max_alt_m))
    callsign = F.trim("callsign") if null_callsign is None else F.coalesce(F.trim("callsign"), F.lit(null_callsign))
    return rows.drop("first_").withColumns({"altitude": F.col("geoaltitude"), "callsign": callsign})


STEPS = ["lat_lon", "duplicates", "onground", "alt_missing", "alt_range", "after_filter"]


def drop_counts(pings: DataFrame, p: Trajectory, ordinal: str = ORDINAL) -> DataFrame:
    """Rows by date: all, dropped by each step, and left."""
    counts = [F.count_if(F.col("step") == s).alias(s) for s in STEPS]
    return with_step(pings, p, ordinal).groupBy("date").agg(F.count("*").alias("raw"), *counts)
