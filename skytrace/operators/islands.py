"""Cutting an aircraft's day into segments by time gap and implied speed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from skytrace.config import Trajectory
from skytrace.functions.geodesy import haversine_m
from skytrace.functions.numeric import round_even
from skytrace.operators.quality import KEY, ORDINAL, by_time
from skytrace.plans.boundary import boundary
from skytrace.schemas import SEGMENT_COLUMNS


def with_deltas(rows: DataFrame, ordinal: str = ORDINAL) -> DataFrame:
    """Seconds, metres and implied speed since the row before; zero on an aircraft's first row.

    Rows without an aircraft belong to no group and go.
    """
    w = by_time(ordinal=ordinal)
    before = {c: F.lag(c).over(w) for c in ("time", "lat", "lon")}
    dist = haversine_m(before["lat"], before["lon"], F.col("lat"), F.col("lon"))
    out = rows.where("icao24 is not null").withColumns({"dt_s": F.coalesce(F.col("time") - before["time"], F.lit(0)), "dist_m": F.coalesce(dist, F.lit(0.0))})
    return out.withColumn("implied_mps", F.when(F.col("dt_s") > 0, F.col("dist_m") / F.col("dt_s")).otherwise(0.0))


def with_cuts(rows: DataFrame, p: Trajectory, ordinal: str = ORDINAL) -> DataFrame:
    """Flags of both cut rules, and the running number of the island within the aircraft's day."""
    flagged = with_deltas(rows, ordinal).withColumns({"time_cut": F.col("dt_s") > p.max_time_gap_s, "speed_cut": F.col("implied_mps") > p.max_implied_mps})
    running = by_time(ordinal=ordinal).rowsBetween(Window.unboundedPreceding, 0)
    return flagged.withColumn("island", F.sum((F.col("time_cut") | F.col("speed_cut")).cast("long")).over(running))


def with_durations(rows: DataFrame) -> DataFrame:
    """Each row with the duration of its island; same partitioning, no exchange."""
    w = Window.partitionBy(*KEY, "island")
    return rows.withColumn("duration_s", F.max("time").over(w) - F.min("time").over(w))


def split_counters(rows: DataFrame, p: Trajectory, ordinal: str = ORDINAL) -> DataFrame:
    """Cuts by either rule and pings of short islands, by date."""
    timed = with_durations(with_cuts(rows, p, ordinal))
    return timed.groupBy("date").agg(
        F.sum(F.col("time_cut").cast("long")).alias("time_splits"), F.sum(F.col("speed_cut").cast("long")).alias("speed_splits"), F.count_if(F.col("duration_s") < p.min_duration_s).alias("pings_discarded")
    )


def date_rank(dates: tuple[str, ...]) -> Column:
    """Place of a date in the configured order; other dates come after, in their own order."""
    if not dates:
        return F.struct(F.lit(0).alias("at"), F.col("date"))
    at = F.coalesce(*(F.when(F.col("date") == d, F.lit(i)) for i, d in enumerate(dates)), F.lit(len(dates)))
    return F.struct(at.alias("at"), F.col("date"))


def segments(rows: DataFrame, p: Trajectory, dates: tuple[str, ...] = (), ordinal: str = ORDINAL) -> DataFrame:
    """Rows of islands that last long enough, with dense ``segment_id`` from 0.

    Ids follow date, aircraft and start time.  An id is the sum of three counts
    of kept islands: on dates before, of aircraft before on that date, and
    before on the aircraft's day; no task sees more than a date's aircraft.  Kept
    rows are written once, as both the counts and the rows read them.
    """
    kept = with_durations(with_cuts(rows, p, ordinal)).where(F.col("duration_s") >= p.min_duration_s)
    # the island is the order that the durations left behind, so this needs no other sort
    local = F.dense_rank().over(Window.partitionBy(*KEY).orderBy("island")) - 1
    names = [c for c in SEGMENT_COLUMNS if c != "segment_id"]
    kept = boundary(kept.withColumn("local_", local.cast("long")).select(*names, ordinal, "local_"))
    aircraft = kept.groupBy(*KEY).agg((F.max("local_") + 1).alias("n_"))
    inside = Window.partitionBy("date").orderBy("icao24").rowsBetween(Window.unboundedPreceding, -1)
    aircraft = aircraft.withColumn("before_", F.coalesce(F.sum("n_").over(inside), F.lit(0)))
    by_date = aircraft.groupBy("date").agg(F.sum("n_").alias("n_"))
    outer = Window.partitionBy().orderBy(date_rank(dates)).rowsBetween(Window.unboundedPreceding, -1)  # a row a date
    by_date = by_date.select("date", F.coalesce(F.sum("n_").over(outer), F.lit(0)).alias("first_"))
    offsets = aircraft.join(by_date, "date").select(*KEY, (F.col("first_") + F.col("before_")).alias("offset_"))
    return kept.join(offsets, KEY).withColumn("segment_id", (F.col("offset_") + F.col("local_")).cast("long")).select(*SEGMENT_COLUMNS, ordinal)


def segment_summary(rows: DataFrame, ordinal: str = ORDINAL) -> DataFrame:
    """One row a segment: who, when, how long, how many pings, and mean and median altitude."""
    first = F.struct("time", ordinal)
    return (
        rows.groupBy("segment_id")
        .agg(
            F.min_by("icao24", first).alias("icao24"),
            F.min_by("callsign", first).alias("callsign"),
            F.min("time").alias("start_time"),
            F.max("time").alias("end_time"),
            F.count("*").alias("n_points"),
            round_even(F.avg("altitude"), 2).alias("mean_alt_m"),
            round_even(F.median("altitude"), 2).alias("median_alt_m"),
            F.min_by("date", first).alias("date"),
        )
        .withColumn("duration_seconds", F.col("end_time") - F.col("start_time"))
        .select("segment_id", "icao24", "callsign", "start_time", "end_time", "duration_seconds", "n_points", "mean_alt_m", "median_alt_m", "date")
    )
