"""Pings and a registry derived from the driver's tables, for tests and queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skytrace.config import KNOT, Cleaning, Config, Sequences, Split, Trajectory
from skytrace.plans.boundary import scratch
from skytrace.schemas import STATES

#: The tables are sampled far more sparsely than real tracks, so all limits are wider.
FIXTURE = Config(
    dates=("2024-01-01", "2024-01-15"),
    trajectory=Trajectory(max_time_gap_s=172_800, max_implied_kt=3.0 / KNOT, min_duration_s=300),
    cleaning=Cleaning(max_speed_mps=2.75, max_accel_mps2=0.0003),
    split=Split(),
    sequences=Sequences(sequence_length=10, stride=5),
)


def pings(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "ts", "user_id", "event_type", "value", "props")
    k = F.get_json_object("props", "$.k").cast("int")
    rows = events.select(
        "event_id",
        F.lower(F.lpad(F.hex("user_id"), 6, "0")).alias("icao24"),
        F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 1_000_000).cast("long").alias("time"),
        F.when(F.col("event_id") % 97 != 0, F.lit(50.0) + F.lit(0.001) * k + F.lit(0.0005) * F.col("value")).alias("lat"),
        (F.lit(-1.0) + F.lit(0.002) * k).alias("lon"),
        F.when(F.col("event_id") % 89 != 0, F.lit(100.0) + F.lit(50.0) * k).alias("geoaltitude"),
        ((F.col("event_type") == "signup") & (k % 4 == 0)).alias("onground"),
        F.when(F.col("event_id") % 5 != 0, F.concat(F.lit(" CS"), k.cast("string"), F.lit(" "))).alias("callsign"),
        *(F.lit(None).cast("double").alias(c) for c in ("velocity", "heading", "vertrate")),
        F.lit(None).cast("string").alias("squawk"),
    ).withColumn("date", F.when(F.col("time") < 1_705_276_800, "2024-01-01").otherwise("2024-01-15"))
    again = rows.where(F.col("event_id") % 50 == 0).withColumn("event_id", F.col("event_id") + 1_000_000_000)
    return rows.unionByName(again)


def rough_pings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pings of which some lack the aircraft, the ground flag, or have NaN for a position or altitude."""
    nan, k = F.lit(float("nan")), F.col("event_id")
    changes = {"onground": (13, F.lit(None).cast("boolean")), "geoaltitude": (17, nan), "icao24": (31, F.lit(None).cast("string")), "lat": (43, nan)}
    return pings(spark, sf_dir).withColumns({c: F.when(k % n == 0, x).otherwise(F.col(c)) for c, (n, x) in changes.items()})


def rough_segments(segments: DataFrame) -> DataFrame:
    """Segment rows with second pings at the same time, missing latitudes and a few endless longitudes."""
    k = F.col("event_id")
    again = segments.where(k % 7 == 0).withColumns({"event_id": k + 2_000_000_000, "altitude": F.col("altitude") + 1})
    rows = segments.unionByName(again)
    return rows.withColumns({"lat": F.when(k % 19 != 0, F.col("lat")), "lon": F.when(k % 101 == 0, F.lit(float("inf"))).otherwise(F.col("lon"))})


def archive(spark: SparkSession, sf_dir: str) -> str:
    """A folder with the pings as hourly state files, two a date, and the registry as ``registry.csv``."""
    folder = scratch(spark, "archive")
    fs = spark._jvm.org.apache.hadoop.fs.Path(folder).getFileSystem(spark._jsc.hadoopConfiguration())

    def single(df: DataFrame, name: str) -> None:
        options = {"header": True, "nullValue": "nan", "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
        df.coalesce(1).write.options(**options).csv(f"{folder}/parts-{name}")
        path = spark._jvm.org.apache.hadoop.fs.Path
        written = fs.globStatus(path(f"{folder}/parts-{name}/part-*.csv"))
        fs.rename(written[0].getPath(), path(f"{folder}/{name}"))

    rows = pings(spark, sf_dir)
    columns = [F.col(f.name).cast(f.dataType) if f.name in rows.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in STATES]
    for date in FIXTURE.dates:
        for hour in range(2):
            mine = rows.where((F.col("date") == date) & (F.col("event_id") % 2 == hour)).orderBy("event_id")
            single(mine.select(*columns), f"states_{date}-{hour:02d}.csv")
    single(registry(spark, sf_dir).select("model", "icao24", F.lit("x").alias("owner"), "manufacturername"), "registry.csv")
    return folder


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = spark.read.parquet(f"{sf_dir}/part.parquet").select("p_partkey", "p_size", "p_type")
    kind = F.col("p_partkey") % 7
    size = F.col("p_size").cast("string")
    names = ["CESSNA", "Reims Aviation", "PIPER", "Cirrus Design", "Diamond Aircraft", "BOEING", None]
    models = [
        F.concat((100 + 10 * (F.col("p_size") % 13)).cast("string"), F.substring("p_type", 1, 1)),
        F.concat(F.lit("F"), (150 + 2 * (F.col("p_size") % 20)).cast("string")),
        F.concat(F.lit("PA-"), size),
        F.concat(F.lit("SR2"), (F.col("p_size") % 4).cast("string")),
        F.concat(F.lit("DA "), size),
        F.lit("737"),
        F.lit("172"),
    ]
    pick = lambda xs: F.coalesce(*(F.when(kind == i, x) for i, x in enumerate(xs)))
    return part.select(F.lower(F.lpad(F.hex("p_partkey"), 6, "0")).alias("icao24"), pick([F.lit(n) for n in names]).alias("manufacturername"), pick(models).alias("model"))
