"""Queries by name over the driver's tables, and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skytrace.functions.geodesy import WGS84_A, WGS84_E2, ecef, enu, haversine_m
from skytrace.functions.numeric import round_even
from skytrace.operators import islands, kinematics, outliers, partitioning, quality, stats, windows
from skytrace.operators import registry as reg
from skytrace.plans import stages
from skytrace.plans.boundary import boundary, scratch
from skytrace.plans.counters import Counters
from skytrace.schemas import ENU_COLUMNS
from skytrace.sources import fixtures, sinks, states
from skytrace.sources.fixtures import FIXTURE

T, C, S = FIXTURE.trajectory, FIXTURE.cleaning, FIXTURE.sequences


def _round(df: DataFrame, places: dict[str, int]) -> DataFrame:
    return df.withColumns({c: round_even(F.col(c), p) for c, p in places.items() if c in df.columns})


#: Decimals to which results are compared.
PLACES = (
    {c: 4 for c in ("E_m", "N_m", "U_m", "max_abs_E_m", "max_abs_N_m", "max_abs_U_m", "dist_m")}
    | {c: 6 for c in ("vE_mps", "vN_mps", "vU_mps", "speed_mps", "mean_speed_mps", "p95_speed_mps", "max_speed_mps", "implied_mps", "altitude", "lat", "lon")}
    | {c: 8 for c in ("aE_mps2", "aN_mps2", "aU_mps2", "accel_mps2", "mean_accel_mps2", "p95_accel_mps2", "max_accel_mps2")}
)


def _cleaned(spark: SparkSession, d: str) -> DataFrame:
    return quality.clean(fixtures.pings(spark, d), T)


def _tracked(spark: SparkSession, d: str) -> DataFrame:
    return quality.clean(fixtures.pings(spark, d), T, identified=True)


def _segments(spark: SparkSession, d: str) -> DataFrame:
    return stages.trajectory_segments(fixtures.pings(spark, d), FIXTURE)


def _marked(spark: SparkSession, d: str) -> DataFrame:
    return kinematics.with_enu(_segments(spark, d))


def _enu(spark: SparkSession, d: str) -> DataFrame:
    return kinematics.valid_enu(_segments(spark, d))


def _clean(spark: SparkSession, d: str) -> DataFrame:
    return stages.clean_segments(_enu(spark, d), FIXTURE)


def _routed(spark: SparkSession, d: str) -> DataFrame:
    return stages.split_segments(_clean(spark, d), FIXTURE)


def _rows(spark: SparkSession, d: str) -> DataFrame:
    return windows.validated(_routed(spark, d), S)


def _windows(spark: SparkSession, d: str) -> DataFrame:
    return stages.sequence_windows(_routed(spark, d), FIXTURE)


def _stages(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Rows and windows over one run of what comes before."""
    routed = _routed(spark, d)
    return windows.validated(routed, S), stages.sequence_windows(routed, FIXTURE)


def registry_brand_filter(spark, d):
    return fixtures.registry(spark, d).where(reg.has_brand(F.col("manufacturername")))


def registry_model_filter(spark, d):
    return reg.filter_registry(fixtures.registry(spark, d))


def registry_size(spark, d):
    r = fixtures.registry(spark, d)
    kept = reg.has_brand(F.col("manufacturername")) & reg.has_model(F.col("manufacturername"), F.col("model"))
    return r.agg(F.count("*").alias("registry"), F.count_if(kept).alias("kept"))


def states_semi_registry(spark, d):
    return reg.order_states(stages.registered_states(fixtures.pings(spark, d), fixtures.registry(spark, d))).select("event_id", "icao24", "time", "date")


def haversine(spark, d):
    p = fixtures.pings(spark, d).where("lat is not null")
    dist = haversine_m(F.col("lat"), F.col("lon"), F.lit(50.0), F.lit(-1.0))
    return p.select("event_id", round_even(dist, 4).alias("dist_m"))


def geodetic_enu(spark, d):
    p = fixtures.pings(spark, d).where("lat is not null and geoaltitude is not null")
    origin = (F.lit(50.0), F.lit(-1.0), F.lit(100.0))
    point = ecef(F.col("lat"), F.col("lon"), F.col("geoaltitude"))
    e, n, u = enu(point, ecef(*origin), origin[0], origin[1])
    return p.select("event_id", *(round_even(c, 3).alias(k) for c, k in zip(point, ("x_m", "y_m", "z_m"))), *(round_even(c, 4).alias(k) for c, k in zip((e, n, u), ("E_m", "N_m", "U_m"))))


def quality_filtered(spark, d):
    return _round(_cleaned(spark, d).select("event_id", "icao24", "time", "lat", "lon", "altitude", "callsign", "date"), PLACES)


def quality_drop_counts(spark, d):
    return quality.drop_counts(fixtures.pings(spark, d), T)


def dedupe_first(spark, d):
    p = fixtures.pings(spark, d).where("lat is not null and lon is not null")
    return p.withColumn("first_", quality.is_first()).where("first_").select("event_id", "icao24", "time", "date")


def ping_deltas(spark, d):
    return _round(islands.with_deltas(_tracked(spark, d)).select("event_id", "dt_s", "dist_m", "implied_mps"), PLACES)


def cut_flags(spark, d):
    return islands.with_cuts(_tracked(spark, d), T).select("event_id", "time_cut", "speed_cut")


def segment_islands(spark, d):
    return islands.with_durations(islands.with_cuts(_tracked(spark, d), T)).select("event_id", "icao24", "date", "island", "duration_s")


def split_counters(spark, d):
    return islands.split_counters(_tracked(spark, d), T)


def segment_rows(spark, d):
    return _segments(spark, d).select("event_id", "segment_id", "icao24", "time", "callsign", "date")


def segment_summary(spark, d):
    return islands.segment_summary(_segments(spark, d))


def run_kpis(spark, d):
    return stats.run_kpis(reg.filter_registry(fixtures.registry(spark, d)), _cleaned(spark, d), islands.segment_summary(_segments(spark, d)))


def enu_coordinates(spark, d):
    return _round(_enu(spark, d).select("event_id", "segment_id", "E_m", "N_m", "U_m"), PLACES)


def enu_velocity(spark, d):
    return _round(_enu(spark, d).select("event_id", "segment_id", "vE_mps", "vN_mps", "vU_mps"), PLACES)


def enu_summary(spark, d):
    return _round(kinematics.enu_summary(_enu(spark, d)), PLACES)


def enu_skip_reasons(spark, d):
    return kinematics.skip_report(_marked(spark, d))


def origin_audit(spark, d):
    return _round(kinematics.origin_audit(_enu(spark, d)), {"max_origin_m": 4})


def kinematics_accel(spark, d):
    return _round(kinematics.with_accel(_enu(spark, d)).select("event_id", "segment_id", "speed_mps", "aE_mps2", "aN_mps2", "aU_mps2", "accel_mps2"), PLACES)


def cleaning_summary(spark, d):
    return _round(outliers.cleaning_summary(_enu(spark, d), C), PLACES)


def drop_reason_histogram(spark, d):
    return outliers.reason_histogram(outliers.cleaning_summary(_enu(spark, d), C))


def clean_rows(spark, d):
    return _round(_clean(spark, d).select("event_id", "segment_id", "time", *ENU_COLUMNS, "speed_mps", "accel_mps2"), PLACES)


def dropped_segments(spark, d):
    return outliers.dropped(outliers.cleaning_summary(_enu(spark, d), C)).select("segment_id", "n_points", "drop_reason")


def split_assignment(spark, d):
    return partitioning.assign(boundary(_clean(spark, d)), FIXTURE.split)


def split_rows(spark, d):
    return _routed(spark, d).select("event_id", "segment_id", "split")


def split_summary(spark, d):
    return partitioning.split_statistics(_routed(spark, d))


def split_summary_sampled(spark, d):
    return partitioning.split_statistics(_routed(spark, d), sample_every=10)


def split_overlap_check(spark, d):
    return partitioning.overlap(boundary(split_assignment(spark, d)))


def norm_stats(spark, d):
    return _round(windows.normalisation(_rows(spark, d).where("split = 'train'"), S), {"mean": 6, "std": 6})


def sequence_windows(spark, d):
    return _round(windows.flat(_windows(spark, d), S), {f: 6 for f in S.features})


def sequence_metadata(spark, d):
    return windows.metadata(_windows(spark, d))


def sequence_dataset_summary(spark, d):
    return windows.dataset_summary(_rows(spark, d), S)


def normalised_moments(spark, d):
    return _round(windows.normalised_moments(_windows(spark, d), S), {"norm_mean": 6, "norm_std": 6})


def sanity_checks(spark, d):
    rows, cut = _stages(spark, d)
    return windows.sanity_checks(cut, rows, S)


def rough_drop_counts(spark, d):
    return quality.drop_counts(fixtures.rough_pings(spark, d), T)


def rough_filtered(spark, d):
    return _round(quality.clean(fixtures.rough_pings(spark, d), T).select("event_id", "icao24", "time", "lat", "altitude", "date"), PLACES)


def rough_skip_reasons(spark, d):
    return kinematics.skip_report(kinematics.with_enu(fixtures.rough_segments(_segments(spark, d))))


def short_segment_summary(spark, d):
    """Stage 06 over all located segments, also those under three points."""
    rows = outliers.cleaning_summary(_marked(spark, d).drop("skip_reason"), C)
    return _round(rows.select("segment_id", "n_points", "duration_s", "max_speed_mps", "max_accel_mps2", "drop_reason"), PLACES)


def state_files(spark, d):
    """Hourly files written, and read back with a date that has none."""
    rows = states.hourly_states(spark, fixtures.archive(spark, d), (*FIXTURE.dates, "2031-01-01"))
    return rows.select("time", "icao24", "lat", "lon", "geoaltitude", "onground", F.trim("callsign").alias("callsign"), "date", "source_file")


def registry_file(spark, d):
    return states.registry(spark, f"{fixtures.archive(spark, d)}/registry.csv")


def split_sink(spark, d):
    """Rows written by split over an earlier run's table, and read back."""
    path = scratch(spark, "splits")
    routed = _routed(spark, d).select("event_id", "segment_id", "split")
    sinks.write_parquet(routed.withColumn("split", F.lit("old")), path, "split")
    sinks.write_parquet(routed, path, "split")
    return spark.read.parquet(path).select("event_id", "segment_id", F.col("split").cast("string").alias("split"))


def date_sink(spark, d):
    """Rows written by date: what is written again replaces its dates only, even if nothing is left of one."""
    path, rows = scratch(spark, "states"), _cleaned(spark, d).select("event_id", "date")
    first, second = FIXTURE.dates
    sinks.write_partitions(rows, path, "date", FIXTURE.dates)
    sinks.write_partitions(rows.where("event_id % 2 = 0"), path, "date", (second,))
    sinks.write_partitions(rows, path, "date", ("2031-01-01",))
    return spark.read.parquet(path).select("event_id", F.col("date").cast("string").alias("date"))


def tensor_sink(spark, d):
    """The train tensor as written to a file and read back, a row a step."""
    import tempfile

    import numpy as np

    train = boundary(_windows(spark, d).where("split = 'train'"))
    n, length, width = train.count(), S.sequence_length, len(S.features)
    with tempfile.TemporaryDirectory() as folder:
        sinks.export_tensor(train, f"{folder}/x.npy", n, length, width)
        x = np.load(f"{folder}/x.npy")
    rows = [(i, k, *map(float, x[i, k])) for i in range(n) for k in range(length)]
    columns = ", ".join(f"{f} double" for f in S.features)
    return _round(spark.createDataFrame(rows, f"sequence_id bigint, step bigint, {columns}"), {f: 6 for f in S.features})


def cleaning_counters(spark, d):
    """Rows and segments in and out of stage 06, counted while it is written."""
    seen, enu = Counters(), boundary(_enu(spark, d))
    boundary(seen.watch(stages.clean_segments(seen.watch(enu, "in"), FIXTURE), "out"))
    boundary(seen.watch(outliers.cleaning_summary(enu, C), "segments", kept=F.count_if(F.col("drop_reason") == "keep")))
    told = seen.told()
    return spark.createDataFrame([(told["in"]["rows"], told["out"]["rows"], told["segments"]["rows"], told["segments"]["kept"])], "rows_in bigint, rows_out bigint, segments_in bigint, segments_kept bigint")


def incomplete_rows(spark, d):
    """Rows that stage 08 drops as incomplete, counted while the rest is written."""
    seen = Counters()
    holes = _clean(spark, d).withColumns({"E_m": F.when(F.col("event_id") % 23 != 0, F.col("E_m")), "vN_mps": F.when(F.col("event_id") % 29 == 0, F.lit(float("nan"))).otherwise(F.col("vN_mps"))})
    boundary(seen.watch(windows.validated(seen.watch(holes, "rows", dropped=windows.incomplete(S)), S), "complete"))
    told = seen.told()
    return spark.createDataFrame([(told["rows"]["rows"], told["rows"]["dropped"], told["complete"]["rows"])], "rows bigint, dropped bigint, complete bigint")


ALL = [
    registry_brand_filter, registry_model_filter, registry_size, states_semi_registry, haversine, geodetic_enu, quality_filtered, quality_drop_counts, dedupe_first, ping_deltas, cut_flags,
    segment_islands, split_counters, segment_rows, segment_summary, run_kpis, enu_coordinates, enu_velocity, enu_summary, enu_skip_reasons, origin_audit, kinematics_accel, cleaning_summary,
    drop_reason_histogram, clean_rows, dropped_segments, split_assignment, split_rows, split_summary, split_summary_sampled, split_overlap_check, norm_stats, sequence_windows, sequence_metadata,
    sequence_dataset_summary, normalised_moments, sanity_checks, rough_drop_counts, rough_filtered, rough_skip_reasons, short_segment_summary, state_files, registry_file, split_sink, date_sink,
    tensor_sink, cleaning_counters, incomplete_rows,
]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in ALL}


# --- SQL twins -------------------------------------------------------------------------------------------------


def _r(x: str, places: int, name: str | None = None) -> str:
    k = float(10**places)
    return f"round_even(({x}) * {k!r}, 0) / {k!r} + 0.0 AS {name or x}"


def _hav(a: str, b: str, c: str, d: str) -> str:
    x = f"pow(sin(radians({c} - {a}) / 2), 2) + cos(radians({a})) * cos(radians({c})) * pow(sin(radians({d} - {b}) / 2), 2)"
    return f"2 * 6371000.0 * asin(sqrt(least(greatest({x}, 0.0), 1.0)))"


def _ecef(lat: str, lon: str, alt: str, p: str = "") -> str:
    n = f"({WGS84_A!r} / sqrt(1.0 - {WGS84_E2!r} * pow(sin(radians({lat})), 2)))"
    ring = f"({n} + {alt}) * cos(radians({lat}))"
    return f"{ring} * cos(radians({lon})) AS {p}x, {ring} * sin(radians({lon})) AS {p}y, ({n} * (1.0 - {WGS84_E2!r}) + {alt}) * sin(radians({lat})) AS {p}z"


def _enu_sql(lat0: str, lon0: str) -> str:
    f, g = f"radians({lat0})", f"radians({lon0})"
    along = f"(cos({g}) * (x - x0) + sin({g}) * (y - y0))"
    return f"-sin({g}) * (x - x0) + cos({g}) * (y - y0) AS E_m, -sin({f}) * {along} + cos({f}) * (z - z0) AS N_m, cos({f}) * {along} + sin({f}) * (z - z0) AS U_m"


def _grad(y: str, name: str) -> str:
    a, b, d1, d2 = f"lag({y}) OVER w", f"lead({y}) OVER w", '(time - lag(time) OVER w)::DOUBLE', '(lead(time) OVER w - time)::DOUBLE'
    return f"""CASE WHEN lag(time) OVER w IS NULL THEN ({b} - {y}) / {d2} WHEN lead(time) OVER w IS NULL THEN ({y} - {a}) / {d1}
      ELSE -{d2} / ({d1} * ({d1} + {d2})) * {a} + ({d2} - {d1}) / ({d1} * {d2}) * {y} + {d1} / ({d2} * ({d1} + {d2})) * {b} END AS {name}"""


_LENGTH, _STRIDE = S.sequence_length, S.stride
_MODEL = lambda core, tail=True: f"(^|[^0-9])({core})([^0-9]|$)" if tail else core

#: Steps that build on one another; each query's text takes those it needs.
STEPS: dict[str, str] = {
    "events_k": "SELECT event_id, user_id, epoch_us(ts) // 1000000 AS time, event_type, value AS v, json_extract_string(props, '$.k')::INTEGER AS k FROM events",
    "once": """SELECT event_id, lower(lpad(to_hex(user_id), 6, '0')) AS icao24, time,
      CASE WHEN event_id % 97 <> 0 THEN 50.0::DOUBLE + 0.001::DOUBLE * k + 0.0005::DOUBLE * v END AS lat, -1.0::DOUBLE + 0.002::DOUBLE * k AS lon,
      CASE WHEN event_id % 89 <> 0 THEN 100.0::DOUBLE + 50.0::DOUBLE * k END AS geoaltitude, event_type = 'signup' AND k % 4 = 0 AS onground,
      CASE WHEN event_id % 5 <> 0 THEN ' CS' || k || ' ' END AS callsign, CASE WHEN time < 1705276800 THEN '2024-01-01' ELSE '2024-01-15' END AS date FROM events_k""",
    "pings": "SELECT * FROM once UNION ALL SELECT * REPLACE (event_id + 1000000000 AS event_id) FROM once WHERE event_id % 50 = 0",
    "numbered": "SELECT *, row_number() OVER (PARTITION BY date, icao24, time ORDER BY event_id) AS rn FROM pings WHERE lat IS NOT NULL AND lon IS NOT NULL",
    "cleaned": f"SELECT event_id, icao24, time, lat, lon, geoaltitude AS altitude, trim(callsign) AS callsign, date FROM numbered WHERE rn = 1 AND NOT onground AND geoaltitude BETWEEN {T.min_alt_m} AND {T.max_alt_m}",
    "deltas": f"""SELECT *, coalesce(time - lag(time) OVER w, 0) AS dt_s, coalesce({_hav('lag(lat) OVER w', 'lag(lon) OVER w', 'lat', 'lon')}, 0.0) AS dist_m
      FROM cleaned WINDOW w AS (PARTITION BY date, icao24 ORDER BY time, event_id)""",
    "flagged": f"SELECT *, CASE WHEN dt_s > 0 THEN dist_m / dt_s ELSE 0.0 END AS implied_mps, dt_s > {T.max_time_gap_s} AS time_cut, (CASE WHEN dt_s > 0 THEN dist_m / dt_s ELSE 0.0 END) > {T.max_implied_mps!r}::DOUBLE AS speed_cut FROM deltas",
    "cut": "SELECT *, (sum((time_cut OR speed_cut)::INT) OVER (PARTITION BY date, icao24 ORDER BY time, event_id ROWS UNBOUNDED PRECEDING))::BIGINT AS island FROM flagged",
    "timed": "SELECT *, max(time) OVER (PARTITION BY date, icao24, island) - min(time) OVER (PARTITION BY date, icao24, island) AS duration_s FROM cut",
    "segs": f"SELECT *, dense_rank() OVER (ORDER BY date, icao24, island) - 1 AS segment_id FROM timed WHERE duration_s >= {T.min_duration_s}",
    "summary": """SELECT segment_id, min(icao24) AS icao24, arg_min_null(callsign, (time, event_id)) AS callsign, min(time) AS start_time, max(time) AS end_time, max(time) - min(time) AS duration_seconds,
      count(*) AS n_points, round_even(avg(altitude) * 100.0, 0) / 100.0 + 0.0 AS mean_alt_m, round_even(median(altitude) * 100.0, 0) / 100.0 + 0.0 AS median_alt_m, min(date) AS date FROM segs GROUP BY segment_id""",
    "ecef": f"SELECT *, {_ecef('lat', 'lon', 'altitude')} FROM segs",
    "origin": "SELECT *, count(*) OVER (PARTITION BY segment_id) AS n, first_value(lat) OVER w AS lat0, first_value(lon) OVER w AS lon0, first_value(x) OVER w AS x0, first_value(y) OVER w AS y0, first_value(z) OVER w AS z0 FROM ecef WINDOW w AS (PARTITION BY segment_id ORDER BY time, event_id)",
    "placed": f"SELECT event_id, segment_id, time, date, icao24, n, {_enu_sql('lat0', 'lon0')} FROM origin",
    "enu": f"SELECT *, {_grad('E_m', 'vE_mps')}, {_grad('N_m', 'vN_mps')}, {_grad('U_m', 'vU_mps')} FROM placed WHERE n >= 3 WINDOW w AS (PARTITION BY segment_id ORDER BY time)",
    "accel_axes": f"SELECT *, sqrt(vE_mps * vE_mps + vN_mps * vN_mps + vU_mps * vU_mps) AS speed_mps, {_grad('vE_mps', 'aE_mps2')}, {_grad('vN_mps', 'aN_mps2')}, {_grad('vU_mps', 'aU_mps2')} FROM enu WINDOW w AS (PARTITION BY segment_id ORDER BY time)",
    "accel": "SELECT *, sqrt(aE_mps2 * aE_mps2 + aN_mps2 * aN_mps2 + aU_mps2 * aU_mps2) AS accel_mps2 FROM accel_axes",
    "cleaning": f"""SELECT *, CASE WHEN max_speed_mps > {C.max_speed_mps} AND max_accel_mps2 > {C.max_accel_mps2} THEN 'speed_and_accel_outlier' WHEN max_speed_mps > {C.max_speed_mps} THEN 'speed_outlier'
      WHEN max_accel_mps2 > {C.max_accel_mps2} THEN 'accel_outlier' ELSE 'keep' END AS drop_reason
      FROM (SELECT segment_id, count(*) AS n_points, min(time) AS start_time, max(time) AS end_time, max(time) - min(time) AS duration_s, avg(speed_mps) AS mean_speed_mps, quantile_cont(speed_mps, 0.95) AS p95_speed_mps,
      max(speed_mps) AS max_speed_mps, avg(accel_mps2) AS mean_accel_mps2, quantile_cont(accel_mps2, 0.95) AS p95_accel_mps2, max(accel_mps2) AS max_accel_mps2 FROM accel GROUP BY segment_id)""",
    "clean": "SELECT accel.* FROM accel JOIN cleaning USING (segment_id) WHERE drop_reason = 'keep'",
    "assigned": f"""SELECT segment_id, CASE WHEN row_number() OVER (ORDER BY md5('{FIXTURE.split.seed}:' || segment_id), segment_id) <= floor(count(*) OVER () * {FIXTURE.split.train_frac}::DOUBLE) THEN 'train' ELSE 'test' END AS split
      FROM (SELECT DISTINCT segment_id FROM clean)""",
    "routed": "SELECT clean.*, split FROM clean JOIN assigned USING (segment_id)",
    "scale": "SELECT " + ", ".join(f"avg({f}) AS m_{f}, CASE WHEN stddev_samp({f}) = 0 THEN 1.0 ELSE stddev_samp({f}) END AS s_{f}" for f in S.features) + " FROM routed WHERE split = 'train'",
    "points": "SELECT split, segment_id, time, row_number() OVER (PARTITION BY segment_id ORDER BY time) - 1 AS i, count(*) OVER (PARTITION BY segment_id) AS n, "
    + ", ".join(f"({f} - m_{f}) / s_{f} AS {f}" for f in S.features)
    + " FROM routed CROSS JOIN scale",
    "starts": f"""SELECT split, segment_id, i AS start, n, time AS start_time, row_number() OVER (PARTITION BY split ORDER BY segment_id, i) - 1 AS sequence_id FROM points WHERE i % {_STRIDE} = 0 AND i + {_LENGTH} <= n""",
    "steps": f"SELECT s.split, s.sequence_id, p.i - s.start AS step, " + ", ".join(f"p.{f}" for f in S.features) + f" FROM starts s JOIN points p ON p.segment_id = s.segment_id AND p.i BETWEEN s.start AND s.start + {_LENGTH - 1}",
    "aircraft": """SELECT lower(lpad(to_hex(p_partkey), 6, '0')) AS icao24,
      CASE p_partkey % 7 WHEN 0 THEN 'CESSNA' WHEN 1 THEN 'Reims Aviation' WHEN 2 THEN 'PIPER' WHEN 3 THEN 'Cirrus Design' WHEN 4 THEN 'Diamond Aircraft' WHEN 5 THEN 'BOEING' END AS manufacturername,
      CASE p_partkey % 7 WHEN 0 THEN (100 + 10 * (p_size % 13)) || substr(p_type, 1, 1) WHEN 1 THEN 'F' || (150 + 2 * (p_size % 20)) WHEN 2 THEN 'PA-' || p_size WHEN 3 THEN 'SR2' || (p_size % 4)
      WHEN 4 THEN 'DA ' || p_size WHEN 5 THEN '737' ELSE '172' END AS model FROM part""",
    "branded": f"SELECT * FROM aircraft WHERE coalesce(regexp_matches(manufacturername, '{reg.BRAND}'), false)",
    "kept_aircraft": r"""SELECT * FROM branded WHERE CASE
      WHEN regexp_matches(lower(manufacturername), 'cessna|reims|fuji.*cessna') THEN regexp_matches(model, '(^|[^0-9])(150|152|162|172|177|180|182|185|206|207|210|310|336|337|340|402|414|421)([^0-9]|$)')
      WHEN regexp_matches(lower(manufacturername), 'piper') THEN regexp_matches(model, '(?i)(\bJ[ -]?[35]([^0-9]|$)|PA[ -]?(11|12|16|18|20|22|23|24|28|30|32|34|38|44)([^0-9]|$))')
      WHEN regexp_matches(lower(manufacturername), 'cirrus') THEN regexp_matches(model, '(?i)\bSR[ -]?2[02]')
      WHEN regexp_matches(lower(manufacturername), 'diamond|hoac') THEN regexp_matches(model, '(?i)(\bDA[ -]?(20|40|42|62)([^0-9]|$)|\bDV[ -]?2[02]\b|\bHK[ -]?36([^0-9]|$)|\bKatana\b|\bTwin[ -]?Star\b|\bDiamond[ -]?Star\b)')
      ELSE false END""",
}

STEPS |= {
    "rough": """SELECT * REPLACE (CASE WHEN event_id % 13 <> 0 THEN onground END AS onground, CASE WHEN event_id % 17 <> 0 THEN geoaltitude END AS geoaltitude,
      CASE WHEN event_id % 31 <> 0 THEN icao24 END AS icao24, CASE WHEN event_id % 43 <> 0 THEN lat END AS lat) FROM pings""",
    "rough_numbered": "SELECT *, lat IS NOT NULL AND lon IS NOT NULL AS p, row_number() OVER (PARTITION BY date, icao24, time, lat IS NOT NULL AND lon IS NOT NULL ORDER BY event_id) AS rn FROM rough",
    "rough_segs": """SELECT event_id, segment_id, time, CASE WHEN event_id % 19 <> 0 THEN lat END AS lat, event_id % 101 = 0 AS endless FROM
      (SELECT event_id, segment_id, time, lat FROM segs UNION ALL SELECT event_id + 2000000000, segment_id, time, lat FROM segs WHERE event_id % 7 = 0)""",
    "rough_usable": "SELECT segment_id, count(*) AS n, bool_or(endless) AS endless FROM (SELECT *, row_number() OVER (PARTITION BY segment_id, time ORDER BY event_id) AS rn FROM rough_segs WHERE lat IS NOT NULL) WHERE rn = 1 GROUP BY segment_id",
    "enu_all": STEPS["enu"].replace("WHERE n >= 3 ", ""),
    "axes_all": STEPS["accel_axes"].replace("FROM enu ", "FROM enu_all "),
    "accel_all": STEPS["accel"].replace("FROM accel_axes", "FROM axes_all"),
    "window_shapes": f"SELECT split, sequence_id, count(*) = {_LENGTH} AND count(DISTINCT step) = {_LENGTH} AND min(step) = 0 AND max(step) = {_LENGTH - 1} AS whole FROM steps GROUP BY split, sequence_id",
    "expected_windows": f"SELECT split, sum((n - {_LENGTH}) // {_STRIDE} + 1) AS n FROM (SELECT split, segment_id, count(*) AS n FROM routed GROUP BY ALL) WHERE n >= {_LENGTH} GROUP BY split",
}


def _sql(select: str) -> str:
    """``select`` with the steps that it rests on, in order."""
    import re

    needed: set[str] = set()
    todo = [select]
    while todo:
        text = todo.pop()
        for name in STEPS:
            if name not in needed and re.search(rf"\b(FROM|JOIN)\s+{name}\b", text):
                needed.add(name)
                todo.append(STEPS[name])
    # a step may only follow those it names
    ordered: list[str] = []

    def place(name: str) -> None:
        if name in ordered:
            return
        for other in STEPS:
            if other != name and re.search(rf"\b(FROM|JOIN)\s+{other}\b", STEPS[name]):
                place(other)
        ordered.append(name)

    for name in STEPS:
        if name in needed:
            place(name)
    return ("WITH " + ",\n".join(f"{n} AS ({STEPS[n]})" for n in ordered) + "\n" if ordered else "") + select


def _cols(*names: str) -> str:
    return ", ".join(_r(n, PLACES[n]) if n in PLACES else n for n in names)


def _split_stats(sampled: bool) -> str:
    rows = "(SELECT *, row_number() OVER (PARTITION BY split ORDER BY segment_id, time) - 1 AS pos FROM routed)" if sampled else "(SELECT *, 0 AS pos FROM routed)"
    metric = lambda c: ", ".join(_r(f"{fn} FILTER (pos % 10 = 0)", 4, f"{n}_{c}") for n, fn in (("mean", f"avg({c})"), ("p95", f"quantile_cont({c}, 0.95)"), ("max", f"max({c})")))
    return f"""SELECT a.split, n_rows, n_segments, {_r('100 * n_rows / sum(n_rows) OVER ()', 2, 'pct_rows')}, {_r('100 * n_segments / sum(n_segments) OVER ()', 2, 'pct_segments')},
      a.* EXCLUDE (split, n_rows), {_r('mean_d', 1, 'mean_duration_s')}, {_r('p95_d', 1, 'p95_duration_s')}
      FROM (SELECT split, count(*) AS n_rows, {metric('speed_mps')}, {metric('accel_mps2')} FROM {rows} GROUP BY split) a
      JOIN (SELECT split, count(*) AS n_segments, avg(d) AS mean_d, quantile_cont(d, 0.95) AS p95_d FROM (SELECT split, segment_id, max(time) - min(time) AS d FROM routed GROUP BY ALL) GROUP BY split) b ON a.split = b.split"""


def oracle_sql() -> dict[str, str]:
    minutes = lambda f: f"printf('%.1f min', {f}(duration_seconds / 60.0))"
    summary_cols = ["max_abs_E_m", "max_abs_N_m", "max_abs_U_m", "mean_speed_mps", "max_speed_mps"]
    bad = " OR ".join(f"{f} IS NULL OR isnan({f})" for f in S.features)
    endless = " OR ".join(f"isinf({f})" for f in S.features)
    metric_cols = [f"{n}_{c}" for c in ("speed_mps", "accel_mps2") for n in ("mean", "p95", "max")]
    texts = {
        "registry_brand_filter": "SELECT * FROM branded",
        "registry_model_filter": "SELECT * FROM kept_aircraft",
        "registry_size": "SELECT (SELECT count(*) FROM aircraft) AS registry, (SELECT count(*) FROM kept_aircraft) AS kept",
        "states_semi_registry": "SELECT event_id, icao24, time, date FROM pings WHERE icao24 IN (SELECT icao24 FROM kept_aircraft)",
        "haversine": f"SELECT event_id, {_r(_hav('lat', 'lon', '50.0', '-1.0'), 4, 'dist_m')} FROM pings WHERE lat IS NOT NULL",
        "geodetic_enu": f"""SELECT event_id, {_r('x', 3, 'x_m')}, {_r('y', 3, 'y_m')}, {_r('z', 3, 'z_m')}, {_r('E_m', 4)}, {_r('N_m', 4)}, {_r('U_m', 4)} FROM
          (SELECT *, {_enu_sql('50.0', '-1.0')} FROM (SELECT event_id, {_ecef('lat', 'lon', 'geoaltitude')}, {_ecef('50.0', '-1.0', '100.0').replace(' AS x', ' AS x0').replace(' AS y', ' AS y0').replace(' AS z', ' AS z0')} FROM pings WHERE lat IS NOT NULL AND geoaltitude IS NOT NULL))""",
        "quality_filtered": f"SELECT {_cols('event_id', 'icao24', 'time', 'lat', 'lon', 'altitude', 'callsign', 'date')} FROM cleaned",
        "quality_drop_counts": f"""SELECT date, count(*) AS raw, count_if(s = 0)::BIGINT AS lat_lon, count_if(s = 1)::BIGINT AS duplicates, count_if(s = 2)::BIGINT AS onground, count_if(s = 3)::BIGINT AS alt_missing, count_if(s = 4)::BIGINT AS alt_range, count_if(s = 5)::BIGINT AS after_filter FROM
          (SELECT date, CASE WHEN NOT p THEN 0 WHEN rn > 1 THEN 1 WHEN onground THEN 2 WHEN geoaltitude IS NULL THEN 3 WHEN geoaltitude NOT BETWEEN {T.min_alt_m} AND {T.max_alt_m} THEN 4 ELSE 5 END AS s FROM
          (SELECT *, lat IS NOT NULL AND lon IS NOT NULL AS p, row_number() OVER (PARTITION BY date, icao24, time, lat IS NOT NULL AND lon IS NOT NULL ORDER BY event_id) AS rn FROM pings)) GROUP BY date""",
        "dedupe_first": "SELECT event_id, icao24, time, date FROM numbered WHERE rn = 1",
        "ping_deltas": f"SELECT {_cols('event_id', 'dt_s', 'dist_m', 'implied_mps')} FROM flagged",
        "cut_flags": "SELECT event_id, time_cut, speed_cut FROM flagged",
        "segment_islands": "SELECT event_id, icao24, date, island, duration_s FROM timed",
        "split_counters": f"SELECT date, sum(time_cut::INT)::BIGINT AS time_splits, sum(speed_cut::INT)::BIGINT AS speed_splits, count_if(duration_s < {T.min_duration_s})::BIGINT AS pings_discarded FROM timed GROUP BY date",
        "segment_rows": "SELECT event_id, segment_id, icao24, time, callsign, date FROM segs",
        "segment_summary": "SELECT * FROM summary",
        "run_kpis": f"""SELECT 'Aircraft in registry' AS "Metric", (SELECT count(*) FROM kept_aircraft)::VARCHAR AS "Value" UNION ALL SELECT 'Aircraft observed', (SELECT count(DISTINCT icao24) FROM cleaned)::VARCHAR
          UNION ALL SELECT 'Trajectory segments', (SELECT count(*) FROM summary)::VARCHAR UNION ALL SELECT 'Pings in segments', (SELECT sum(n_points) FROM summary)::BIGINT::VARCHAR
          UNION ALL SELECT 'Mean segment duration', (SELECT {minutes('avg')} FROM summary) UNION ALL SELECT 'Median segment duration', (SELECT {minutes('median')} FROM summary) UNION ALL SELECT 'Max segment duration', (SELECT {minutes('max')} FROM summary)""",
        "enu_coordinates": f"SELECT {_cols('event_id', 'segment_id', 'E_m', 'N_m', 'U_m')} FROM enu",
        "enu_velocity": f"SELECT {_cols('event_id', 'segment_id', 'vE_mps', 'vN_mps', 'vU_mps')} FROM enu",
        "enu_summary": f"""SELECT {_cols('segment_id', 'n_points', 'start_time', 'end_time', 'duration_s', *summary_cols)} FROM (SELECT segment_id, count(*) AS n_points, min(time) AS start_time, max(time) AS end_time, max(time) - min(time) AS duration_s,
          max(abs(E_m)) AS max_abs_E_m, max(abs(N_m)) AS max_abs_N_m, max(abs(U_m)) AS max_abs_U_m, avg(sqrt(vE_mps * vE_mps + vN_mps * vN_mps + vU_mps * vU_mps)) AS mean_speed_mps, max(sqrt(vE_mps * vE_mps + vN_mps * vN_mps + vU_mps * vU_mps)) AS max_speed_mps FROM enu GROUP BY segment_id)""",
        "enu_skip_reasons": "SELECT 'too_few_points (' || n || ')' AS skip_reason, count(DISTINCT segment_id) AS segments FROM placed WHERE n < 3 GROUP BY n",
        "origin_audit": f"SELECT {_r('max(greatest(abs(E_m), abs(N_m), abs(U_m)))', 4, 'max_origin_m')}, (SELECT {' + '.join(f'count_if({c} IS NULL OR isnan({c}))' for c in ENU_COLUMNS)} FROM enu)::BIGINT AS nulls FROM (SELECT *, row_number() OVER (PARTITION BY segment_id ORDER BY time) AS rn FROM enu) WHERE rn = 1",
        "kinematics_accel": f"SELECT {_cols('event_id', 'segment_id', 'speed_mps', 'aE_mps2', 'aN_mps2', 'aU_mps2', 'accel_mps2')} FROM accel",
        "cleaning_summary": f"SELECT {_cols('segment_id', 'n_points', 'start_time', 'end_time', 'duration_s', *metric_cols, 'drop_reason')} FROM cleaning",
        "drop_reason_histogram": "SELECT drop_reason, count(*) AS segments FROM cleaning GROUP BY drop_reason",
        "clean_rows": f"SELECT {_cols('event_id', 'segment_id', 'time', *ENU_COLUMNS, 'speed_mps', 'accel_mps2')} FROM clean",
        "dropped_segments": "SELECT segment_id, n_points, drop_reason FROM cleaning WHERE drop_reason <> 'keep'",
        "split_assignment": "SELECT segment_id, split FROM assigned",
        "split_rows": "SELECT event_id, segment_id, split FROM routed",
        "split_summary": _split_stats(False),
        "split_summary_sampled": _split_stats(True),
        "split_overlap_check": "SELECT count(*) AS overlap, count(*) = 0 AS ok FROM (SELECT segment_id FROM assigned WHERE split = 'train' INTERSECT SELECT segment_id FROM assigned WHERE split = 'test')",
        "norm_stats": " UNION ALL ".join(f"SELECT '{f}' AS feature, {_r(f'm_{f}', 6, 'mean')}, {_r(f's_{f}', 6, 'std')} FROM scale" for f in S.features),
        "sequence_windows": f"SELECT split, sequence_id, step, {', '.join(_r(f, 6) for f in S.features)} FROM steps",
        "sequence_metadata": f"""SELECT sequence_id, s.split, s.segment_id, start_time, e.time AS end_time, start AS start_row_index_within_segment, start + {_LENGTH - 1} AS end_row_index_within_segment,
          {_LENGTH}::BIGINT AS sequence_length, {_STRIDE}::BIGINT AS stride, s.n AS num_points_in_segment FROM starts s JOIN points e ON e.segment_id = s.segment_id AND e.i = s.start + {_LENGTH - 1}""",
        "sequence_dataset_summary": f"""SELECT t.split, coalesce(q.n, 0) AS sequences_created, count_if(c.n >= {_LENGTH})::BIGINT AS segments_used, count_if(c.n < {_LENGTH})::BIGINT AS segments_skipped, {_LENGTH}::BIGINT AS sequence_length, {_STRIDE}::BIGINT AS stride,
          {len(S.features)}::BIGINT AS num_features, '{'|'.join(S.features)}' AS feature_names FROM (VALUES ('train'), ('test')) t(split) LEFT JOIN (SELECT split, segment_id, count(*) AS n FROM routed GROUP BY ALL) c ON c.split = t.split
          LEFT JOIN (SELECT split, count(*) AS n FROM starts GROUP BY split) q ON q.split = t.split GROUP BY t.split, q.n""",
        "normalised_moments": " UNION ALL ".join(f"SELECT '{f}' AS feature, {_r(f'avg({f})', 6, 'norm_mean')}, {_r(f'stddev_pop({f})', 6, 'norm_std')} FROM steps WHERE split = 'train'" for f in S.features),
        "sanity_checks": f"""SELECT unnest(['train windows have rank 3', 'test windows have rank 3', 'window shape is ({_LENGTH}, {len(S.features)})', 'no NaN in train', 'no NaN in test', 'no infinity in train', 'no segment in both splits',
          'metadata rows equal sequences (train)', 'metadata rows equal sequences (test)']) AS "check", unnest([tr, te, tr AND te, nan_tr = 0, nan_te = 0, inf_tr = 0, shared = 0, got_tr = want_tr, got_te = want_te]) AS passed FROM
          (SELECT (SELECT coalesce(bool_and(whole), true) FROM window_shapes WHERE split = 'train') AS tr, (SELECT coalesce(bool_and(whole), true) FROM window_shapes WHERE split = 'test') AS te,
          (SELECT count_if({bad}) FROM steps WHERE split = 'train') AS nan_tr, (SELECT count_if({bad}) FROM steps WHERE split = 'test') AS nan_te, (SELECT count_if({endless}) FROM steps WHERE split = 'train') AS inf_tr,
          (SELECT count(*) FROM (SELECT segment_id FROM starts GROUP BY segment_id HAVING count(DISTINCT split) > 1)) AS shared,
          (SELECT count(*) FROM starts WHERE split = 'train') AS got_tr, (SELECT count(*) FROM starts WHERE split = 'test') AS got_te,
          (SELECT coalesce(max(n), 0) FROM expected_windows WHERE split = 'train') AS want_tr, (SELECT coalesce(max(n), 0) FROM expected_windows WHERE split = 'test') AS want_te)""",
        "rough_drop_counts": f"""SELECT date, count(*) AS raw, count_if(s = 0)::BIGINT AS lat_lon, count_if(s = 1)::BIGINT AS duplicates, count_if(s = 2)::BIGINT AS onground, count_if(s = 3)::BIGINT AS alt_missing, count_if(s = 4)::BIGINT AS alt_range, count_if(s = 5)::BIGINT AS after_filter FROM
          (SELECT date, CASE WHEN NOT p THEN 0 WHEN rn > 1 THEN 1 WHEN coalesce(onground, true) THEN 2 WHEN geoaltitude IS NULL THEN 3 WHEN geoaltitude NOT BETWEEN {T.min_alt_m} AND {T.max_alt_m} THEN 4 ELSE 5 END AS s FROM rough_numbered) GROUP BY date""",
        "rough_filtered": f"SELECT event_id, icao24, time, {_r('lat', 6)}, {_r('geoaltitude', 6, 'altitude')}, date FROM rough_numbered WHERE p AND rn = 1 AND NOT onground AND geoaltitude BETWEEN {T.min_alt_m} AND {T.max_alt_m}",
        "rough_skip_reasons": "SELECT CASE WHEN n < 3 THEN 'too_few_points (' || n || ')' ELSE 'nan_in_output' END AS skip_reason, count(*) AS segments FROM rough_usable WHERE n < 3 OR endless GROUP BY 1",
        "short_segment_summary": f"""SELECT segment_id, n_points, duration_s, {_r('max_speed_mps', 6)}, {_r('max_accel_mps2', 8)}, CASE WHEN n_points < 3 THEN 'too_few_points' WHEN max_speed_mps > {C.max_speed_mps} AND max_accel_mps2 > {C.max_accel_mps2} THEN 'speed_and_accel_outlier'
          WHEN max_speed_mps > {C.max_speed_mps} THEN 'speed_outlier' WHEN max_accel_mps2 > {C.max_accel_mps2} THEN 'accel_outlier' ELSE 'keep' END AS drop_reason FROM
          (SELECT segment_id, count(*) AS n_points, max(time) - min(time) AS duration_s, CASE WHEN count(*) >= 3 THEN max(speed_mps) END AS max_speed_mps, CASE WHEN count(*) >= 3 THEN max(accel_mps2) END AS max_accel_mps2 FROM accel_all GROUP BY segment_id)""",
        "state_files": "SELECT time, icao24, lat, lon, geoaltitude, onground, trim(callsign) AS callsign, date, 'states_' || date || '-0' || (event_id % 2) || '.csv' AS source_file FROM pings",
        "registry_file": "SELECT icao24, manufacturername, model FROM aircraft",
        "split_sink": "SELECT event_id, segment_id, split FROM routed",
        "date_sink": f"SELECT event_id, date FROM cleaned WHERE date = '{FIXTURE.dates[0]}' OR event_id % 2 = 0",
        "tensor_sink": f"SELECT sequence_id, step, {', '.join(_r(f, 6) for f in S.features)} FROM steps WHERE split = 'train'",
        "cleaning_counters": "SELECT (SELECT count(*) FROM enu) AS rows_in, (SELECT count(*) FROM clean) AS rows_out, (SELECT count(*) FROM cleaning) AS segments_in, (SELECT count(*) FROM cleaning WHERE drop_reason = 'keep') AS segments_kept",
        "incomplete_rows": "SELECT count(*) AS rows, count_if(event_id % 23 = 0 OR event_id % 29 = 0)::BIGINT AS dropped, count_if(event_id % 23 <> 0 AND event_id % 29 <> 0)::BIGINT AS complete FROM clean",
    }
    return {name: _sql(text) for name, text in texts.items()}
