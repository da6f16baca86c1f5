"""Every query against its SQL twin, and laws that hold over a whole run."""

import csv
import math

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from skytrace import queries
from skytrace.config import Config, Paths
from skytrace.operators import islands, outliers, quality, windows
from skytrace.plans import stages
from skytrace.sources import fixtures, states
from skytrace.sources.fixtures import FIXTURE
from skytrace.streaming.ingest import ingest

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def tidy(x):
    return None if x is None or isinstance(x, float) and math.isnan(x) else x


@pytest.mark.parametrize("name", list(queries.queries()))
def test_twin(spark, sf, duck, name):
    df = queries.queries()[name](spark, sf)
    names = sorted(df.columns)
    twin = duck.execute(queries.oracle_sql()[name])
    order = [d[0] for d in twin.description]
    assert names == sorted(order)
    want = sorted(str([tidy(r[order.index(c)]) for c in names]) for r in twin.fetchall())
    assert sorted(str([tidy(r[c]) for c in names]) for r in df.collect()) == want


def test_entry(spark):
    assert entry.entry(spark).count() == 92
    assert set(queries.queries()) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


def test_laws(spark, sf):
    t = FIXTURE.trajectory
    pings = fixtures.pings(spark, sf)
    drops = quality.drop_counts(pings, t).collect()
    assert all(r.raw == r.lat_lon + r.duplicates + r.onground + r.alt_missing + r.alt_range + r.after_filter for r in drops)
    cleaned = quality.clean(pings, t)
    segments = stages.trajectory_segments(pings, FIXTURE)
    n = segments.count()
    cleaned = cleaned.where("icao24 is not null")
    assert n + sum(r.pings_discarded for r in islands.split_counters(cleaned, t).collect()) == cleaned.count() == sum(r.after_filter for r in drops)
    ids = sorted(r[0] for r in segments.select("segment_id").distinct().collect())
    assert ids == list(range(len(ids)))
    summary = outliers.cleaning_summary(stages.enu_segments(segments).where("skip_reason is null"), FIXTURE.cleaning)
    assert {r.drop_reason: r.segments for r in outliers.reason_histogram(summary).collect()} == {"keep": 81, "accel_outlier": 2, "speed_outlier": 2}


def test_one_shuffle_by_aircraft(spark, sf):
    """Filters, dedupe, cuts and durations share one exchange; the filter on position reaches the scan side of it."""
    df = islands.with_durations(islands.with_cuts(quality.clean(fixtures.pings(spark, sf), FIXTURE.trajectory, identified=True), FIXTURE.trajectory))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Python" not in plan


def test_config_order_of_dates(spark, sf):
    pings = fixtures.pings(spark, sf)
    swapped = islands.segments(quality.clean(pings, FIXTURE.trajectory), FIXTURE.trajectory, FIXTURE.dates[::-1])
    first = swapped.where("segment_id = 0").first()
    assert first.date == FIXTURE.dates[1]


@pytest.fixture(scope="module")
def files(spark, sf, tmp_path_factory):
    """Hourly files and a registry file as a run would find them."""
    root = tmp_path_factory.mktemp("run")
    (root / "archive").mkdir()
    names = [f.name for f in states.STATES]
    rows = fixtures.pings(spark, sf).orderBy("event_id").collect()
    for date in FIXTURE.dates:
        mine = [r for r in rows if r.date == date]
        for part in range(2):
            with open(root / "archive" / f"states_{date}-{part:02d}.csv", "w", newline="") as f:
                w = csv.writer(f)
                w.writerow(names)
                half = len(mine) // 2
                for r in mine[half * part : half if part == 0 else None]:
                    d = r.asDict()
                    w.writerow(["nan" if d.get(n) is None and n in ("lat", "geoaltitude") else "" if d.get(n) is None else d[n] for n in names])
    with open(root / "registry.csv", "w", newline="") as f:
        w = csv.writer(f)
        w.writerow(["icao24", "model", "manufacturername", "owner"])
        for i, r in enumerate(sorted({r.icao24 for r in rows})):
            w.writerow([r, "172", "CESSNA" if i % 3 else "BOEING", "x"])
    return root


def test_run_over_files(spark, files):
    cfg = Config(FIXTURE.dates, FIXTURE.trajectory, FIXTURE.cleaning, FIXTURE.split, FIXTURE.sequences, Paths(str(files / "archive"), str(files / "registry.csv"), str(files / "out")))
    stages.run_ingest(spark, cfg, strict=True)
    stages.run_pipeline(spark, cfg)
    checks = stages.run_dataset(spark, cfg, tensors=str(files), strict=True).collect()
    assert len(checks) == 9 and all(r.passed for r in checks)
    out = cfg.paths.out
    registry = {r.icao24 for r in spark.read.parquet(f"{out}/registry").collect()}
    kept = spark.read.parquet(f"{out}/states")
    assert {r[0] for r in kept.select("icao24").distinct().collect()} <= registry
    clean, split = spark.read.parquet(f"{out}/clean"), spark.read.parquet(f"{out}/splits")
    assert clean.count() == split.count() > 0
    cut = spark.read.parquet(f"{out}/sequences")
    x = np.load(files / "X_train.npy")
    assert x.shape == (cut.where("split = 'train'").count(), 10, 4)
    row = cut.where("split = 'train' and sequence_id = 1").first()
    assert x[1] == pytest.approx(np.array(row.steps))
    rows = windows.validated(split, cfg.sequences).groupBy("segment_id").count().collect()
    assert cut.count() == sum((r["count"] - 10) // 5 + 1 for r in rows if r["count"] >= 10)


def test_file_order_decides_duplicates(spark, tmp_path):
    head = ",".join(f.name for f in states.STATES)
    line = lambda alt: f"100,abc,1.0,2.0,,,,{alt},False,,,,,500.0,,"
    (tmp_path / "states_2024-01-01-01.csv").write_text(f"{head}\n{line('LATER')}\n")
    (tmp_path / "states_2024-01-01-00.csv").write_text(f"{head}\n{line('FIRST')}\n{line('second')}\n")
    rows = quality.clean(states.hourly_states(spark, str(tmp_path), ("2024-01-01",)), FIXTURE.trajectory).collect()
    assert [r.callsign for r in rows] == ["FIRST"] and rows[0].date == "2024-01-01"


def test_streaming_ingest(spark, files, tmp_path):
    registry = spark.createDataFrame([(r[0],) for r in fixtures.pings(spark, "/root/testdata/sf0.001").select("icao24").distinct().limit(5).collect()], "icao24 string")
    run = lambda: ingest(spark, str(files / "archive"), registry, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    run()
    n = spark.read.parquet(str(tmp_path / "out")).count()
    want = states.hourly_states(spark, str(files / "archive"), FIXTURE.dates).join(registry, "icao24", "left_semi").count()
    run()
    assert n == want == spark.read.parquet(str(tmp_path / "out")).count() > 0


def test_a_second_run_leaves_nothing_of_the_first(spark, files, tmp_path):
    paths = Paths(str(files / "archive"), str(files / "registry.csv"), str(tmp_path / "out"))
    both = Config((*FIXTURE.dates, "2031-01-01"), FIXTURE.trajectory, FIXTURE.cleaning, FIXTURE.split, FIXTURE.sequences, paths)
    counts = stages.run_ingest(spark, both)
    assert counts["raw states"]["rows"] == fixtures.pings(spark, "/root/testdata/sf0.001").count() and counts["registry kept"]["rows"] < counts["registry"]["rows"]
    stages.run_pipeline(spark, both)
    one = Config(FIXTURE.dates[:1], FIXTURE.trajectory, FIXTURE.cleaning, FIXTURE.split, FIXTURE.sequences, paths)
    told = stages.run_pipeline(spark, one)
    read = lambda name: spark.read.parquet(f"{tmp_path}/out/{name}")
    assert {r[0] for r in read("segments").select("date").distinct().collect()} == set(FIXTURE.dates[:1])
    assert {str(r[0]) for r in read("states").select("date").distinct().collect()} == set(FIXTURE.dates)
    assert told["rows after cleaning"]["rows"] == read("clean").count() and told["rows before cleaning"]["rows"] == read("enu").count()
    assert told["checked segments"]["kept"] == read("cleaning_summary").where("drop_reason = 'keep'").count()
    assert states.hourly_states(spark, str(files / "archive"), ("2031-01-01",)).count() == 0


def test_plans_sort_and_window_little(spark, sf):
    plan = queries.segment_summary(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Window ") <= 9


def test_nan_is_missing(spark):
    df = spark.createDataFrame([(float("nan"), 1.0), (2.0, None)], "lat double, lon double")
    assert quality.normalise(df).where(F.col("lat").isNull()).count() == 1
