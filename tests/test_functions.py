"""Scalar functions, registry rules, derivatives and windows on small inputs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from skytrace import config
from skytrace.functions.geodesy import ecef, enu, haversine_m
from skytrace.functions.numeric import one_decimal, round_even
from skytrace.operators import kinematics, numbering, partitioning, windows
from skytrace.operators.registry import filter_registry
from skytrace.schemas import require


def test_haversine_zero(spark):
    p = [F.lit(51.5), F.lit(-0.1)]
    assert spark.range(1).select(haversine_m(*p, *p)).first()[0] == 0.0


def test_enu_origin(spark):
    p = (F.lit(51.5), F.lit(-0.1), F.lit(100.0))
    e, n, u = spark.range(1).select(*enu(ecef(*p), ecef(*p), p[0], p[1])).first()
    assert max(abs(e), abs(n), abs(u)) < 1e-3


def test_enu_directions(spark):
    o = (F.lit(10.0), F.lit(20.0), F.lit(0.0))
    for p, want in (((10.0, 20.001, 0.0), 0), ((10.001, 20.0, 0.0), 1), ((10.0, 20.0, 50.0), 2)):
        v = spark.range(1).select(*enu(ecef(*map(F.lit, p)), ecef(*o), o[0], o[1])).first()
        assert int(np.argmax(np.abs(list(v)))) == want and v[want] > 0


def test_registry_rules(spark):
    rows = [
        ("CESSNA", "172", True), ("CESSNA", "CitationX", False), ("BOEING", "737", False), ("Cessna", "1720", False), ("Reims", "F172N", True), ("Fuji Cessna", "T210L", True), (None, "172", False), ("CESSNA", None, False),
        ("PIPER", "PA-28-181", True), ("Piper", "PA 46", False), ("Piper", "J-3", True), ("Piper", "AJ3", False), ("Piper", "pa28", True), ("CIRRUS", "SR220", True), ("Cirrus", "SF50", False), ("Diamond", "DA 40", True),
        ("HOAC", "HK-36", True), ("Diamond", "Twin-Star", True), ("Diamond", "DA400", False), ("Cessna Piper", "PA-28", False), ("Socata", "172", False),
    ]
    df = spark.createDataFrame([(str(i), m, x) for i, (m, x, _) in enumerate(rows)], "icao24 string, manufacturername string, model string")
    assert {int(r.icao24) for r in filter_registry(df).collect()} == {i for i, r in enumerate(rows) if r[2]}


def test_gradient_matches_numpy(spark):
    rng = np.random.default_rng(1)
    t = np.cumsum(rng.integers(1, 9, 40)).tolist()
    y = rng.normal(size=40).tolist()
    df = spark.createDataFrame([(0, int(a), b, i) for i, (a, b) in enumerate(zip(t, y))], "segment_id bigint, time bigint, y double, event_id bigint")
    got = [r.d for r in kinematics.gradient(df, {"d": "y"}, ["segment_id"], "event_id").orderBy("time").collect()]
    assert got == pytest.approx(np.gradient(np.array(y), np.array(t, float)), abs=1e-12)


def test_short_and_broken_segments_are_skipped(spark):
    rows = [(0, t, 50.0, 0.0, 100.0, "d", "a") for t in (0, 10)] + [(1, t, 50.0 + t / 1e4, 0.0, 100.0, "d", "a") for t in (0, 10, 10, 20)] + [(2, 5, None, 0.0, 1.0, "d", "a")]
    df = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "segment_id bigint, time bigint, lat double, lon double, altitude double, date string, icao24 string, event_id bigint")
    marked = kinematics.with_enu(df)
    assert {(r.skip_reason, r.segments) for r in kinematics.skip_report(marked).collect()} == {("too_few_points (2)", 1)}
    assert [r.time for r in kinematics.valid_enu(df).orderBy("time").collect()] == [0, 10, 20]


def test_windows(spark):
    rng = np.random.default_rng(0)
    p = config.Sequences()
    rows = [(0, i, "train", *rng.normal(size=4).tolist()) for i in range(50)] + [(1, i, "train", 0.0, 0.0, 0.0, 0.0) for i in range(29)]
    df = spark.createDataFrame(rows, "segment_id bigint, time bigint, split string, E_m double, N_m double, vE_mps double, vN_mps double")
    stats = windows.normalisation(df.where("segment_id = 0"), p)
    cut = windows.windows(windows.validated(df, p), stats, p).orderBy("sequence_id").collect()
    x = np.array([r.steps for r in cut])
    assert x.shape == (5, 30, 4) and not np.isnan(x).any()
    feats = np.array([r[3:] for r in rows[:50]])
    z = (feats - feats.mean(axis=0)) / feats.std(axis=0, ddof=1)
    assert x == pytest.approx(np.stack([z[s : s + 30] for s in range(0, 21, 5)]))
    assert [(r.start_time, r.end_time, r.sequence_id) for r in cut] == [(s, s + 29, i) for i, s in enumerate(range(0, 21, 5))]
    summary = {r.split: r for r in windows.dataset_summary(df, p).collect()}
    assert (summary["train"].sequences_created, summary["train"].segments_used, summary["train"].segments_skipped) == (5, 1, 1) and summary["test"].sequences_created == 0


def test_empty_windows_keep_their_schema(spark):
    p = config.Sequences()
    df = spark.createDataFrame([], "segment_id bigint, time bigint, split string, E_m double, N_m double, vE_mps double, vN_mps double")
    cut = windows.windows(df, windows.normalisation(df, p), p)
    assert cut.count() == 0 and cut.schema["steps"].dataType.simpleString() == "array<array<double>>"


def test_required_columns():
    with pytest.raises(ValueError):
        require(["a"], ["a", "b"], "x")


def test_running_offset_over_blocks(spark):
    df = spark.createDataFrame([(s, i * 3, i % 5) for s in "ab" for i in range(40)], "split string, segment_id bigint, v bigint")
    rows = numbering.running_offset(df, "v", "segment_id", ["split"], "o", block=7).collect()
    assert all(r.o == sum(i % 5 for i in range(r.segment_id // 3)) for r in rows) and len(rows) == 80


def test_split_is_a_seeded_prefix(spark):
    import hashlib

    df = spark.range(200).withColumnRenamed("id", "segment_id")
    p = config.Split()
    got = {r.segment_id for r in partitioning.assign(df, p).where("split = 'train'").collect()}
    order = sorted(range(200), key=lambda i: (hashlib.md5(f"{p.seed}:{i}".encode()).hexdigest(), i))
    assert got == set(order[:180])
    ids = np.arange(200, dtype=np.int64)
    np.random.default_rng(p.seed).shuffle(ids)
    assert {r.segment_id for r in partitioning.assign_by_shuffle(df, p).where("split = 'train'").collect()} == set(ids[:180].tolist())
    assert partitioning.overlap(partitioning.assign(df, p)).first().ok


def test_percentiles_are_exact(spark):
    from skytrace.operators.quantiles import percentiles

    rng = np.random.default_rng(3)
    rows = [("a", float(x), 1.0) for x in rng.normal(size=5000) ** 3] + [("b", float(x), None) for x in rng.integers(0, 4, 3000)] + [("c", None, None)]
    df = spark.createDataFrame(rows, "split string, x double, y double")
    for share in (0.0, 0.5, 0.95, 1.0):
        got = percentiles(df, "split", ["x", "y"], share, few=20, bins=16)
        for g in "ab":
            assert got[g, "x"] == pytest.approx(np.quantile([x for s, x, _ in rows if s == g], share), rel=1e-12)
        assert got["a", "y"] == 1.0 and got["b", "y"] is None and got["c", "x"] is None


def test_rounding(spark):
    values = [0.25, 0.35, 22861.55, 2.05, 1e6 / 60, 0.0, 5.95, 1371693 / 60]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    assert [r[0] for r in df.select(one_decimal(F.col("x"))).collect()] == [f"{v:.1f}" for v in values]
    assert [r[0] for r in df.select(round_even(F.col("x"), 2)).collect()] == np.round(values, 2).tolist()


def test_config(tmp_path):
    path = tmp_path / "c.yaml"
    path.write_text("dates: ['2024-01-01']\ntrajectory: {max_time_gap_s: 30}\nsequences: {features: [E_m], stride: 2}\n")
    c = config.load(str(path))
    assert c.dates == ("2024-01-01",) and c.trajectory.max_time_gap_s == 30 and c.trajectory.max_implied_mps == pytest.approx(128.611) and c.sequences.features == ("E_m",)
    with pytest.raises(ValueError):
        config.from_dict({"trajectory": {"nonsense": 1}})
