"""The eight stages as DataFrame functions, and a runner that writes their results.

Stages compose lazily: called one after the other they are one plan.  The runner
writes each stage's result, so that a run can be resumed from any of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skytrace.config import Config
from skytrace.operators import islands, kinematics, outliers, partitioning, quality, stats, windows
from skytrace.operators import registry as reg
from skytrace.plans.boundary import boundary
from skytrace.plans.counters import Counters
from skytrace.schemas import ACCEL_COLUMNS, require
from skytrace.sources import sinks, states


def registered_states(pings: DataFrame, registry: DataFrame) -> DataFrame:
    """Stages 01 to 03: states of aircraft that the registry filter keeps."""
    return reg.keep_registered(pings, reg.filter_registry(registry))


def trajectory_segments(pings: DataFrame, cfg: Config) -> DataFrame:
    """Stage 04."""
    return islands.segments(quality.clean(pings, cfg.trajectory, identified=True), cfg.trajectory, cfg.dates)


def enu_segments(segments: DataFrame) -> DataFrame:
    """Stage 05, with ``skip_reason``; the rows without one are the result."""
    return kinematics.with_enu(segments)


def clean_segments(enu: DataFrame, cfg: Config) -> DataFrame:
    """Stage 06."""
    return outliers.clean_segments(enu, cfg.cleaning)


def split_segments(clean: DataFrame, cfg: Config) -> DataFrame:
    """Stage 07: rows with their split."""
    require(clean.columns, ["segment_id", "time", *ACCEL_COLUMNS], "split")
    clean = boundary(clean)  # read for the ids and for the rows
    return partitioning.route(clean, boundary(partitioning.assign(clean, cfg.split)))


def sequence_windows(routed: DataFrame, cfg: Config) -> DataFrame:
    """Stage 08: normalised windows of both splits, scaled by train statistics."""
    rows = windows.validated(routed, cfg.sequences)  # read for the scale, the arrays and the counts, from stage 07's tables
    return windows.windows(rows, windows.normalisation(rows.where("split = 'train'"), cfg.sequences), cfg.sequences)


def run_ingest(spark: SparkSession, cfg: Config, strict: bool = False) -> dict[str, dict[str, int]]:
    """Stages 01 to 03 from files to Parquet by date; other dates' partitions stay.  Gives the rows of each step."""
    out, seen = cfg.paths.out, Counters()
    raw = seen.watch(states.hourly_states(spark, cfg.paths.archive_dir, cfg.dates, strict), "raw states")
    registry = seen.watch(states.registry(spark, cfg.paths.aircraft_db_raw), "registry")
    sinks.write_parquet(seen.watch(reg.filter_registry(registry), "registry kept"), f"{out}/registry")
    kept = reg.keep_registered(raw, spark.read.parquet(f"{out}/registry"))
    sinks.write_partitions(seen.watch(reg.order_states(kept), "states kept"), f"{out}/states", "date", cfg.dates)
    return seen.told()


def run_pipeline(spark: SparkSession, cfg: Config) -> dict[str, dict[str, int]]:
    """Stages 04 to 06 over the configured dates.  Gives the rows of each step."""
    out, seen = cfg.paths.out, Counters()
    pings = spark.read.parquet(f"{out}/states")
    pings = pings.where(pings["date"].cast("string").isin(list(cfg.dates))).withColumn("date", F.col("date").cast("string"))
    sinks.write_csv(quality.drop_counts(pings, cfg.trajectory), f"{out}/drop_counts", single=True)
    cleaned = quality.clean(pings, cfg.trajectory, identified=True)
    sinks.write_csv(islands.split_counters(cleaned, cfg.trajectory), f"{out}/split_counters", single=True)
    sinks.write_parquet(seen.watch(islands.segments(cleaned, cfg.trajectory, cfg.dates), "segment rows"), f"{out}/segments")
    segments = spark.read.parquet(f"{out}/segments")
    sinks.write_parquet(seen.watch(islands.segment_summary(segments), "segments"), f"{out}/segment_summary")
    kpis = stats.run_kpis(spark.read.parquet(f"{out}/registry"), cleaned, spark.read.parquet(f"{out}/segment_summary"))
    sinks.write_csv(kpis, f"{out}/results", single=True)
    marked = enu_segments(segments)
    sinks.write_csv(kinematics.skip_report(marked), f"{out}/enu_skipped", single=True)
    valid = seen.watch(marked, "located rows", skipped=F.count_if(F.col("skip_reason").isNotNull())).where("skip_reason is null").drop("skip_reason")
    sinks.write_parquet(valid, f"{out}/enu")
    enu = spark.read.parquet(f"{out}/enu")
    sinks.write_parquet(kinematics.enu_summary(enu), f"{out}/enu_summary")
    sinks.write_csv(kinematics.origin_audit(enu), f"{out}/enu_audit", single=True)
    summary = outliers.cleaning_summary(enu, cfg.cleaning)
    sinks.write_parquet(seen.watch(summary, "checked segments", kept=F.count_if(F.col("drop_reason") == "keep")), f"{out}/cleaning_summary")
    sinks.write_parquet(outliers.dropped(spark.read.parquet(f"{out}/cleaning_summary")), f"{out}/dropped_segments")
    sinks.write_parquet(seen.watch(clean_segments(seen.watch(enu, "rows before cleaning"), cfg), "rows after cleaning"), f"{out}/clean")
    return seen.told()


def run_dataset(spark: SparkSession, cfg: Config, tensors: str | None = None, strict: bool = False) -> DataFrame:
    """Stages 07 and 08; returns the check table, and raises on a failed check if ``strict``."""
    out, seen = cfg.paths.out, Counters()
    split = split_segments(spark.read.parquet(f"{out}/clean"), cfg)
    is_train = F.count_if(F.col("split") == "train")
    sinks.write_parquet(seen.watch(split, "split rows", train=is_train, incomplete=windows.incomplete(cfg.sequences)), f"{out}/splits", "split")
    routed = spark.read.parquet(f"{out}/splits")
    sinks.write_csv(partitioning.split_statistics(routed), f"{out}/split_summary", single=True)
    rows = windows.validated(routed, cfg.sequences)
    scale = windows.normalisation(rows.where("split = 'train'"), cfg.sequences)
    sinks.write_csv(scale, f"{out}/normalisation", single=True)
    sinks.write_parquet(seen.watch(windows.windows(rows, scale, cfg.sequences), "sequences", train=is_train), f"{out}/sequences", "split")
    cut = spark.read.parquet(f"{out}/sequences")
    summary = windows.dataset_summary(rows, cfg.sequences)
    sinks.write_csv(summary, f"{out}/sequence_summary", single=True)
    sinks.write_csv(windows.normalised_moments(cut, cfg.sequences), f"{out}/moments", single=True)
    if tensors:
        for row in summary.toLocalIterator():
            part = cut.where(cut["split"] == row["split"])
            sinks.export_tensor(part, f"{tensors}/X_{row['split']}.npy", row["sequences_created"], cfg.sequences.sequence_length, len(cfg.sequences.features))
    checks = windows.sanity_checks(cut, rows, cfg.sequences)
    seen.told()
    if strict and (failed := [r["check"] for r in checks.where("not passed").collect()]):
        raise ValueError(f"failed checks: {failed}")
    return checks
