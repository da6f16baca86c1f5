"""Normalised fixed-length windows over each segment, with provenance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skytrace.config import Sequences
from skytrace.operators.numbering import running_offset
from skytrace.schemas import require


def validated(rows: DataFrame, p: Sequences, what: str = "sequences") -> DataFrame:
    """Required columns only, complete rows only."""
    required = _required(p)
    require(rows.columns, required, what)
    keep = [*required, *(["split"] if "split" in rows.columns else [])]
    return rows.select(*keep).na.drop(subset=required)


def _required(p: Sequences) -> list[str]:
    return ["segment_id", "time", *p.features]


def incomplete(p: Sequences) -> Column:
    """Number of rows that ``validated`` drops, as a count to observe."""
    missing = F.lit(False)
    for c in _required(p):
        missing = missing | F.col(c).isNull() | F.coalesce(F.isnan(F.col(c).cast("double")), F.lit(False))
    return F.count_if(missing)


def normalisation(train: DataFrame, p: Sequences) -> DataFrame:
    """(feature, mean, std): sample deviation over all train rows; zero counts as one."""
    stats = train.agg(*(F.avg(f).alias(f"mean_{i}") for i, f in enumerate(p.features)), *(F.stddev_samp(f).alias(f"std_{i}") for i, f in enumerate(p.features)))
    entries = F.array(*(F.struct(F.lit(f).alias("feature"), F.col(f"mean_{i}").alias("mean"), F.when(F.col(f"std_{i}") == 0, 1.0).otherwise(F.col(f"std_{i}")).alias("std")) for i, f in enumerate(p.features)))
    return stats.select(F.inline(entries))


def _one_row(stats: DataFrame, p: Sequences) -> DataFrame:
    picks = [F.max(F.when(F.col("feature") == f, F.col(c))).alias(f"{c}_{i}") for i, f in enumerate(p.features) for c in ("mean", "std")]
    return stats.agg(*picks).withColumn("one_", F.lit(1))


def segment_arrays(rows: DataFrame) -> DataFrame:
    """(split, segment_id, n): lengths of segments."""
    return rows.groupBy("split", "segment_id").agg(F.count("*").alias("n"))


def windows(rows: DataFrame, stats: DataFrame, p: Sequences) -> DataFrame:
    """One row a window: ids, provenance, and ``steps``, the window's rows of normalised features.

    A segment is one sorted array, cut by slices; a window starts every
    ``stride`` rows as long as it is full.  ``sequence_id`` is dense from 0 in each
    split by (segment, start).
    """
    length, stride = p.sequence_length, p.stride
    scaled = rows.withColumn("one_", F.lit(1)).join(F.broadcast(_one_row(stats, p)), "one_")  # one row
    values = F.array(*((F.col(f) - F.col(f"mean_{i}")) / F.col(f"std_{i}") for i, f in enumerate(p.features)))
    points = scaled.select("split", "segment_id", F.struct(F.col("time"), values.alias("v")).alias("point"))
    arrays = points.groupBy("split", "segment_id").agg(F.sort_array(F.collect_list("point")).alias("points")).withColumn("n", F.size("points").cast("long")).where(F.col("n") >= length)
    counts = segment_arrays(rows).where(F.col("n") >= length).select("split", "segment_id", (F.floor((F.col("n") - length) / stride) + 1).alias("windows"))
    offsets = running_offset(counts, "windows", "segment_id", ["split"], "offset").select("split", "segment_id", "offset")
    cut = arrays.join(offsets, ["split", "segment_id"]).select("*", F.posexplode(F.sequence(F.lit(0), (F.col("n") - length).cast("int"), F.lit(stride))).alias("k", "start"))
    part = F.slice("points", F.col("start") + 1, length)
    return cut.withColumn("part", part).select(
        (F.col("offset") + F.col("k")).cast("long").alias("sequence_id"),
        "split",
        "segment_id",
        F.element_at("part", 1)["time"].alias("start_time"),
        F.element_at("part", -1)["time"].alias("end_time"),
        F.col("start").cast("long").alias("start_row_index_within_segment"),
        (F.col("start") + length - 1).cast("long").alias("end_row_index_within_segment"),
        F.lit(length).cast("long").alias("sequence_length"),
        F.lit(stride).cast("long").alias("stride"),
        F.col("n").alias("num_points_in_segment"),
        F.transform("part", lambda x: x["v"]).alias("steps"),
    )


def metadata(cut: DataFrame) -> DataFrame:
    return cut.drop("steps")


def flat(cut: DataFrame, p: Sequences) -> DataFrame:
    """One row a step of a window, features as columns."""
    steps = cut.select("split", "sequence_id", F.posexplode("steps").alias("step", "v"))
    return steps.select("split", "sequence_id", F.col("step").cast("long").alias("step"), *(F.col("v")[i].alias(f) for i, f in enumerate(p.features)))


def dataset_summary(rows: DataFrame, p: Sequences) -> DataFrame:
    """Sequences, segments used and skipped by split; both splits always have a row."""
    length, stride = p.sequence_length, p.stride
    long = F.col("n") >= length
    by_split = segment_arrays(rows).groupBy("split").agg(
        F.sum(F.when(long, F.floor((F.col("n") - length) / stride) + 1).otherwise(0)).alias("sequences_created"), F.count_if(long).alias("segments_used"), F.count_if(~long).alias("segments_skipped")
    )
    both = rows.sparkSession.createDataFrame([("train",), ("test",)], "split string")
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("sequences_created", "segments_used", "segments_skipped")]
    return both.join(by_split, "split", "left").select(
        "split", *counts, F.lit(length).cast("long").alias("sequence_length"), F.lit(stride).cast("long").alias("stride"), F.lit(len(p.features)).cast("long").alias("num_features"), F.lit("|".join(p.features)).alias("feature_names")
    )


def normalised_moments(cut: DataFrame, p: Sequences, split: str = "train") -> DataFrame:
    """Mean and population deviation of each feature over all windows; overlaps weigh inner rows more, so not 0 and 1."""
    steps = flat(cut.where(F.col("split") == split), p)
    stats = steps.agg(*(F.avg(f).alias(f"m_{i}") for i, f in enumerate(p.features)), *(F.stddev_pop(f).alias(f"s_{i}") for i, f in enumerate(p.features)))
    return stats.select(F.inline(F.array(*(F.struct(F.lit(f).alias("feature"), F.col(f"m_{i}").alias("norm_mean"), F.col(f"s_{i}").alias("norm_std")) for i, f in enumerate(p.features)))))


def sanity_checks(cut: DataFrame, rows: DataFrame, p: Sequences) -> DataFrame:
    """(check, passed) over windows and what they were cut from."""
    length, width = p.sequence_length, len(p.features)
    values = F.flatten("steps")
    shaped = (F.size("steps") == length) & F.forall("steps", lambda s: F.size(s) == width)
    nan = F.exists(values, lambda x: x.isNull() | F.isnan(x))
    infinite = F.exists(values, lambda x: F.abs(x) == float("inf"))
    is_train, is_test = F.col("split") == "train", F.col("split") == "test"
    a = cut.agg(
        F.coalesce(F.bool_and(F.when(is_train, shaped)), F.lit(True)).alias("train_shape"),
        F.coalesce(F.bool_and(F.when(is_test, shaped)), F.lit(True)).alias("test_shape"),
        F.count_if(is_train & nan).alias("train_nan"),
        F.count_if(is_test & nan).alias("test_nan"),
        F.count_if(is_train & infinite).alias("train_inf"),
        F.count_if(is_train).alias("train_rows"),
        F.count_if(is_test).alias("test_rows"),
    ).withColumn("one_", F.lit(1))
    summary = dataset_summary(rows, p)
    b = summary.agg(F.max(F.when(is_train, F.col("sequences_created"))).alias("train_expected"), F.max(F.when(is_test, F.col("sequences_created"))).alias("test_expected")).withColumn("one_", F.lit(1))
    shared = segment_arrays(rows).where(F.col("n") >= length).groupBy("segment_id").agg(F.count_distinct("split").alias("k")).agg(F.count_if(F.col("k") > 1).alias("shared")).withColumn("one_", F.lit(1))
    all_ = a.join(b, "one_").join(shared, "one_")
    checks = [
        ("train windows have rank 3", F.col("train_shape")),
        ("test windows have rank 3", F.col("test_shape")),
        (f"window shape is ({length}, {width})", F.col("train_shape") & F.col("test_shape")),
        ("no NaN in train", F.col("train_nan") == 0),
        ("no NaN in test", F.col("test_nan") == 0),
        ("no infinity in train", F.col("train_inf") == 0),
        ("no segment in both splits", F.col("shared") == 0),
        ("metadata rows equal sequences (train)", F.col("train_rows") == F.col("train_expected")),
        ("metadata rows equal sequences (test)", F.col("test_rows") == F.col("test_expected")),
    ]
    return all_.select(F.inline(F.array(*(F.struct(F.lit(n).alias("check"), c.alias("passed")) for n, c in checks))))
