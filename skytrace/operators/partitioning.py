"""Train and test by segment, so that no segment stands in both."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from skytrace.config import Split
from skytrace.functions.numeric import round_even
from skytrace.operators.numbering import rank_by_digest, running_offset
from skytrace.operators.quantiles import percentiles

METRICS = ["speed_mps", "accel_mps2"]


def assign(rows: DataFrame, p: Split) -> DataFrame:
    """(segment_id, split): the first ``floor(n * train_frac)`` ids in the order of a seeded digest train."""
    ids = rows.select("segment_id").distinct()
    digest = F.md5(F.concat_ws(":", F.lit(str(p.seed)), F.col("segment_id").cast("string")).cast("binary"))
    ranked = rank_by_digest(ids, digest, "segment_id", "rank_")
    total = ids.agg(F.floor(F.count("*") * F.lit(p.train_frac)).alias("cut_"))
    cut = total.withColumn("one_", F.lit(1))
    return ranked.withColumn("one_", F.lit(1)).join(F.broadcast(cut), "one_").select("segment_id", F.when(F.col("rank_") <= F.col("cut_"), "train").otherwise("test").alias("split"))  # one row


def assign_by_shuffle(rows: DataFrame, p: Split) -> DataFrame:
    """The same cut of the order that NumPy's default generator shuffles sorted ids into.

    For comparisons with runs that used it: sorted ids are shuffled on the
    driver, which is only for id lists that fit there.
    """
    import numpy as np

    ids = np.array([r[0] for r in rows.select("segment_id").distinct().orderBy("segment_id").toLocalIterator()], np.int64)
    np.random.default_rng(seed=p.seed).shuffle(ids)
    n = int(len(ids) * p.train_frac)
    return rows.sparkSession.createDataFrame([(int(x), "train" if i < n else "test") for i, x in enumerate(ids)], "segment_id bigint, split string")


def route(rows: DataFrame, assignment: DataFrame) -> DataFrame:
    """Each row with its split, by one join on the segment."""
    return rows.join(assignment, "segment_id")


def split_statistics(routed: DataFrame, sample_every: int = 1) -> DataFrame:
    """Rows, segments, shares, speeds, accelerations and durations by split.

    Exact by default.  ``sample_every`` takes speed and acceleration from each
    so-manieth row of a split only, in the order of segment and time, for
    comparison with runs that did.
    """
    stats = routed
    if sample_every > 1:
        counts = routed.groupBy("split", "segment_id").agg(F.count("*").alias("n"))
        offsets = running_offset(counts, "n", "segment_id", ["split"], "offset_").select("split", "segment_id", "offset_")
        inside = F.row_number().over(Window.partitionBy("split", "segment_id").orderBy("time")) - 1
        stats = routed.withColumn("at_", inside).join(offsets, ["split", "segment_id"])
        stats = stats.withColumns({c: F.when((F.col("offset_") + F.col("at_")) % sample_every == 0, F.col(c)) for c in METRICS})
    rows = stats.groupBy("split").agg(F.count("*").alias("n_rows"), *(f(c).alias(f"{n}_{c}") for c in METRICS for n, f in (("mean", F.avg), ("max", F.max))))
    durations = routed.groupBy("split", "segment_id").agg((F.max("time") - F.min("time")).cast("double").alias("d"))
    by_split = durations.groupBy("split").agg(F.count("*").alias("n_segments"), F.avg("d").alias("mean_duration_s"))
    p95 = percentiles(stats, "split", METRICS, 0.95) | percentiles(durations, "split", ["d"], 0.95)
    names = [*METRICS, "d"]
    exact = routed.sparkSession.createDataFrame([(s, *(p95.get((s, c)) for c in names)) for s in sorted({s for s, _ in p95})], "split string, p95_speed_mps double, p95_accel_mps2 double, p95_duration_s double")
    both = rows.join(by_split, "split").join(exact, "split")
    totals = both.agg(F.sum("n_rows").alias("all_rows"), F.sum("n_segments").alias("all_segments")).withColumn("one_", F.lit(1))
    both = both.withColumn("one_", F.lit(1)).join(F.broadcast(totals), "one_")  # one row
    speeds = [round_even(F.col(f"{n}_{c}"), 4).alias(f"{n}_{c}") for c in METRICS for n in ("mean", "p95", "max")]
    return both.select(
        "split",
        "n_rows",
        "n_segments",
        round_even(100 * F.col("n_rows") / F.col("all_rows"), 2).alias("pct_rows"),
        round_even(100 * F.col("n_segments") / F.col("all_segments"), 2).alias("pct_segments"),
        *speeds,
        *(round_even(F.col(f"{n}_duration_s"), 1).alias(f"{n}_duration_s") for n in ("mean", "p95")),
    )


def overlap(assignment: DataFrame) -> DataFrame:
    """Segments that stand in both splits; none, if all is well."""
    train, test = (assignment.where(F.col("split") == s).select("segment_id") for s in ("train", "test"))
    return train.intersect(test).agg(F.count("*").alias("overlap")).withColumn("ok", F.col("overlap") == 0)
