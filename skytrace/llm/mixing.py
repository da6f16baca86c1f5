"""Mixing sources to target weights by entropy balancing.

Targets: the sources, in code-point order with null last, carry the weights in
turn and share ``budget`` times all words; a target stops at ``cap`` times its
source's size and the excess is shared again by weight (water filling).  Sources
are numbered range by range and shared out by sums, so there may be any number.

Rates: among all rates between 0 and ``cap`` that meet a source's token
constraint, entropy balancing takes those nearest to one copy of each document
in relative entropy.  Its convex dual has one multiplier per source, and the
rates are exponential tilts, ``min(cap, exp(multiplier * size / mean size))``.
Newton steps, each one distributed aggregation over the (source, size) table
and all sources at once, find the multipliers; a bracket keeps them safe.  Not to
converge is an error.

Copies: each source's documents are dealt into buckets by hash and rounded
there from the largest to the smallest, carrying the rest on, so a bucket ends
within about the size of its smallest documents of its share.  Equal rows are
dealt as one with a number, cut into chunks, so they too fill many buckets.
Nothing is drawn at random: reruns agree.

Defined cases: null and empty texts have size 0 and add nothing; a null source
is a source; equal rows share what is taken of them; a table without words
takes nothing; extra columns stay in ``mix``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from skytrace.llm.common import extended, materialise, prepare, quoted

#: Multipliers lie within this of zero.
FAR = 1e12
WORD = r"[^\x20\x09-\x0D]+"


@dataclass(frozen=True)
class MixParams:
    weights: tuple[float, ...] = (3.0, 1.0, 2.0)
    budget: float = 1.5
    cap: int = 2
    tolerance: float = 1e-7
    max_steps: int = 200
    #: Documents of a source in a rounding bucket, on average, and equal rows in a chunk.
    bucket_rows: int = 2_000


def with_size(docs: DataFrame) -> DataFrame:
    return docs.withColumn("size", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long"))


def numbered(sources: DataFrame) -> DataFrame:
    """``sources`` (one row each) plus ``turn``, from 0 in code-point order with null last."""
    ranged = materialise(sources.repartitionByRange(F.col("source").asc_nulls_last()).withColumn("range", F.spark_partition_id()), "mix-sources")
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # one row a range
    offsets = ranged.groupBy("range").agg(F.count("*").alias("n")).select("range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    inside = F.row_number().over(Window.partitionBy("range").orderBy(F.col("source").asc_nulls_last())) - 1
    return ranged.withColumn("inside", inside).join(offsets, "range").withColumn("turn", F.col("before") + F.col("inside")).drop("range", "inside", "before")


def targets(sizes: DataFrame, params: MixParams = MixParams()) -> DataFrame:
    """(source, source_size, docs, target) by water filling.

    All sources that a common level a weight would fill are full; the rest of the
    budget is shared among the others, until that fills no more of them.
    """
    n = len(params.weights)
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in params.weights)), (F.col("turn") % n + 1).cast("int"))
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("docs"))
    rows = materialise(numbered(by_source).withColumn("weight", weight).withColumn("most", F.col("source_size") * F.lit(float(params.cap))), "mix-weights")
    zero = F.lit(0.0)
    total = (rows.agg(F.sum("source_size")).first()[0] or 0) * params.budget
    level, full = 0.0, -1
    while True:
        is_full = F.col("most") <= F.lit(level) * F.col("weight")
        sums = rows.agg(F.coalesce(F.sum(F.when(is_full, F.col("most"))), zero), F.coalesce(F.sum(F.when(~is_full, F.col("weight"))), zero), F.count_if(is_full)).first()
        if sums[2] == full or not sums[1]:
            break
        full, level = sums[2], (total - sums[0]) / sums[1]
    return rows.select("source", "source_size", "docs", F.when(is_full, F.col("most")).otherwise(F.least(F.lit(level) * F.col("weight"), F.col("most"))).alias("target"))


def multipliers(sizes: DataFrame, goals: DataFrame, params: MixParams) -> DataFrame:
    """``goals`` plus ``multiplier`` and ``mean``: Newton on each source's dual, all sources in one job a step."""
    table = materialise(sizes.where("size > 0").groupBy("source", "size").agg(F.count("*").alias("n")), "mix-sizes")
    cap = F.lit(float(params.cap))
    open_ = (F.col("target") > 0) & (F.col("target") < F.col("source_size") * cap * F.lit(1 - 1e-12))
    state = materialise(
        goals.select(
            "source",
            "source_size",
            "docs",
            "target",
            open_.alias("open"),
            (F.col("source_size") / F.greatest("docs", F.lit(1))).alias("mean"),
            F.lit(0.0).alias("multiplier"),
            F.lit(-FAR).alias("low"),
            F.lit(FAR).alias("high"),
        ),
        "mix-state",
    )
    tilt = F.least(F.exp(F.least(F.col("multiplier") * F.col("size") / F.col("mean"), F.lit(50.0))), cap)
    for _ in range(params.max_steps):
        live = state.where("open")
        sums = (
            table.join(live.select(F.col("source").alias("s"), "multiplier", "mean"), F.col("source").eqNullSafe(F.col("s")))
            .withColumn("rate", tilt)
            .groupBy("source")
            .agg(
                F.sum(F.col("n") * F.col("size") * F.col("rate")).alias("takes"),
                F.sum(F.when(F.col("rate") < cap, F.col("n") * F.col("size") * F.col("rate") * F.col("size") / F.col("mean")).otherwise(0.0)).alias("slope"),
            )
        )
        step = state.join(sums.select(F.col("source").alias("s"), "takes", "slope"), F.col("source").eqNullSafe(F.col("s")), "left")
        gap = F.col("takes") - F.col("target")
        near = F.abs(gap) <= params.tolerance * F.col("target")
        low = F.when(gap < 0, F.col("multiplier")).otherwise(F.col("low"))
        high = F.when(gap > 0, F.col("multiplier")).otherwise(F.col("high"))
        newton = F.col("multiplier") - gap / F.when(F.col("slope") > 0, F.col("slope"))
        # where Newton leaves the bracket: its middle, or further and further out while one side is open
        stride = F.abs("multiplier") + 4.0
        up = F.when(high < FAR, (F.col("multiplier") + high) / 2).otherwise(F.col("multiplier") + stride)
        down = F.when(low > -FAR, (F.col("multiplier") + low) / 2).otherwise(F.col("multiplier") - stride)
        trusted = (newton > low) & (newton < high) & (F.abs(newton - F.col("multiplier")) <= stride)
        inside = F.when(trusted, newton).when(gap < 0, up).otherwise(down)
        moves = F.col("open") & F.col("takes").isNotNull() & ~near
        state = materialise(
            step.select(
                "source",
                "source_size",
                "docs",
                "target",
                moves.alias("open"),
                "mean",
                F.when(moves, inside).otherwise(F.col("multiplier")).alias("multiplier"),
                F.when(moves, low).otherwise(F.col("low")).alias("low"),
                F.when(moves, high).otherwise(F.col("high")).alias("high"),
            ),
            "mix-state",
        )
        if state.where("open").isEmpty():
            break
    else:
        raise RuntimeError(f"the multipliers of some sources did not settle in {params.max_steps} steps")
    return state.select("source", "source_size", "docs", "target", "mean", "multiplier")


def dealt(sizes: DataFrame, params: MixParams) -> DataFrame:
    """Chunks of equal rows of ``sizes`` (doc_id, source, size, ...): plus source_size, target, rate, ``rows`` and their ``copies`` together."""
    prepare(sizes.sparkSession)
    names = sizes.columns
    groups = sizes.groupBy(*names).agg(F.count("*").alias("rows"))
    chunk = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("rows") - 1) / params.bucket_rows)))
    chunks = groups.withColumn("chunk", chunk).withColumn("rows", F.least(F.col("rows") - F.col("chunk") * params.bucket_rows, F.lit(params.bucket_rows)))
    solved = multipliers(sizes, targets(sizes, params), params)
    cap = F.lit(float(params.cap))
    full = F.col("target") >= F.col("source_size") * cap * F.lit(1 - 1e-12)
    tilt = F.least(F.exp(F.least(F.col("multiplier") * F.col("size") / F.col("mean"), F.lit(50.0))), cap)
    rate = F.when(F.col("size") == 0, F.lit(1.0)).when(full, cap).when(F.col("target") <= 0, F.lit(0.0)).otherwise(tilt)
    buckets = F.ceil(F.col("docs") / params.bucket_rows)
    rated = (
        chunks.join(solved.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")))
        .withColumn("rate", rate)
        .withColumn("bucket", F.pmod(F.xxhash64("doc_id", "size", "chunk"), buckets))
        .select(*names, "chunk", "rows", "source_size", "target", "rate", "bucket")
    )

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at: tuple | None = None
        owed = 0.0
        for batch in batches:
            sources, bucket, size, rows, rates = (batch.column(batch.schema.get_field_index(x)).to_pylist() for x in ("source", "bucket", "size", "rows", "rate"))
            out = []
            for s, b, n, m, r in zip(sources, bucket, size, rows, rates, strict=True):
                if (s, b) != at:
                    at, owed = (s, b), 0.0
                owed += n * m * r
                k = min(max(int(owed / n + 0.5), 0), params.cap * m) if n else m
                owed -= n * k
                out.append(k)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.int64())], names=[*batch.schema.names, "copies"])

    ordered = [F.col("source"), F.col("bucket"), F.col("size").desc(), *(F.col(x) for x in names if x not in ("source", "size")), F.col("chunk")]
    return rated.repartition("source", "bucket").sortWithinPartitions(*ordered).mapInArrow(deal, extended(rated, "copies long"))


def copies(sizes: DataFrame, params: MixParams = MixParams()) -> DataFrame:
    """``sizes`` (doc_id, source, size, ...) plus source_size, target, rate and copies; equal rows differ by one copy at most in a chunk."""
    each = dealt(sizes, params).withColumn("row", F.explode(F.sequence(F.lit(0).cast("long"), F.col("rows") - 1)))
    mine = F.floor((F.col("copies") + F.col("row")) / F.col("rows")).cast("long")
    return each.select(*sizes.columns, "source_size", "target", "rate", mine.alias("copies"))


def mix(docs: DataFrame, params: MixParams = MixParams()) -> DataFrame:
    """``docs`` with every row as often as the mix takes it (0 to ``cap`` times), whatever its columns' names.

    A row is known by a hash of all its columns (but maps); of rows that agree in it one stands for all.
    """
    hashed = [c for c, f in zip(quoted(docs.columns), docs.schema) if f.dataType.typeName() not in ("map", "variant")]
    packed = docs.select(F.struct(*quoted(docs.columns)).alias("row"), F.xxhash64(*hashed).alias("h1"), F.xxhash64(F.lit(3), *hashed).alias("h2"), "doc_id", "source", "text")
    light = materialise(with_size(packed).select("doc_id", "source", "size", "h1", "h2"), "mix-light")
    taken = materialise(dealt(light, params).where("copies > 0").select("h1", "h2", "rows", "chunk", "copies"), "mix-taken")
    every = packed.select("row", "h1", "h2")
    again = taken.where("rows > 1 or chunk > 0").select("h1", "h2").distinct()
    if again.isEmpty():
        out = every.join(taken, ["h1", "h2"])
    else:
        alone = every.join(again, ["h1", "h2"], "left_anti").join(taken, ["h1", "h2"])
        first = every.join(again, ["h1", "h2"], "left_semi").groupBy("h1", "h2").agg(F.first("row").alias("row"))
        out = alone.unionByName(first.join(taken, ["h1", "h2"]).select(*alone.columns))
    return out.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select("row.*")
