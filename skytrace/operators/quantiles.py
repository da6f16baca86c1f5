"""Exact percentiles by group without sorting a group or holding its values in one task."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BINS = 4096
#: Values among which a rank is picked at last.
FEW = 65_536


@dataclass
class Search:
    """Where the value of a rank lies: between ``low`` and ``high``, with ``before`` smaller values and ``inside`` ones there."""

    group: object
    column: str
    rank: int
    low: float
    high: float
    before: int
    inside: int


def values_inside(rows: DataFrame, by: str, searches: list[Search]) -> DataFrame:
    """(search, x): each value that lies in a search's range."""
    found = [F.when(F.col(by).eqNullSafe(F.lit(s.group)) & F.col(s.column).between(s.low, s.high), F.struct(F.lit(i).alias("search"), F.col(s.column).alias("x"))) for i, s in enumerate(searches)]
    return rows.select(F.explode(F.array(*found)).alias("v")).where("v is not null").select("v.search", "v.x")


def narrowed(rows: DataFrame, by: str, searches: list[Search], bins: int) -> None:
    """Narrows each range to the bin of ``bins`` that holds the rank: one pass for all, which gathers counts by bin."""
    values = values_inside(rows, by, searches)
    low, high = (F.array(*(F.lit(getattr(s, k)) for s in searches))[F.col("search")] for k in ("low", "high"))
    part = (F.col("x") / 2 - low / 2) / (high / 2 - low / 2)
    counted = values.groupBy("search", F.least(F.floor(part * bins), F.lit(bins - 1)).alias("bin")).agg(F.count("*").alias("n"), F.min("x").alias("low"), F.max("x").alias("high"))
    for r in sorted(counted.collect(), key=lambda r: (r["search"], r["bin"])):  # a row a search and bin
        s = searches[r["search"]]
        if s.inside >= 0:
            if s.rank < s.before + r["n"]:
                s.low, s.high, s.inside = r["low"], r["high"], -r["n"] - 1  # found; the sign tells the rest of the bins
            else:
                s.before += r["n"]
    for s in searches:
        s.inside = -s.inside - 1


def percentiles(rows: DataFrame, by: str, columns: list[str], share: float, few: int = FEW, bins: int = BINS) -> dict[tuple, float | None]:
    """{(group, column): percentile}, interpolated between ranks; nulls don't count, and no values give None.

    Ranges are cut into bins by value until the bin of a rank is one value or holds a
    few; ties never stop that, as bins end at values that occur.
    """
    sizes = rows.groupBy(by).agg(*(f(c).alias(f"{c}_{n}") for c in columns for n, f in (("n", F.count), ("low", F.min), ("high", F.max)))).collect()
    out: dict[tuple, float | None] = {}
    wanted: dict[tuple, tuple[float, list[Search]]] = {}
    for r in sizes:
        for c in columns:
            n = r[f"{c}_n"]
            out[r[by], c] = None
            if n:
                at = share * (n - 1)
                ranks = sorted({int(at), min(int(at) + 1, n - 1)})
                wanted[r[by], c] = at, [Search(r[by], c, k, float(r[f"{c}_low"]), float(r[f"{c}_high"]), 0, n) for k in ranks]
    every = [s for _, found in wanted.values() for s in found]
    while open_ := [s for s in every if s.low < s.high and s.inside > few]:
        narrowed(rows, by, open_, bins)
    last = [s for s in every if s.low < s.high]
    if last:
        listed = values_inside(rows, by, last).groupBy("search").agg(F.sort_array(F.collect_list("x")).alias("x"))
        place = F.array(*(F.lit(s.rank - s.before) for s in last))[F.col("search")]
        for r in listed.select("search", F.col("x")[place].alias("x")).collect():
            last[r["search"]].low = last[r["search"]].high = float(r["x"])
    for key, (at, found) in wanted.items():
        low, high = found[0].low, found[-1].low
        out[key] = low + (high - low) * (at - int(at))
    return out
