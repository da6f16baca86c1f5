"""Counts of what goes through a stage, taken while it is written: no second job."""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

log = logging.getLogger("skytrace")


class Counters:
    """Watches DataFrames and tells their counts once they have been written."""

    def __init__(self) -> None:
        self._watched: dict[str, Observation] = {}

    def watch(self, df: DataFrame, name: str, **counts: Column) -> DataFrame:
        """``df``, whose rows, and whatever ``counts`` says, are counted as ``name`` when it runs."""
        seen = Observation(name)
        self._watched[name] = seen
        return df.observe(seen, F.count(F.lit(1)).alias("rows"), *(c.alias(k) for k, c in counts.items()))

    def told(self) -> dict[str, dict[str, int]]:
        """Counts by name, which are logged too; everything watched must have run."""
        out = {name: seen.get for name, seen in self._watched.items()}
        for name, counts in out.items():
            log.info("%s: %s", name, ", ".join(f"{k} {v:,}" for k, v in counts.items()))
        return out
