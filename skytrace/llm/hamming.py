"""Buckets of fingerprints that share blocks of bits, cut so that no task holds more than a shard.

Fingerprints within radius r agree on at least c of any r + c blocks, so all
links show up inside buckets (table, value) of c equal blocks.  A bucket over
``shard_rows`` members is cut into shards by hash: each member is stored in its own
and asked of all earlier ones, so every pair meets exactly once.  A bucket of over
``SPLIT`` shards is not asked of so many: its members' other bits are cut into r + 1
blocks, of which at least one is equal too, and each makes a smaller bucket.
That goes on until no bucket is larger, at a cost of r + 1 rows a member each
time, or until under 2 r + 2 bits are left: few distinct fingerprints differ in those only.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skytrace.llm.common import materialise
from skytrace.llm.textbatch import M1, mix

STORED, ASKED = 0, 1
#: Shards of a bucket that a member is asked of, at most; larger buckets are split by further blocks.
SPLIT = 8


class Tables:
    """Which bits the members of a table's buckets agree on.

    Tables are numbered: first those of ``chosen`` out of radius + chosen blocks,
    then, for each, those that its large buckets are split into.
    """

    def __init__(self, bits: int, radius: int, chosen: int = 1) -> None:
        blocks = radius + chosen
        edges = [bits * k // blocks for k in range(blocks + 1)]
        self.bits, self.parts = bits, radius + 1
        self.spans = [list(x) for x in combinations([(a, b - a) for a, b in zip(edges, edges[1:])], chosen)]
        self.first = [sum(((1 << w) - 1) << s for s, w in x) for x in self.spans]

    @cache  # noqa: B019
    def used(self, table: int) -> int:
        """The bits that are equal in a bucket."""
        if table < len(self.first):
            return self.first[table]
        parent, part = divmod(table - len(self.first), self.parts)
        return self.used(parent) | self.blocks(parent)[part]

    @cache  # noqa: B019
    def blocks(self, table: int) -> list[int]:
        """The bits that tell a split bucket's parts from each other."""
        free = [k for k in range(self.bits) if not self.used(table) >> k & 1]
        edges = [len(free) * k // self.parts for k in range(self.parts + 1)]
        return [sum(1 << k for k in free[a:b]) for a, b in zip(edges, edges[1:])]

    @cache  # noqa: B019
    def earlier(self, table: int) -> list[int]:
        """A pair belongs to this table if it differs in all of these: else it meets in an earlier one too."""
        if table < len(self.first):
            return self.first[:table]
        parent, part = divmod(table - len(self.first), self.parts)
        return self.earlier(parent) + self.blocks(parent)[:part]

    def child(self, table: np.ndarray, part: int) -> np.ndarray:
        return len(self.first) + table * self.parts + part

    def entries(self, words: list[str]) -> Column:
        """(table, value) of each row's first tables; ``words`` are the columns with the bits, lowest first."""

        def value(spans: list[tuple[int, int]]) -> Column:
            out = F.lit(0).cast("long")
            for shift, width in spans:
                if shift // 64 != (shift + width - 1) // 64:
                    raise ValueError("a block may not lie in two words")
                word = F.col(words[shift // 64])
                part = word if width == 64 else F.shiftrightunsigned(word, shift % 64).bitwiseAND(F.lit((1 << width) - 1).cast("long"))
                out = part if width == 64 else F.shiftleft(out, width).bitwiseOR(part)
            return out

        return F.explode(F.array(*(F.struct(F.lit(i).cast("long").alias("table"), value(s).alias("value")) for i, s in enumerate(self.spans))))

    def split(self, batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
        """Rows (table, value, words, ...) once for each part that their bucket is split into."""
        for batch in batches:
            table, value, *bits = (np.asarray(batch.column(i)) for i in range(2 + words))
            bits = [b.view(np.uint64) for b in bits]
            for part in range(self.parts):
                new = mix(value.view(np.uint64) * M1 + np.uint64(part + 1))
                for t in np.unique(table).tolist():
                    mask, at = self.blocks(t)[part], np.flatnonzero(table == t)
                    for i, b in enumerate(bits):
                        new[at] = mix(new[at] * M1 + (b[at] & np.uint64(mask >> 64 * i & 0xFFFFFFFFFFFFFFFF)))
                columns = [pa.array(self.child(table, part)), pa.array(new.view(np.int64)), *(batch.column(i) for i in range(2, batch.num_columns))]
                yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)


def dealt(rows: DataFrame, tables: Tables, words: list[str], shard_rows: int, split: int = SPLIT) -> DataFrame:
    """``rows`` (*words, ...) as (table, value, shard, role, *columns), grouped and ordered for ``segments``."""
    payload = [*words, *(c for c in rows.columns if c not in words)]
    now = rows.select(tables.entries(words).alias("e"), *payload).select("e.table", "e.value", *payload)
    parts = []
    free = tables.bits - min(x.bit_count() for x in tables.first)
    while True:
        sizes = materialise(now.groupBy("table", "value").agg(F.count("*").alias("members")).where(F.col("members") > shard_rows), "bucket-sizes")
        large = sizes.where(F.col("members") > split * shard_rows).select("table", "value")
        if free < 2 * tables.parts or large.isEmpty():
            parts.append(shards(now, sizes, shard_rows))
            break
        free -= free // tables.parts
        parts.append(shards(now.join(large, ["table", "value"], "left_anti"), sizes, shard_rows))
        again = now.join(large, ["table", "value"], "left_semi")
        now = materialise(again.mapInArrow(lambda batches: tables.split(batches, len(words)), again.schema), "bucket-parts")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return grouped(out)


def shards(rows: DataFrame, sizes: DataFrame, shard_rows: int) -> DataFrame:
    """``rows`` (table, value, ...) plus ``shard`` and ``role``; ``sizes`` has ``members`` of the buckets above a shard."""
    payload = [c for c in rows.columns if c not in ("table", "value")]
    count = F.coalesce(F.ceil(F.col("members") / shard_rows), F.lit(1))
    placed = rows.join(sizes, ["table", "value"], "left").withColumn("own", F.pmod(F.xxhash64(*payload), count).cast("int"))
    dealt = placed.withColumn("shard", F.explode(F.sequence(F.lit(0), F.col("own"))))
    dealt = dealt.withColumn("role", F.when(F.col("shard") == F.col("own"), STORED).otherwise(ASKED))
    return dealt.select("table", "value", "shard", "role", *payload)


def grouped(rows: DataFrame) -> DataFrame:
    return rows.repartition("table", "value", "shard").sortWithinPartitions(*rows.columns)


def segments(batches: Iterator[pa.RecordBatch], payload: int) -> Iterator[tuple[tuple, int, list[np.ndarray]]]:
    """(key, role, payload arrays) for stretches of rows with one key and role; a key may span several."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        table, value, shard, role = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
        data = [batch.column(4 + i).to_numpy(zero_copy_only=False) for i in range(payload)]
        change = (np.diff(table) != 0) | (np.diff(value) != 0) | (np.diff(shard) != 0) | (np.diff(role) != 0)
        edges = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
        for a, b in zip(edges, edges[1:]):
            yield (int(table[a]), int(value[a]), int(shard[a])), int(role[a]), [x[a:b] for x in data]
