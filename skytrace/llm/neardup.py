"""SimHash near-duplicates linked through BK-trees.

Fingerprints: texts are lower-cased (A-Z), cut into words and overlapping
shingles with repeats; a bit is set if it is set in over half the shingles'
XXH64 hashes (seed 42).  Fewer words than a shingle make one shingle of them
all; no words give fingerprint zero.

Linking: equal fingerprints collapse to one row with their smallest ``doc_id``.
Blocks of the distinct fingerprints form buckets (see ``hamming``); each shard of
a bucket becomes a BK-tree, whose children are keyed by their Hamming distance to
the parent, and a search follows only edges within the radius of its distance.
A shard emits a spanning forest of its links, never all pairs.  Components are
joined by distributed star contraction.

Defined cases: null and empty texts have fingerprint zero and are linked like
any other; rows that share a ``doc_id`` are one document and linked; a null
``doc_id`` takes the smallest id of its component, or null; extra columns stay.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from skytrace.llm import textbatch as tb
from skytrace.llm.common import materialise, prepare, quoted, with_columns
from skytrace.llm.components import components
from skytrace.llm.hamming import ASKED, STORED, Tables, dealt, grouped, segments, shards
from skytrace.llm.textbatch import slices


@dataclass(frozen=True)
class NearDupParams:
    shingle: int = 4
    radius: int = 4
    seed: int = 42
    shard_rows: int = 2048
    #: Members that a bucket of random fingerprints should have at most, on average.
    bucket_rows: int = 64


BITS_OF_BYTE = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def bit_sums(hashes: np.ndarray, row: np.ndarray, rows: int, weights: np.ndarray | None = None) -> np.ndarray:
    """For each row the (weighted) number of its hashes that have each of 64 bits set."""
    out = np.zeros((rows, 64), np.float64 if weights is not None else np.int64)
    step = 512  # rows at a time, so the byte counts stay small
    bounds = np.searchsorted(row, np.arange(0, rows + step, step))
    octets = hashes.astype("<u8").view(np.uint8).reshape(-1, 8)
    for i, (a, b) in enumerate(zip(bounds, bounds[1:])):
        n = min(step, rows - i * step)
        local = (row[a:b] - i * step) * 256
        for k in range(8):
            seen = np.bincount(local + octets[a:b, k], None if weights is None else weights[a:b], minlength=n * 256)[: n * 256].reshape(n, 256)
            out[i * step : i * step + n, 8 * k : 8 * k + 8] = seen @ BITS_OF_BYTE
    return out


def pack_bits(bits: np.ndarray) -> np.ndarray:
    """Rows of 64 booleans, lowest bit first, as 64-bit words."""
    return np.packbits(bits, axis=1, bitorder="little").view("<u8").reshape(-1)


def shingle_hashes(raw: bytes, size: int, seed: int) -> list[int]:
    words = raw.lower().split()
    if not words:
        return []
    joined = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) <= size:
        return [digest(joined, seed)]
    starts, at = [], 0
    for w in words:
        starts.append(at)
        at += len(w) + 1
    ends = [s - 1 for s in starts[size:]]
    ends.append(len(joined))
    return [digest(joined[a:b], seed) for a, b in zip(starts, ends)]


def fingerprint_slice(data: np.ndarray, off: np.ndarray, params: NearDupParams) -> np.ndarray:
    raw = data.tobytes()
    cut = off.tolist()
    hashes: list[int] = []
    counts = []
    for a, b in zip(cut, cut[1:]):
        found = shingle_hashes(raw[a:b], params.shingle, params.seed)
        counts.append(len(found))
        hashes += found
    n = np.array(counts, np.int64)
    sums = bit_sums(np.array(hashes, np.uint64), np.repeat(np.arange(len(n)), n), len(n))
    return pack_bits(2 * sums > n[:, None])


def fingerprints(docs: DataFrame, params: NearDupParams = NearDupParams(), name: str = "fp") -> DataFrame:
    """``docs`` (with ``text``) plus the fingerprint as a long; an input column of that name is replaced."""
    prepare(docs.sparkSession)
    rest = docs.drop(name)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, off in slices(batches, "text", 4 << 20):
            fp = fingerprint_slice(data, off, params).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(fp)], names=[*batch.schema.names, name])

    return with_columns(rest, run, f"{name} long")


def layout(n: int, params: NearDupParams) -> Tables:
    """Tables for ``n`` fingerprints.

    The number of blocks that must agree grows with the number of fingerprints
    so that buckets of random ones stay small; which links are found doesn't
    depend on it.
    """
    for chosen in range(1, 5):
        width = 64 // (params.radius + chosen)
        if n <= params.bucket_rows << (width * chosen):
            break
    return Tables(64, params.radius, chosen)


class BKTree:
    """Fingerprints by Hamming distance: a child's key is its distance to its parent."""

    __slots__ = ("root",)

    def __init__(self) -> None:
        self.root: tuple | None = None

    def add(self, fp: int, item: int) -> None:
        if self.root is None:
            self.root = (fp, item, {})
            return
        node = self.root
        while True:
            d = (node[0] ^ fp).bit_count()
            child = node[2].get(d)
            if child is None:
                node[2][d] = (fp, item, {})
                return
            node = child

    def within(self, fp: int, radius: int) -> list[int]:
        """Items of all fingerprints at most ``radius`` away."""
        found: list[int] = []
        stack = [self.root] if self.root is not None else []
        while stack:
            other, item, children = stack.pop()
            d = (other ^ fp).bit_count()
            if d <= radius:
                found.append(item)
            if children:
                for k in range(d - radius, d + radius + 1):
                    child = children.get(k)
                    if child is not None:
                        stack.append(child)
        return found


def bucket_links(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    """A spanning forest of each shard's links, as pairs of representatives."""
    key, tree, parent = None, BKTree(), {}

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    a: list[int] = []
    b: list[int] = []
    for now, role, (fps, reps) in segments(batches, 2):
        if now != key:
            key, tree, parent = now, BKTree(), {}
        for fp, rep in zip(fps.view(np.uint64).tolist(), reps.tolist()):
            if role == STORED and rep not in parent:
                parent[rep] = rep
            mine = root(rep) if role == STORED else None
            for hit in tree.within(fp, radius):
                other = root(hit)
                if other == mine:
                    continue
                a.append(rep)
                b.append(hit)
                if mine is None:
                    mine = other
                else:
                    parent[other] = mine
            if role == STORED:
                tree.add(fp, rep)
        if len(a) >= 50_000:
            yield pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])
            a, b = [], []
    if a:
        yield pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def near_duplicates(docs: DataFrame, params: NearDupParams = NearDupParams()) -> DataFrame:
    """(doc_id, fp, component_id) for every row of ``docs`` (doc_id, text)."""
    marked = materialise(fingerprints(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), params).select("doc_id", "fp"), "fingerprints")
    # links are between fingerprints, as any number may be an id
    classes = materialise(marked.groupBy("fp").agg(F.min("doc_id").alias("low")), "classes")
    n = classes.count()
    buckets = dealt(classes.select("fp", F.col("fp").alias("rep")), layout(n, params), ["fp"], params.shard_rows)
    radius = params.radius
    links = buckets.mapInArrow(lambda batches: bucket_links(batches, radius), "a long, b long")
    # a repeated id links its texts: each is linked to the one of them with the least fingerprint
    repeated = marked.where("doc_id is not null").groupBy("doc_id").agg(F.min("fp").alias("b"), F.max("fp").alias("most")).where("b < most")
    shared = marked.join(repeated.select("doc_id", "b"), "doc_id").select(F.col("fp").alias("a"), "b").where("a <> b").distinct()
    found = components(links.unionByName(shared))
    by_fp = classes.join(found, F.col("fp") == F.col("node"), "left").select("fp", "low", F.coalesce("component", "fp").alias("component"))
    low = materialise(by_fp, "components")
    least = low.groupBy("component").agg(F.min("low").alias("component_id"))
    return marked.join(low.select("fp", "component"), "fp").join(least, "component").select("doc_id", "fp", "component_id")


def hex_fingerprint(column: str = "fp") -> Column:
    return F.lower(F.lpad(F.hex(column), 16, "0"))


@dataclass(frozen=True)
class DedupParams:
    """Removal of near copies: shingle sets at least ``similarity`` alike (Jaccard)."""

    shingle: int = 5
    similarity: float = 0.8
    #: Fingerprints of 256 bits; two texts that are 0.8 alike differ in 39 of them, 5.7 more or less.
    radius: int = 62
    #: Tables of buckets, each keyed by two minima over the shingle set: a pair that is 0.8 alike misses all with chance 1e-5.
    tables: int = 11
    shard_rows: int = 1024
    #: Shards of a bucket that a text is searched in by fingerprint, at most.
    split: int = 8
    #: Shingles of the sets that an exact comparison has in hand.
    shard_shingles: int = 2_000_000
    #: Keys of linked texts that are broadcast to find them, at most; beyond that texts and keys are merged.
    broadcast_keys: int = 1_000_000
    #: Links of a text that are compared in one go.
    hub_links: int = 256


def shingle_sets(data: np.ndarray, off: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles and their rows; fewer words than a shingle make one of them all."""
    low = tb.LOWER[data]
    starts, ends, first = tb.words(low, off)
    hashes = tb.hash_spans(low, starts, ends - starts, seed=9)
    grams, row, _ = tb.ngrams(hashes, first, size)
    count = np.diff(first)
    few = np.flatnonzero((count > 0) & (count < size))
    if len(few):
        whole = np.zeros(len(few), np.uint64)
        for k in range(size - 1):
            has = count[few] > k
            whole[has] = tb.mix(whole[has] * tb.M1 + hashes[first[:-1][few[has]] + k])
        grams, row = np.concatenate([grams, whole]), np.concatenate([row, few])
        order = np.argsort(row, kind="stable")
        grams, row = grams[order], row[order]
    return grams, row


def distinct(grams: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each row's hashes once, in order."""
    order = np.lexsort((grams, row))
    grams, row = grams[order], row[order]
    first = np.ones(len(grams), bool)
    first[1:] = (np.diff(row) != 0) | (grams[1:] != grams[:-1])
    return grams[first], row[first]


def signatures(rows: DataFrame, params: DedupParams) -> DataFrame:
    """(k1, k2, doc_id, f0..f3, keys, size) of each row of ``rows`` (k1, k2, doc_id, text); size counts its distinct shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, off in slices(batches, "text"):
            n = batch.num_rows
            # similarity is of sets, so a repeat has no vote
            grams, row = distinct(*shingle_sets(data, off, params.shingle))
            bounds = np.searchsorted(row, np.arange(n + 1))
            full = np.flatnonzero(np.diff(bounds))
            total = np.diff(bounds)[:, None]
            bits = [pack_bits(2 * bit_sums(tb.mix(grams + np.uint64(s)), row, n) > total) for s in range(1, 5)]
            keys = np.zeros((n, params.tables), np.uint64)
            for t in range(2 * params.tables if len(grams) else 0):
                least = np.minimum.reduceat(tb.mix(grams ^ tb.mix(np.array([t + 77], np.uint64))), bounds[full])
                keys[full, t // 2] = tb.mix(keys[full, t // 2] * tb.M1 + least)
            flat = pa.ListArray.from_arrays(pa.array(np.arange(0, (n + 1) * params.tables, params.tables), pa.int32()), pa.array(keys.reshape(-1).view(np.int64)))
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(3)), *(pa.array(b.view(np.int64)) for b in bits), flat, pa.array(total[:, 0])], names=["k1", "k2", "doc_id", "f0", "f1", "f2", "f3", "keys", "size"])

    return rows.mapInArrow(run, "k1 long, k2 long, doc_id long, f0 long, f1 long, f2 long, f3 long, keys array<bigint>, size long")


def candidates(rows: DataFrame, large: DataFrame, sizes: DataFrame, params: DedupParams) -> DataFrame:
    """(a, b): forests of links by fingerprint inside the buckets of ``rows`` (table, value, f0..f3, rep).

    Members of a ``large`` bucket are searched in their own shard only, and with
    the bucket's smallest member; ``completed`` compares what that leaves apart.
    """
    names = ["f0", "f1", "f2", "f3", "rep"]
    count = F.ceil(F.col("members") / params.shard_rows)
    small = shards(rows.join(large.select("table", "value"), ["table", "value"], "left_anti"), sizes.select("table", "value", "members"), params.shard_rows)
    inside = rows.join(large.select("table", "value", "members"), ["table", "value"]).withColumn("shard", F.pmod(F.xxhash64("rep"), count).cast("int")).withColumn("role", F.lit(STORED))
    pivots = large.withColumn("shard", F.explode(F.sequence(F.lit(0), count.cast("int") - 1))).select("table", "value", "shard", F.lit(ASKED).alias("role"), *(F.col("pivot")[n].alias(n) for n in names))
    every = small.unionByName(inside.select("table", "value", "shard", "role", *names)).unionByName(pivots)
    found = grouped(every).mapInArrow(lambda batches: nearest_links(batches, params), "a long, b long")
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def nearest_links(batches: Iterator[pa.RecordBatch], params: DedupParams) -> Iterator[pa.RecordBatch]:
    """A minimum spanning forest, by fingerprint distance, of each shard's links within the radius.

    Whatever is connected at any smaller distance is connected by forest edges
    of at most that distance, in every shard and so in their union.  Distance
    only estimates similarity, so ``completed`` goes on where edges are refused.
    """
    key, tree = None, BKTree()
    fp_of: dict[int, int] = {}

    def forest(hits: list[tuple[int, int, int]]) -> pa.RecordBatch:
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            while parent.setdefault(x, x) != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        a, b = [], []
        for _, x, y in sorted(hits):
            p, q = root(x), root(y)
            if p != q:
                parent[p] = q
                a.append(x)
                b.append(y)
        return pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    hits: list[tuple[int, int, int]] = []
    asked = 0
    for now, role, (*parts, reps) in segments(batches, 5):
        if now != key or role != STORED and asked >= params.shard_rows:
            if hits:
                yield forest(hits)
            hits, asked = [], 0
        if now != key:
            key, tree, fp_of = now, BKTree(), {}
        words = [p.view(np.uint64).tolist() for p in parts]
        for w0, w1, w2, w3, rep in zip(*words, reps.tolist()):
            fp = w0 | w1 << 64 | w2 << 128 | w3 << 192
            hits += [((fp ^ fp_of[h]).bit_count(), rep, h) for h in tree.within(fp, params.radius) if h != rep]
            if role == STORED:
                fp_of[rep] = fp
                tree.add(fp, rep)
            else:
                asked += 1
                if len(hits) > 1_000_000:
                    yield forest(hits)
                    hits = []
    if hits:
        yield forest(hits)


def shingle_table(docs: DataFrame, wanted: DataFrame, params: DedupParams) -> DataFrame:
    """(k1, set): the distinct shingle hashes, in order, of each text of ``docs`` (k1, text) that is ``wanted`` (k1)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, off in slices(batches, "text"):
            grams, row = distinct(*shingle_sets(data, off, params.shingle))
            bounds = np.searchsorted(row, np.arange(batch.num_rows + 1))
            sets = pa.LargeListArray.from_arrays(pa.array(bounds), pa.array(grams.view(np.int64)))
            yield pa.record_batch([batch.column(0), sets.cast(pa.list_(pa.int64()))], names=["k1", "set"])

    wanted = materialise(wanted, "dedup-wanted")
    side = F.broadcast(wanted) if wanted.count() <= params.broadcast_keys else wanted
    # equal texts are one, whichever row comes first
    texts = docs.select("k1", "text").join(side, "k1", "left_semi")
    return materialise(texts.mapInArrow(run, "k1 long, set array<bigint>").groupBy("k1").agg(F.first("set").alias("set")), "dedup-sets")


def verified(links: DataFrame, sets: DataFrame, params: DedupParams) -> DataFrame:
    """The links whose texts' shingle sets are alike enough, by exact comparison.

    A link goes to the end with more links, whose set is sent once for
    ``hub_links`` of them.
    """
    ends = links.select(F.col("a").alias("k")).unionByName(links.select(F.col("b").alias("k"))).groupBy("k").agg(F.count("*").alias("n"))
    end = lambda name: ends.select(F.col("k").alias(name), F.struct("n", "k").alias(f"{name}_"))
    both = links.join(end("a"), "a").join(end("b"), "b")
    turned = both.select(F.greatest("a_", "b_").alias("hub"), F.least("a_", "b_")["k"].alias("k1"))
    parts = F.pmod(F.xxhash64("k1"), F.ceil(F.col("hub")["n"] / params.hub_links))
    pairs = materialise(turned.select(F.col("hub")["k"].alias("hub"), parts.alias("part"), "k1"), "dedup-hubs")
    hubs = pairs.select("hub", "part").distinct().withColumn("k1", F.col("hub"))
    rows = hubs.select("hub", "part", F.lit(0).alias("role"), "k1").unionByName(pairs.select("hub", "part", F.lit(1).alias("role"), "k1")).join(sets, "k1")
    rows = rows.select("hub", "part", "role", "k1", "set").repartition("hub", "part").sortWithinPartitions("hub", "part", "role")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = np.zeros(0, np.uint64)
        for batch in batches:
            hub, role, k1 = (np.asarray(batch.column(i)) for i in (0, 2, 3))
            cut, values = batch.column(4).offsets.to_pylist(), np.asarray(batch.column(4).values).view(np.uint64)
            good = np.zeros(len(hub), bool)
            for i, r in enumerate(role.tolist()):
                mine = values[cut[i] : cut[i + 1]]
                if r == 0:
                    whole = mine
                elif len(whole) and len(mine):
                    common = int((whole[np.minimum(np.searchsorted(whole, mine), len(whole) - 1)] == mine).sum())
                    good[i] = common >= params.similarity * (len(whole) + len(mine) - common)
            yield pa.record_batch([pa.array(np.minimum(hub, k1)[good]), pa.array(np.maximum(hub, k1)[good])], names=["a", "b"])

    return rows.mapInArrow(check, "a long, b long")


class ShingleIndex:
    """Shingle sets by shingle, to count what a set has in common with each of them."""

    def __init__(self, sets: list[np.ndarray]) -> None:
        flat = np.concatenate(sets)
        order = np.argsort(flat, kind="stable")
        self.sizes = np.array([len(s) for s in sets])
        self.owners = np.repeat(np.arange(len(sets)), self.sizes)[order]
        self.flat = flat[order]

    def alike(self, x: np.ndarray, similarity: float) -> np.ndarray:
        """Which of the sets are at least so much alike ``x``."""
        low, high = np.searchsorted(self.flat, x, "left"), np.searchsorted(self.flat, x, "right")
        n = high - low
        at = np.repeat(low - (np.cumsum(n) - n), n) + np.arange(n.sum())
        common = np.bincount(self.owners[at], minlength=len(self.sizes))
        return np.flatnonzero(common >= similarity * (len(x) + self.sizes - common))


def alike_links(batches: Iterator[pa.RecordBatch], params: DedupParams) -> Iterator[pa.RecordBatch]:
    """Links that join what each shard's alike sets connect, from (table, value, shard, role, asks, strong, k1, set).

    Every set that ``asks`` is compared with every stored one; rows of one ``strong`` number are connected already.
    """
    key, index = None, None
    parent: dict[int, int] = {}
    stored: list[tuple[int, int, np.ndarray, bool]] = []
    a: list[int] = []
    b: list[int] = []

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def ask(strong: int, rep: int, found: np.ndarray) -> None:
        for i in index.alike(found, params.similarity).tolist():
            p, q = root(strong), root(stored[i][0])
            if p != q:
                parent[p] = q
                a.append(rep)
                b.append(stored[i][1])

    def close() -> None:
        nonlocal index
        if index is None and stored:
            index = ShingleIndex([s for _, _, s, _ in stored])
            for strong, rep, found, asks in stored:
                if asks:
                    ask(strong, rep, found)

    for batch in batches:
        table, value, shard, role, asks, strong, reps = (batch.column(i).to_pylist() for i in range(7))
        sets = batch.column(7)
        cut, values = sets.offsets.to_pylist(), sets.values.to_numpy(zero_copy_only=False)
        for i, now in enumerate(zip(table, value, shard)):
            if now != key:
                close()
                key, index, stored, parent = now, None, [], {}
            found = values[cut[i] : cut[i + 1]]
            if role[i] == STORED:
                stored.append((strong[i], reps[i], found, asks[i]))
            else:
                close()
                if stored:
                    ask(strong[i], reps[i], found)
        if len(a) >= 50_000:
            yield pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])
            a.clear()
            b.clear()
    close()
    yield pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def bucket_state(rows: DataFrame) -> DataFrame:
    """(table, value, n, weight, most, top) of buckets of ``rows`` (table, value, strong, size, ...) not yet connected.

    ``top`` is the strong number of most members, of which there are ``most``.
    """
    by_strong = rows.groupBy("table", "value", "strong").agg(F.count("*").alias("n"), F.sum("size").alias("weight"))
    state = by_strong.groupBy("table", "value").agg(F.sum("n").alias("n"), F.sum("weight").alias("weight"), F.max(F.struct("n", "strong")).alias("top"), F.count("*").alias("k")).where("k > 1")
    return state.select("table", "value", "n", "weight", F.col("top.n").alias("most"), F.col("top.strong").alias("top"))


def unsearched(large: DataFrame, keys: DataFrame, strong: DataFrame, params: DedupParams) -> DataFrame:
    """(table, value, strong, size, k1): large buckets that their verified links don't connect.

    Where many members are apart, a bucket is split by the keys of further
    tables, as alike texts share most of them, up to three in all; buckets that
    are connected go at each step.
    """
    every = keys.select("k1", F.map_from_arrays(F.sequence(F.lit(0), F.lit(params.tables - 1)), "keys").alias("keys"))
    now = keys.select("k1", F.posexplode("keys").alias("last", "value")).withColumn("table", F.col("last").cast("long"))
    now = now.join(large.select("table", "value"), ["table", "value"], "left_semi").join(strong, "k1")
    parts = []
    for level in range(3):
        now = materialise(now.select("table", "value", "last", "strong", "size", "k1"), "dedup-large")
        state = materialise(bucket_state(now), "dedup-state")
        cheap = (F.col("n") - F.col("most")) * F.ceil(F.col("n") / params.shard_rows) <= params.split * F.col("n")
        parts.append(now.join(state.where(cheap) if level < 2 else state, ["table", "value"], "left_semi").drop("last"))
        costly = state.where(~cheap)
        if level == 2 or costly.isEmpty():
            break
        more = now.join(costly, ["table", "value"], "left_semi").where(F.col("last") < params.tables - 1).join(every, "k1")
        more = more.withColumn("next", F.explode(F.sequence(F.col("last") + 1, F.lit(params.tables - 1))))
        now = more.select((F.col("table") * params.tables + F.col("next") + params.tables).alias("table"), F.xxhash64("value", F.col("keys")[F.col("next")]).alias("value"), F.col("next").alias("last"), "strong", "size", "k1")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def completed(source: DataFrame, classes: DataFrame, links: DataFrame, large: DataFrame, params: DedupParams) -> DataFrame:
    """Verified links that connect every alike pair of candidates, not only those that are links themselves.

    What refused links hold together, but verified ones don't, is compared
    exactly: groups that fit a shard all against all, larger ones by bucket; and
    so are the members of large buckets that aren't connected.  In a bucket only
    those outside its largest connected part ask the others.
    """
    sets = shingle_table(source, links.select(F.col("a").alias("k1")).unionByName(links.select(F.col("b").alias("k1"))).distinct(), params)
    direct = materialise(verified(links, sets, params), "dedup-verified")
    joined = components(direct)
    strong = materialise(classes.select("k1", "size").join(joined, F.col("k1") == F.col("node"), "left").select("k1", "size", F.coalesce("component", "k1").alias("strong")), "dedup-strong")
    end = lambda name: strong.select(F.col("k1").alias(name), F.col("strong").alias(f"{name}_"))
    refused = links.join(end("a"), "a").join(end("b"), "b").where("a_ <> b_").select(F.least("a_", "b_").alias("a"), F.greatest("a_", "b_").alias("b")).distinct()
    groups = components(refused)  # without the smallest node of each
    groups = groups.unionByName(groups.select(F.col("component").alias("node"), "component").distinct())
    members = materialise(strong.join(groups, F.col("strong") == F.col("node")).select("k1", "size", "strong", F.col("component").alias("value")), "dedup-members")
    many = members.groupBy("value").agg(F.count("*").alias("n")).where(F.col("n") > params.shard_rows)
    names = ["table", "value", "strong", "size", "k1"]
    rows = members.join(many, "value", "left_anti").withColumn("table", F.lit(-1).cast("long")).select(*names)
    keys = classes.select("k1", F.posexplode("keys").alias("table", "value")).withColumn("table", F.col("table").cast("long"))
    rows = rows.unionByName(members.join(many, "value", "left_semi").drop("value").join(keys, "k1").select(*names))
    wide = not large.isEmpty()
    if wide:
        rows = rows.unionByName(unsearched(large, classes.select("k1", "keys"), strong, params).select(*names))
    rows = materialise(rows.distinct() if wide else rows, "dedup-rows")
    count = F.ceil(F.greatest(F.col("n") / params.shard_rows, F.col("weight") / params.shard_shingles)).cast("int")
    placed = rows.join(bucket_state(rows), ["table", "value"]).withColumn("own", F.pmod(F.xxhash64("k1"), count).cast("int")).withColumn("asks", F.col("strong") != F.col("top"))
    dealt = placed.withColumn("shard", F.explode(F.when(F.col("asks"), F.sequence(F.lit(0), count - 1)).otherwise(F.array("own"))))
    dealt = materialise(dealt.withColumn("role", F.when(F.col("shard") == F.col("own"), STORED).otherwise(ASKED)).select("table", "value", "shard", "role", "asks", "strong", "k1"), "dedup-asked")
    if wide:
        missing = dealt.select("k1").distinct().join(sets, "k1", "left_anti")
        sets = sets.unionByName(shingle_table(source, missing, params))
    order = ["table", "value", "shard", "role", "asks", "strong", "k1"]
    compared = dealt.join(sets, "k1").select(*order, "set").repartition("table", "value", "shard").sortWithinPartitions(*order)
    return direct.unionByName(compared.mapInArrow(lambda batches: alike_links(batches, params), "a long, b long"))


def deduplicate(docs: DataFrame, params: DedupParams = DedupParams()) -> DataFrame:
    """``docs`` without near copies: of each component the row with the smallest ``doc_id`` stays.

    Ties go to the smaller text hash, and of rows equal in both one stays; a row
    without id yields to any with one.  Texts without words are copies of each
    other; extra columns stay, whatever their names.  Texts are known by 128 bits
    of hash, and by 64 inside the link table.
    """
    prepare(docs.sparkSession)
    text = F.coalesce(F.col("text"), F.lit(""))
    last = F.lit((1 << 63) - 1)
    # the row is packed, so its columns' names meet no others
    keyed = docs.select(F.struct(*quoted(docs.columns)).alias("row"), F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(7), text).alias("k2"), F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    source = keyed.select("k1", "k2", "doc_id", "text")
    same = signatures(source, params).groupBy("k1", "k2").agg(F.coalesce(F.min("doc_id"), last).alias("id"), *(F.first(f).alias(f) for f in ("f0", "f1", "f2", "f3", "keys", "size")))
    classes = materialise(same, "dedup-classes")
    rows = classes.where("size > 0").select(F.posexplode("keys").alias("table", "value"), "f0", "f1", "f2", "f3", F.col("k1").alias("rep")).withColumn("table", F.col("table").cast("long"))
    pivot = F.min(F.struct("rep", "f0", "f1", "f2", "f3")).alias("pivot")
    sizes = materialise(rows.groupBy("table", "value").agg(F.count("*").alias("members"), pivot).where(F.col("members") > params.shard_rows), "dedup-sizes")
    large = sizes.where(F.col("members") > params.split * params.shard_rows)
    links = materialise(candidates(rows, large, sizes, params), "dedup-links")
    wordless = classes.where("size = 0").select("k1")
    anchor = wordless.agg(F.min("k1")).first()[0]  # one value
    blank = wordless.select(F.lit(anchor).cast("long").alias("a"), F.col("k1").alias("b"))
    found = components(completed(source, classes, links, large, params).unionByName(blank))
    placed = classes.select("k1", "k2", "id").join(found, F.col("k1") == F.col("node"), "left").select("k1", "k2", "id", F.coalesce("component", "k1").alias("component"))
    best = placed.groupBy("component").agg(F.min(F.struct("id", "k2", "k1")).alias("s")).select(F.col("s.id").alias("doc_id"), F.col("s.k1").alias("k1"), F.col("s.k2").alias("k2"))
    kept = keyed.select("row", "k1", "k2", F.coalesce("doc_id", last).alias("doc_id")).join(best, ["k1", "k2", "doc_id"])
    one = Window.partitionBy("k1", "k2").orderBy(*tie_order(docs))
    return kept.withColumn("n", F.row_number().over(one)).where("n = 1").select("row.*")


def tie_order(docs: DataFrame) -> list[Column]:
    """An order of rows packed in ``row`` that differ in columns beside the text."""
    plain = [f.name for f in docs.schema if f.name != "text" and f.dataType.typeName() not in ("map", "array", "struct", "variant")]
    nested = [f.name for f in docs.schema if f.dataType.typeName() in ("map", "array", "struct", "variant")]
    return [*(F.col("row")[c] for c in plain), *([F.to_json(F.struct(*(F.col("row")[c].alias(c) for c in nested)))] if nested else []), F.lit(0)]
