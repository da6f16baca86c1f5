"""Removal of repeated substrings by a distributed merge sort of suffixes.

A byte goes if a ``length``-byte string covers it that also starts earlier: in a
document with a smaller ``doc_id``, or earlier in the same one.

Sorting every suffix isn't needed.  Each window of ``length`` bytes has an anchor,
the place of its least hashed ``GRAM``-byte string (the leftmost of equals), and
equal windows have equal anchors at equal distance.  So only suffixes at anchors
whose gram occurs twice in the corpus are sorted, and windows are told apart by
the sorted order to the right of the anchor and to its left:

1. ``repeated_anchors``: hashes of anchors are dealt by value in packed arrays, each
   once from a slice of texts; what occurs twice comes back as ordinals by document.
   Hashes from many slices are told too: hot ones.
2. ``suffix_runs``: each task cuts the texts around those anchors, sorts them, drops
   what has the same surroundings as an earlier one (all of whose windows are
   repeats), front-codes the sorted run and deals it by gram.  A hot gram's suffixes
   are dealt by ranges of the distance from window to anchor instead, each with all
   the bytes that windows of that range share: a share then holds real repeats only.
3. ``merge``: a loser tree merges the runs of a share.  Every stream carries the
   length of its common prefix with the last winner: where two differ, they
   decide; where they agree, bytes are compared from there on.  The merged order
   comes with its common prefixes, and intervals of them are the classes of
   windows; in each the earliest stays and all others are repeats.
4. ``remove``: covered ranges meet their texts.

Defined cases: a null or empty text has nothing to remove; of rows that share a
``doc_id`` those with the smaller text hash are earlier, and rows that agree in
both are one document; a null ``doc_id`` is earliest; texts are never cut.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skytrace.llm import textbatch as tb
from skytrace.llm.common import materialise, prepare, shuffle_partitions

#: Bytes of the strings whose hashes choose anchors.
GRAM = 32
SLICE = 2 << 20
#: Bytes of surroundings that a task sorts into one set of runs.
RUN_BYTES = 16 << 20
#: Shares of suffixes by shuffle partition; a task has one in hand at a time.
SHARES = 4
#: Slices with a gram beyond which its suffixes are dealt by ranges, and how many grams may be (layout only).
HOT, MOST_HOT, RANGES = 4096, 1 << 20, 8
NO_ID = -(1 << 63)
NOBODY = np.uint32(0xFFFFFFFF)
PLACE = np.uint64((1 << 24) - 1)
STEP = 1 << 23


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hashes of the GRAM bytes from each place on (meaningless nearer than GRAM to the end)."""
    h = tb.mix(np.arange(256, dtype=np.uint64) + tb.M3)[data]
    factor, width = 0x9E3779B97F4A7C15, 1
    while width < GRAM:
        h[:-width] = h[:-width] * np.uint64(factor) + h[width:]
        factor, width = factor * factor % (1 << 64), width * 2
    return tb.mix(h)


def anchors(data: np.ndarray, off: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(place, first window, last window, gram hash) of all anchors, in order."""
    n = len(data)
    if n < length:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),)
    span = length - GRAM + 1
    h = gram_hashes(data)
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, off[:-1], 1)
    np.add.at(edge, np.maximum(off[:-1], off[1:] - length + 1), -1)
    valid = np.cumsum(edge[:-1]) > 0
    found = []
    for base in range(0, n, STEP):  # places are kept in 24 bits
        part = h[base : base + STEP + span]
        least = (part & ~PLACE) | np.arange(len(part), dtype=np.uint64)
        width = 1
        while width * 2 <= span:
            least[: len(least) - width] = np.minimum(least[: len(least) - width], least[width:])
            width *= 2
        if (more := span - width) > 0:
            least[: len(least) - more] = np.minimum(least[: len(least) - more], least[more:])
        p = np.flatnonzero(valid[base : base + STEP])
        found.append((p + base, (least[p] & PLACE).astype(np.int64) + base))
    window = np.concatenate([w for w, _ in found])
    place = np.concatenate([a for _, a in found])
    if not len(window):
        return (window,) * 3 + (np.zeros(0, np.uint64),)
    new = np.append(True, (place[1:] != place[:-1]) | (window[1:] != window[:-1] + 1))
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(window)) - 1
    return place[first], window[first], window[last], h[place[first]]


def keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, text, dkey): dkey stands for the document in what is sent around."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_id"), text.alias("text")).withColumn("dkey", F.xxhash64("doc_id", "text"))


def repeated_anchors(docs: DataFrame, length: int, shares: int, hot: int = HOT) -> DataFrame:
    """(hot, dkey, marks): little-endian ordinals of a document's anchors whose gram occurs twice or more.

    Where ``hot`` is true, ``dkey`` is a gram's 48 bits instead, and there are no marks.
    """
    schema = "share int, bits binary, dkeys binary, refs binary"

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, off in tb.slices(batches, "text", SLICE):
            place, _, _, h = anchors(data, off, length)
            row = np.searchsorted(off, place, "right") - 1
            ordinal = np.arange(len(place)) - np.searchsorted(place, off)[row]
            dkey = batch.column(1).to_numpy(zero_copy_only=False)
            # 48 bits of the hash: a false repeat costs work, not truth
            short = h >> np.uint64(16)
            _, first, inverse, count = np.unique(short, return_index=True, return_inverse=True, return_counts=True)
            again = count[inverse] > 1
            out: list[list] = [[], [], [], []]

            def add(share: int, at: np.ndarray, bits: bytes) -> None:
                rows, local = np.unique(row[at], return_inverse=True)
                local = np.where(again[at] & bool(bits), NOBODY, local)
                values = (share, bits, dkey[rows].tobytes(), np.stack([local, ordinal[at]], 1).astype("<u4").tobytes())
                for column, v in zip(out, values, strict=True):
                    column.append(v)

            # what repeats inside the slice is known to, and is sent on once and for nobody
            own = np.flatnonzero(again)
            if len(own):
                add(int(dkey[0] % shares), own, b"")
            share = (h[first] % np.uint64(shares)).astype(np.int64)
            order = np.argsort(share, kind="stable")
            bounds = np.searchsorted(share[order], np.arange(shares + 1))
            for s in np.flatnonzero(np.diff(bounds)).tolist():
                at = first[order[bounds[s] : bounds[s + 1]]]
                add(s, at, short[at].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes())
            yield pa.record_batch([pa.array(out[0], pa.int32()), *(pa.array(x, pa.large_binary()) for x in out[1:])], names=["share", "bits", "dkeys", "refs"])

    names = ["hot", "bucket", "dkeys", "marks"]

    def marks(d: np.ndarray, o: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Packed by buckets of documents, so that rows don't grow with documents times shares."""
        bucket = d % shares
        by = np.argsort(bucket, kind="stable")
        d, o, bucket = d[by], o[by].astype("<u4"), bucket[by]
        cuts = np.append(np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])), len(d)).tolist() if len(d) else [0]
        pairs = list(zip(cuts, cuts[1:]))
        columns = [pa.array([False] * len(pairs), pa.bool_()), pa.array([int(bucket[x]) for x, _ in pairs], pa.int64()), *(pa.array([v[x:y].tobytes() for x, y in pairs], pa.large_binary()) for v in (d, o))]
        yield pa.RecordBatch.from_arrays(columns, names=names)

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in grouped(batches):
            told = [(k, m) for hot_, k, m in rows if hot_]
            if told:
                yield pa.record_batch([pa.array([True] * len(told)), pa.array([int.from_bytes(k, "little") for k, _ in told], pa.int64()), pa.array([[m] for _, m in told], pa.list_(pa.large_binary()))], names=["hot", "dkey", "marks"])
            own = [(k, m) for hot_, k, m in rows if not hot_]
            if own:
                d, o = (np.concatenate([np.frombuffer(x[i], t) for x in own]) for i, t in ((0, "<i8"), (1, "<u4")))
                by = np.argsort(d, kind="stable")
                d, o = d[by], o[by]
                cuts = np.append(np.flatnonzero(np.append(True, d[1:] != d[:-1])), len(d)).tolist()
                lists = pa.array([[o[x:y].tobytes()] for x, y in zip(cuts, cuts[1:])], pa.list_(pa.large_binary()))
                yield pa.record_batch([pa.array(np.zeros(len(cuts) - 1, bool)), pa.array(d[cuts[:-1]]), lists], names=["hot", "dkey", "marks"])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in grouped(batches):
            bits, dkeys, refs = [], [], []
            for b, d, r in rows:
                ref = np.frombuffer(r, "<u4").reshape(-1, 2)
                doc = np.frombuffer(d, np.int64)
                if not b:
                    yield from marks(doc[ref[:, 0]], ref[:, 1])
                    continue
                raw = np.zeros((len(b) // 6, 8), np.uint8)
                raw[:, :6] = np.frombuffer(b, np.uint8).reshape(-1, 6)
                bits.append(raw.view("<u8").reshape(-1))
                dkeys.append(doc[np.minimum(ref[:, 0], len(doc) - 1)])
                refs.append(ref)
            if not bits:
                continue
            h, d, ref = np.concatenate(bits), np.concatenate(dkeys), np.concatenate(refs)
            known, inverse, slices_ = np.unique(h, return_inverse=True, return_counts=True)
            several = np.bincount(inverse[ref[:, 0] == NOBODY], minlength=len(known)) > 0
            hit = np.flatnonzero((several | (slices_ > 1))[inverse] & (ref[:, 0] != NOBODY))
            yield from marks(d[hit], ref[hit, 1])
            for g, n in zip(known[slices_ > hot].tolist(), slices_[slices_ > hot].tolist()):
                yield pa.record_batch([pa.array([True]), pa.array([g % shares]), pa.array([int(g).to_bytes(8, "little")], pa.large_binary()), pa.array([int(n).to_bytes(8, "big")], pa.large_binary())], names=names)

    dealt = docs.select("text", "dkey").mapInArrow(deal, schema)
    back = dealt.repartition(shares, "share").sortWithinPartitions("share").mapInArrow(find, "hot boolean, bucket long, dkeys binary, marks binary")
    packed = back.select("bucket", "hot", "dkeys", "marks").repartition(shares, "bucket").sortWithinPartitions("bucket")
    return packed.mapInArrow(unpack, "hot boolean, dkey long, marks array<binary>")


def hot_grams(found: DataFrame, most: int = MOST_HOT) -> np.ndarray:
    """48 bits of the grams that stand in most slices, in order; at most so many."""
    rows = found.where("hot").select("dkey", F.col("marks")[0].alias("n")).orderBy(F.desc("n"), "dkey").limit(most).toArrow()
    return np.sort(rows.column("dkey").to_numpy())


def grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """The rows of each share, without the share, from batches ordered by it."""
    now, held = None, []
    for batch in batches:
        columns = [batch.column(i).to_pylist() for i in range(batch.num_columns)]
        for share, *row in zip(*columns, strict=True):
            if share != now and held:
                yield held
                held = []
            now = share
            held.append(row)
    if held:
        yield held


RUN = "share int, doc_ids binary, dkeys binary, doc binary, place binary, nearest binary, lcp binary, right_len binary, right binary, left_len binary, left binary, ranges binary"
RUN_NAMES = [x.split()[0] for x in RUN.split(", ")]


def common_prefix(a: bytes, b: bytes, known: int) -> int:
    """Length of the common prefix of two strings that agree on ``known`` bytes; those aren't looked at."""
    n = min(len(a), len(b))
    while known < n:
        x, y = a[known : known + 16], b[known : known + 16]
        if x != y:
            m = min(len(x), len(y))
            diff = int.from_bytes(x[:m]) ^ int.from_bytes(y[:m])
            return known + (m - (diff.bit_length() + 7) // 8)
        known += 16
    return n


def front_coded(share: int, items: list[tuple]) -> list:
    """A sorted run: each suffix as the length it shares with the one before it and the rest."""
    # (right, left, nearest, doc_id, dkey, place), sorted: equal surroundings stand together, the earliest first
    items.sort()
    kept, ranges, before = [], [], None
    docs: dict[tuple, int] = {}
    for item in items:
        right, left, nearest, doc_id, dkey, place = item
        doc = docs.setdefault((doc_id, dkey), len(docs))
        if before is not None and before[:3] == item[:3]:
            ranges += (doc, place - len(left), place + len(right))
        else:
            kept.append((right, left, nearest, doc, place))
            before = item
    lcp = [0] + [common_prefix(a[0], b[0], 0) for a, b in zip(kept, kept[1:])]
    number = lambda x, t: np.array(x, t).tobytes()
    return [
        share,
        number([d for d, _ in docs], np.int64),
        number([k for _, k in docs], np.int64),
        number([k[3] for k in kept], np.uint32),
        number([k[4] for k in kept], np.int64),
        number([k[2] for k in kept], np.uint8),
        number(lcp, np.uint8),
        number([len(k[0]) for k in kept], np.uint8),
        b"".join(k[0][n:] for k, n in zip(kept, lcp)),
        number([len(k[1]) for k in kept], np.uint8),
        b"".join(k[1] for k in kept),
        number(ranges, np.int64),
    ]


def suffix_runs(docs: DataFrame, marks: DataFrame, length: int, shares: int, hot: np.ndarray) -> DataFrame:
    """Front-coded sorted runs of the suffixes at repeated anchors; those of ``hot`` grams by ranges of distance."""
    span = length - GRAM + 1
    edges = [span * k // RANGES for k in range(RANGES + 1)]
    ranges = [(a, b - 1) for a, b in zip(edges, edges[1:]) if a < b]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple]] = {}
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            out: list[list] = [[] for _ in RUN_NAMES]
            for share in sorted(held):
                for column, v in zip(out, front_coded(share, held[share]), strict=True):
                    column.append(v)
                if len(out[0]) == 64:
                    yield pa.record_batch([pa.array(out[0], pa.int32()), *(pa.array(x, pa.large_binary()) for x in out[1:])], names=RUN_NAMES)
                    out = [[] for _ in RUN_NAMES]
            if out[0]:
                yield pa.record_batch([pa.array(out[0], pa.int32()), *(pa.array(x, pa.large_binary()) for x in out[1:])], names=RUN_NAMES)
            held.clear()

        for batch, data, off in tb.slices(batches, "text", SLICE):
            doc_ids, dkeys, marked = batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist()
            place, first, last, h = anchors(data, off, length)
            begin = np.searchsorted(place, off)
            raw = data.tobytes()
            shares_of = (h % np.uint64(shares)).tolist()
            places, firsts, lasts, starts = place.tolist(), first.tolist(), last.tolist(), off.tolist()
            short = (h >> np.uint64(16)).astype(np.int64)
            is_hot = (hot[np.minimum(np.searchsorted(hot, short), len(hot) - 1)] == short).tolist() if len(hot) else [False] * len(h)
            for i, parts in enumerate(marked):
                at = np.frombuffer(b"".join(parts), "<u4").astype(np.int64) + begin[i]
                for j in at[at < begin[i + 1]].tolist():
                    p, a, z = places[j], firsts[j], lasts[j]
                    if is_hot[j]:
                        for k, (near, far) in enumerate(ranges):
                            # windows of this range that are equal agree on these bytes, so they meet
                            x, y = max(near, p - z), min(far, p - a)
                            if x <= y:
                                share = xxhash.xxh64_intdigest(raw[p - near : p + length - far], k) % shares
                                held.setdefault(share, []).append((raw[p : p + length - x], raw[p - y : p], x, doc_ids[i], dkeys[i], p - starts[i]))
                                size += length - x + y
                        continue
                    held.setdefault(shares_of[j], []).append((raw[p : z + length], raw[a:p], p - z, doc_ids[i], dkeys[i], p - starts[i]))
                    size += z + length - a
            if size >= RUN_BYTES:
                yield from flush()
                size = 0
        yield from flush()

    joined = docs.join(marks, "dkey").select("doc_id", "text", "dkey", "marks")
    return joined.mapInArrow(run, RUN)


def loser_tree(runs: list[tuple[list[bytes], list[int]]]) -> tuple[list[int], list[int]]:
    """Merges sorted runs with their common prefixes.

    Gives the run of each string in merged order, and the length of its common
    prefix with the string before it.
    """
    k = len(runs)
    if k == 1:
        return [0] * len(runs[0][0]), list(runs[0][1])
    at = [0] * k
    current: list[bytes | None] = [strings[0] if strings else None for strings, _ in runs]
    shared = [0] * k  # each stream's common prefix with the last winner
    loser = [-1] * k

    def beats(x: int, y: int) -> bool:
        """Whether x's string comes first; the loser's common prefix becomes that with the winner."""
        a, b = current[x], current[y]
        if b is None:
            return True
        if a is None:
            return False
        p, q = shared[x], shared[y]
        if p != q:
            return p > q
        n = common_prefix(a, b, p)
        first = a[n : n + 1] < b[n : n + 1] if n < len(a) and n < len(b) else len(a) < len(b) or len(a) == len(b) and x < y
        shared[y if first else x] = n
        return first

    def build(node: int) -> int:
        if node >= k:
            return node - k
        x, y = build(2 * node), build(2 * node + 1)
        if beats(x, y):
            loser[node] = y
            return x
        loser[node] = x
        return y

    winner = build(1)
    out, lcps = [], []
    while current[winner] is not None:
        out.append(winner)
        lcps.append(shared[winner])
        strings, prefixes = runs[winner]
        at[winner] += 1
        if at[winner] < len(strings):
            current[winner], shared[winner] = strings[at[winner]], prefixes[at[winner]]
        else:
            current[winner] = None
        node = (winner + k) // 2
        while node:
            other = loser[node]
            b = current[other]
            if b is not None:
                a = current[winner]
                if a is None:
                    loser[node], winner = winner, other
                else:
                    p, q = shared[winner], shared[other]
                    if p < q or p == q and not beats(winner, other):
                        loser[node], winner = winner, other
            node //= 2
    return out, lcps


def decode(row: list) -> tuple:
    """A run's strings, common prefixes, lefts and arrays."""
    doc_ids, dkeys = np.frombuffer(row[0], np.int64), np.frombuffer(row[1], np.int64)
    doc, place, nearest = np.frombuffer(row[2], np.uint32), np.frombuffer(row[3], np.int64), np.frombuffer(row[4], np.uint8)
    lcp, lens, rest = list(row[5]), list(row[6]), row[7]
    strings, before, at = [], b"", 0
    for p, n in zip(lcp, lens):
        before = before[:p] + rest[at : at + n - p]
        at += n - p
        strings.append(before)
    return strings, lcp, doc_ids[doc], dkeys[doc], place, nearest.astype(np.int64), np.frombuffer(row[8], np.uint8), np.frombuffer(row[9], np.uint8)


def left_order(lens: np.ndarray, raw: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of the reversed left sides, and common prefixes along it."""
    n = len(lens)
    padded = np.zeros((n, width), np.uint8)
    ends = np.cumsum(lens.astype(np.int64))
    row = np.repeat(np.arange(n), lens)
    column = ends[row] - 1 - np.arange(len(raw))
    padded[row, column] = raw
    words = padded.view(">u8").astype(np.uint64)
    order = np.lexsort(words.T[::-1])
    same = padded[order][1:] == padded[order][:-1]
    prefix = np.where(same.all(axis=1), width, same.argmin(axis=1))
    return order, np.append(0, prefix)


def repeats(rows: list[list], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(doc_id, dkey, start, end) of ranges of repeated bytes in a share, from its runs."""
    decoded = [decode(r) for r in rows]
    source, lcp = loser_tree([(d[0], d[1]) for d in decoded])
    source = np.array(source, np.int64)
    n = len(source)
    base = np.cumsum([0, *(len(d[0]) for d in decoded)])[:-1]
    order = np.empty(n, np.int64)  # merged order -> number in the concatenated runs
    by_run = np.argsort(source, kind="stable")
    order[by_run] = np.arange(n)
    doc_id, dkey, place, nearest = (np.concatenate([d[i] for d in decoded]) for i in range(2, 6))
    left_len = np.concatenate([d[6] for d in decoded])
    width = -(-(length - GRAM + 1) // 8) * 8
    order_left, lcp_left = left_order(left_len, np.concatenate([d[7] for d in decoded]), width)
    rank = np.empty(n, np.int64)
    rank[np.lexsort((place, dkey, doc_id))] = np.arange(n)
    farthest = left_len.astype(np.int64)
    lcp = np.array(lcp, np.int64)
    hits_item, hits_back = [], []
    right_class, left_class = np.empty(n, np.int64), np.empty(n, np.int64)
    for back in range(length - GRAM + 1):
        valid = np.flatnonzero((nearest <= back) & (back <= farthest))
        if len(valid) < 2:
            continue
        right_class[order] = np.cumsum(lcp < length - back)
        left_class[order_left] = np.cumsum(lcp_left < back)
        pair = right_class[valid] * (n + 1) + left_class[valid]
        by = np.lexsort((rank[valid], pair))
        pair = pair[by]
        again = valid[by][1:][pair[1:] == pair[:-1]]
        if len(again):
            hits_item.append(again.astype(np.int32))
            hits_back.append(np.full(len(again), back, np.int16))
    out = [], [], [], []
    if hits_item:
        item, back = np.concatenate(hits_item), np.concatenate(hits_back)
        by = np.lexsort((-back, item))
        item, back = item[by], back[by]
        start = place[item] - back
        new = np.append(True, (item[1:] != item[:-1]) | (start[1:] != start[:-1] + 1))[: len(item)]
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(item)) - 1
        out[0].append(doc_id[item[first]])
        out[1].append(dkey[item[first]])
        out[2].append(start[first])
        out[3].append(start[last] + length)
    for r in rows:
        known = np.frombuffer(r[10], np.int64).reshape(-1, 3)
        if len(known):
            out[0].append(np.frombuffer(r[0], np.int64)[known[:, 0]])
            out[1].append(np.frombuffer(r[1], np.int64)[known[:, 0]])
            out[2].append(known[:, 1])
            out[3].append(known[:, 2])
    return tuple(np.concatenate(x) if x else np.zeros(0, np.int64) for x in out)


def repeated_ranges(docs: DataFrame, length: int = 100, hot: int = HOT) -> DataFrame:
    """(doc_id, dkey, start, end): ranges of repeated bytes; they may overlap."""
    parts = shuffle_partitions(docs.sparkSession)
    shares = SHARES * parts
    found = materialise(repeated_anchors(docs, length, parts, hot), "anchors")
    runs = suffix_runs(docs, found.where("not hot").drop("hot"), length, shares, hot_grams(found))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in grouped(batches):
            yield pa.record_batch([pa.array(x) for x in repeats(rows, length)], names=["doc_id", "dkey", "start", "end"])

    merged = runs.repartition(parts, "share").sortWithinPartitions("share").mapInArrow(merge, "doc_id long, dkey long, start long, end long")
    return materialise(merged, "ranges")


COLUMNS = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def union(pairs: np.ndarray) -> np.ndarray:
    """Maximal runs covered by (start, end) rows."""
    if not len(pairs):
        return pairs.reshape(0, 2)
    pairs = pairs[np.argsort(pairs[:, 0], kind="stable")]
    reach = np.maximum.accumulate(pairs[:, 1])
    new = np.append(True, pairs[1:, 0] > reach[:-1])
    first = np.flatnonzero(new)
    return np.stack([pairs[first, 0], reach[np.append(first[1:], len(pairs)) - 1]], 1)


def remove(docs: DataFrame, length: int = 100, keep_text: bool = False, hot: int = HOT) -> DataFrame:
    """``COLUMNS`` for every row of ``docs`` (doc_id, text), and what is kept as ``kept`` binary if asked for."""
    if length <= GRAM or length > 255:
        raise ValueError(f"the length must be over {GRAM} and under 256")
    prepare(docs.sparkSession)
    source = keyed(docs)
    spans = F.collect_list(F.struct(F.col("start"), F.col("end"))).alias("spans")
    found = repeated_ranges(source, length, hot).groupBy("doc_id", "dkey").agg(spans)
    joined = source.join(found, ["doc_id", "dkey"], "left").select("doc_id", "text", F.col("spans.start").alias("start"), F.col("spans.end").alias("end"))
    names = [x.split()[0] for x in COLUMNS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, off in tb.slices(batches, "text", SLICE):
            out: list[list] = [[], [], [], [], [], []]
            columns = [batch.column(i).to_pylist() for i in (0, 2, 3)]
            raw = data.tobytes()
            for i, (doc_id, start, end) in enumerate(zip(*columns, strict=True)):
                own = raw[off[i] : off[i + 1]]
                runs = union(np.array([start or [], end or []], np.int64).T).tolist()
                kept, at = [], 0
                for a, b in runs:
                    kept.append(own[at:a])
                    at = b
                rest = b"".join([*kept, own[at:]])
                values = (None if doc_id == NO_ID else doc_id, len(own), len(own) - len(rest), len(runs), hashlib.sha256(rest).hexdigest(), rest if keep_text else None)
                for column, v in zip(out, values, strict=True):
                    column.append(v)
            types = [*[pa.int64()] * 4, pa.large_string(), pa.large_binary()][: 5 + keep_text]
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, types)], names=[*names, "kept"][: len(types)])

    return joined.mapInArrow(run, COLUMNS + ", kept binary" * keep_text)
