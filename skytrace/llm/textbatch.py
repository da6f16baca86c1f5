"""Vectorised views of a column of texts: bytes, words and 64-bit hashes.

A batch of texts is one byte array plus offsets, exactly as Arrow stores it, so
words and n-grams of all its texts are found with array operations and no loop
over rows.  Words are the runs ``[^\\x20\\x09-\\x0D]+``; they never cross texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text handled at a time; a longer single text is handled alone.
SLICE_BYTES = 8 << 20

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LEAD = (np.arange(256) & 0xC0) != 0x80
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

M1, M2, M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64, n + 1, column.offset * 8)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[off[0] : off[-1]], off - off[0]


def slices(batches: Iterator[pa.RecordBatch], name: str, limit: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Each batch cut by rows so that a cut holds about ``limit`` bytes of text."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        data, off = utf8(batch.column(batch.schema.get_field_index(name)))
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(off, off[at] + limit, "right")) - 1)
            yield batch.slice(at, to - at), data[off[at] : off[to]], off[at : to + 1] - off[at]
            at = to


def runs(mask: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of maximal true runs that don't cross row offsets."""
    n = len(mask)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = mask[:-1]
    before[off[:-1][off[:-1] < n]] = False
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = mask[1:]
    last = off[1:] - 1
    after[last[last >= 0]] = False
    return np.flatnonzero(mask & ~before), np.flatnonzero(mask & ~after) + 1


def words(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends, and for each row the index of its first word (one more at the end)."""
    starts, ends = runs(~SPACE[data], off)
    return starts, ends, np.searchsorted(starts, off)


def per_row(values: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Sums of ``values`` between consecutive offsets."""
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=total[1:])
    return total[off[1:]] - total[off[:-1]]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser on 64-bit words."""
    x = (x ^ (x >> np.uint64(30))) * M2
    x = (x ^ (x >> np.uint64(27))) * M3
    return x ^ (x >> np.uint64(31))


def hash_spans(data: np.ndarray, starts: np.ndarray, lens: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit hashes of byte spans, eight bytes a round."""
    out = np.full(len(starts), np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & 0xFFFFFFFFFFFFFFFF))
    if len(starts) == 0:
        return out
    out ^= lens.astype(np.uint64) * M1
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[: len(data)] = data
    eight = np.ndarray((len(data) + 1,), "<u8", padded.data, strides=(1,))
    live = np.flatnonzero(lens > 0)
    done = 0
    while len(live):
        left = lens[live] - done
        chunk = eight[starts[live] + done].astype(np.uint64)
        short = left < 8
        if short.any():
            keep = (np.uint64(1) << (left[short].astype(np.uint64) * np.uint64(8))) - np.uint64(1)
            chunk[short] &= keep
        whole = len(live) == len(out)
        if whole:
            out = mix(out + chunk * M1) + M1
        else:
            out[live] = mix(out[live] + chunk * M1) + M1
        live = live[left > 8]
        done += 8
    return mix(out)


def ngrams(hashes: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of ``size`` consecutive words of a row, the row of each, and each row's count."""
    count = np.maximum(np.diff(first) - (size - 1), 0)
    row = np.repeat(np.arange(len(count)), count)
    begin = np.repeat(first[:-1] - (np.cumsum(count) - count), count) + np.arange(count.sum())
    out = np.zeros(len(begin), np.uint64)
    for k in range(size):
        out = mix(out * M1 + hashes[begin + k])
    return out, row, begin
