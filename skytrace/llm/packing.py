"""Bounded-space online packing of token sequences.

Each partition keeps at most ``open_windows`` windows open.  A document is cut
into full windows and a remainder; the remainder goes to the open window that it
fits best.  When it fits none, the fullest window is emitted - its gap first
filled with a cut of the remainder where both parts stay at least ``min_piece``
tokens long - and a new one is opened.  What is still open at the end of the
partitions (at most ``open_windows`` windows each) is merged level by level,
``FAN_IN`` partitions at a time, by the same rule, until one group is left.

Only piece descriptors move: texts are read, tokenised and checksummed in the
scan.  The descriptors are written to the shared folder before they are read
twice, so a lost executor can't change a packing that has begun.

Defined cases: a null or empty text is its end mark alone; documents longer than
a window span several; repeated rows are packed each for itself.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skytrace.llm.common import materialise, prepare
from skytrace.llm.textbatch import slices

FAN_IN = 32
SPECIAL = "<|endoftext|>"


@dataclass(frozen=True)
class PackParams:
    capacity: int = 2048
    open_windows: int = 8
    min_piece: int = 16
    end_id: int = 1


@dataclass
class Window:
    room: int
    pieces: list[tuple] = field(default_factory=list)


class BestFit:
    """A bounded set of open windows; a piece is (doc_id, start, length, crc or ids, doc_tokens)."""

    def __init__(self, params: PackParams):
        self.p, self.open = params, []

    def add(self, piece: tuple) -> Iterator[Window]:
        """Place a piece shorter than a window, cut if need be; yields windows that are done."""
        while True:
            size = piece[2]
            fits = [w for w in self.open if w.room >= size]
            if fits:
                best = min(fits, key=lambda w: w.room)
                self._put(best, piece)
                if best.room == 0:
                    self.open.remove(best)
                    yield best
                return
            if len(self.open) < self.p.open_windows:
                self.open.append(Window(self.p.capacity - size, [piece]))
                return
            fullest = min(self.open, key=lambda w: w.room)
            if fullest.room >= self.p.min_piece and size - fullest.room >= self.p.min_piece:
                head, piece = cut(piece, fullest.room)
                self._put(fullest, head)
            self.open.remove(fullest)
            yield fullest

    def add_window(self, window: Window) -> Iterator[Window]:
        """Place a partly filled window as one block."""
        size = self.p.capacity - window.room
        fits = [w for w in self.open if w.room >= size]
        if fits:
            best = min(fits, key=lambda w: w.room)
            best.room -= size
            best.pieces += window.pieces
            if best.room == 0:
                self.open.remove(best)
                yield best
            return
        if len(self.open) >= self.p.open_windows:
            fullest = min(self.open, key=lambda w: w.room)
            self.open.remove(fullest)
            yield fullest
        self.open.append(window)

    def _put(self, window: Window, piece: tuple) -> None:
        window.room -= piece[2]
        window.pieces.append(piece)


def cut(piece: tuple, at: int) -> tuple[tuple, tuple]:
    doc, start, length, ids, total = piece
    return (doc, start, at, ids[:at], total), (doc, start + at, length - at, ids[at:], total)


_encoders: dict[str, tuple] = {}


def byte_of_char() -> dict[str, int]:
    """The printable stand-ins that byte-level BPE vocabularies use for bytes."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {chr(b): b for b in printable}
    return out | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in set(printable))}


def plain_ranks(file: dict) -> dict[bytes, int] | None:
    """Ranks of a vocabulary file's byte strings if nothing but byte-level BPE in the order of its ids is asked for; else None.

    Checked: no normalizer; byte-level pre-tokens by the usual pattern, without a
    space put before; no dropout, unknown token, affix or byte fallback; every
    string of several bytes is what one merge makes, ids rise with the merges, and
    under them the string's own bytes merge by that merge last.
    """
    model, before = file["model"], file["pre_tokenizer"] or {}
    odd = model.get("dropout") or model.get("unk_token") or model.get("continuing_subword_prefix") or model.get("end_of_word_suffix") or model.get("byte_fallback") or model.get("ignore_merges")
    if file["normalizer"] or odd or before.get("type") != "ByteLevel" or before.get("add_prefix_space") or not before.get("use_regex", True):
        return None
    special = {t["content"] for t in file["added_tokens"]}
    if special != {SPECIAL}:
        return None
    of_char = byte_of_char()
    try:
        ranks = {bytes(of_char[c] for c in token): i for token, i in model["vocab"].items() if token not in special}
    except KeyError:
        return None
    pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    made = [model["vocab"].get(a + b, -1) for a, b in pairs]
    if any(x >= y for x, y in zip(made, made[1:])) or made[:1] == [-1] or len(made) + 256 != len(ranks) or any(bytes([b]) not in ranks for b in range(256)):
        return None
    for (a, b), rank in zip(pairs, made):
        parts = [bytes([x]) for c in a + b for x in [of_char[c]]]
        while len(parts) > 2:
            at = min((r, i) for i in range(len(parts) - 1) if (r := ranks.get(parts[i] + parts[i + 1], rank)) < rank or i == 0)[1]
            if ranks.get(parts[at] + parts[at + 1], rank) >= rank:
                return None
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        if parts != [bytes(of_char[c] for c in x) for x in (a, b)]:
            return None
    return ranks


def encoder(path: str) -> tuple:
    """(fast, exact): both give the ids of the vocabulary at ``path`` (``tokenizers`` format); fast is None unless ``plain_ranks`` allows it."""
    if path not in _encoders:
        import json

        import tiktoken
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            ranks = plain_ranks(json.load(f))
        pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
        fast = tiktoken.Encoding("bytes", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}) if ranks else None
        _encoders[path] = (fast, Tokenizer.from_file(path))
    return _encoders[path]


def encode(text: str, path: str) -> np.ndarray:
    """Ids of ``text`` without added special tokens; the vocabulary's special string, if inside, is its own id."""
    fast, exact = encoder(path)
    if fast is None or SPECIAL in text:
        return np.array(exact.encode(text, add_special_tokens=False).ids, "<u4")
    return np.array(fast.encode_ordinary(text), "<u4")


PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, part long, done boolean"
FIELDS = [x.split()[0] for x in PIECE.split(", ")]
#: A sequence id is its level, the group that emitted it and its number there.
LEVEL_BIT, PART_BIT = 56, 28


def _rows(windows: list[Window], first_id: int, part: int, done: bool) -> pa.RecordBatch:
    out: list[list] = [[] for _ in FIELDS]
    for number, w in enumerate(windows):
        offset = 0
        for doc, start, length, crc, total in w.pieces:
            for column, value in zip(out, (doc, start, length, crc, total, first_id + number, offset, part, done), strict=True):
                column.append(value)
            offset += length
    types = [pa.int64()] * 8 + [pa.bool_()]
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, types, strict=True)], names=FIELDS)


def _summed(windows: list[Window]) -> list[Window]:
    """Checksums in place of ids: only a piece that comes in is ever cut."""
    for w in windows:
        w.pieces = [(d, s, n, zlib.crc32(ids.tobytes()) if isinstance(ids, np.ndarray) else ids, t) for d, s, n, ids, t in w.pieces]
    return windows


def pack(docs: DataFrame, path: str, params: PackParams = PackParams()) -> DataFrame:
    """Pieces: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    ``sequence_id`` tells sequences apart; the numbers are not dense.
    """
    prepare(docs.sparkSession)
    capacity = params.capacity

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, packer = TaskContext.get().partitionId(), BestFit(params)
        next_id = part << PART_BIT
        for batch, _, _ in slices(batches, "text", 4 << 20):
            ready: list[Window] = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = np.append(encode(text or "", path), np.uint32(params.end_id)).astype("<u4")
                n = len(ids)
                whole = n - n % capacity
                ready += [Window(0, [(doc, s, capacity, ids[s : s + capacity], n)]) for s in range(0, whole, capacity)]
                if whole < n:
                    ready += packer.add((doc, whole, n - whole, ids[whole:], n))
            _summed(packer.open)
            if ready:
                yield _rows(_summed(ready), next_id, part, True)
                next_id += len(ready)
        if packer.open:
            yield _rows(packer.open, next_id, part, False)

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    pieces = materialise(source.mapInArrow(scan, PIECE), "pack-pieces")
    groups, level = (pieces.agg(F.max("part")).first()[0] or 0) + 1, 0
    done, rest = [pieces.where("done")], pieces.where("not done")
    while True:
        level, groups = level + 1, -(-groups // FAN_IN)
        grouped = rest.withColumn("part", F.floor(F.col("part") / FAN_IN).cast("long")).groupBy("part")
        merged = grouped.applyInArrow(_merger(params, level, groups <= 1), PIECE)
        if groups <= 1:
            done.append(merged)
            break
        merged = materialise(merged, "pack-merge")
        done.append(merged.where("done"))
        rest = merged.where("not done")
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out.drop("part", "done")


def _merger(params: PackParams, level: int, last: bool):
    """Merges the open windows of a group: at most FAN_IN * open_windows of them, each a block."""

    def run(group: pa.Table) -> pa.Table:
        part = group.column("part")[0].as_py()
        windows: dict[int, Window] = {}
        for r in sorted(group.to_pylist(), key=lambda r: (r["sequence_id"], r["offset"])):
            w = windows.setdefault(r["sequence_id"], Window(params.capacity))
            w.pieces.append((r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]))
            w.room -= r["length"]
        packer, ready = BestFit(params), []
        for w in sorted(windows.values(), key=lambda w: w.room):
            ready += packer.add_window(w)
        if last:
            ready += packer.open
            packer.open = []
        first = (level << LEVEL_BIT) | (part << PART_BIT)
        return pa.Table.from_batches([_rows(ready, first, part, True), _rows(packer.open, first + len(ready), part, False)])

    return run
