"""Token counts of a BPE piece model by rank-synchronous merging of ragged arrays.

Spaces become the word mark, and a text is cut before every run of marks: no
piece of the model holds a mark after another character, so no merge crosses a
cut (checked when the model is loaded).  The distinct pre-tokens of a batch form
one ragged array of symbols.  In each round every sequence finds its best pair
(lowest rank, leftmost) and all sequences merge theirs at once, until none has a
pair left; the surviving symbols are the tokens.  A character that the model
lacks counts as its UTF-8 bytes (byte fallback).  Pre-tokens longer than
``LONG`` symbols, where one merge a round would be slow, use a heap that takes
the same merges in the same order.

Defined cases: a null or empty text has no tokens; special strings inside a text
are plain text; texts are never cut short; extra columns stay.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from skytrace.llm.common import prepare, with_columns
from skytrace.llm.textbatch import slices

MARK = "▁"
LONG = 192
#: Distinct pre-tokens whose counts a worker remembers; then it starts anew.
REMEMBER = 400_000
RUNS = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")
NO_RANK = np.iinfo(np.int64).max


class PieceModel:
    """Symbols, and the rank and result of each pair that may merge."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        size = sp.get_piece_size()
        pieces = {sp.id_to_piece(i): i for i in range(size) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))}
        self.byte_fallback = any(sp.is_byte(i) for i in range(size))
        if any(MARK in p.lstrip(MARK) for p in pieces):
            raise ValueError("the model has pieces across word marks")
        self.single = {p: i for p, i in pieces.items() if len(p) == 1}
        extra = sorted({c for p in pieces for c in p} - self.single.keys())
        self.parts = dict(self.single) | {c: size + k for k, c in enumerate(extra)}
        ids = dict(pieces) | {c: i for c, i in self.parts.items() if c not in pieces}
        self.lost = set(extra)
        scores = sorted({-sp.get_score(i) for i in pieces.values()})
        rank_of = {s: r for r, s in enumerate(scores)}
        table: dict[int, tuple[int, int]] = {}
        self.base = size + len(extra) + 1
        for p, i in pieces.items():
            for cut in range(1, len(p)):
                a, b = ids.get(p[:cut]), ids.get(p[cut:])
                if a is not None and b is not None:
                    table[a * self.base + b] = (rank_of[-sp.get_score(i)], i)
        keys = np.array(sorted(table), np.int64)
        self.keys = np.append(keys, NO_RANK)
        self.ranks = np.array([table[k][0] for k in keys.tolist()] + [NO_RANK], np.int64)
        self.merged = np.array([table[k][1] for k in keys.tolist()] + [0], np.int64)
        self.table = table
        self.id_of_point = np.full(0x110000, self.base - 1, np.int64)
        self.more_of_point = np.zeros(0x110000, np.int64)
        if self.byte_fallback:
            self.more_of_point[0x80:], self.more_of_point[0x800:], self.more_of_point[0x10000:] = 1, 2, 3
        for c, i in self.parts.items():
            self.id_of_point[ord(c)] = i
            if c not in self.lost:
                self.more_of_point[ord(c)] = 0
        inside = {c for p in pieces if len(p) > 1 for c in p}
        #: White space that no merge touches and that is one token: a text may be cut on both sides of it.
        self.alone_in_text = {c for c in "\n\t\r" if c not in inside}

    def symbols(self, tokens: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all characters in a row, lengths, and what byte fallback adds to each pre-token."""
        lens = np.fromiter(map(len, tokens), np.int64, len(tokens))
        points = np.frombuffer("".join(tokens).encode("utf-32-le", "surrogatepass"), "<u4")
        ids = self.id_of_point[points]
        total = np.zeros(len(ids) + 1, np.int64)
        np.cumsum(self.more_of_point[points], out=total[1:])
        ends = np.cumsum(lens)
        return ids, lens, total[ends] - total[ends - lens]

    def find(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        pair = left * self.base + right
        at = np.searchsorted(self.keys, pair)
        hit = self.keys[at] == pair
        return np.where(hit, self.ranks[at], NO_RANK), self.merged[at]

    def count(self, tokens: list[str]) -> np.ndarray:
        """How many pieces each pre-token gives."""
        ids, lens, out = self.symbols(tokens)
        long = lens > LONG
        if long.any():
            first = np.cumsum(lens) - lens
            for k in np.flatnonzero(long).tolist():
                out[k] += self.count_long(ids[first[k] : first[k] + lens[k]].tolist())
            ids = ids[np.repeat(~long, lens)]
        rows = np.flatnonzero(~long & (lens > 0))
        out[rows] += self.merge(ids, lens[rows])
        return out

    def merge(self, ids: np.ndarray, lens: np.ndarray) -> np.ndarray:
        """Symbols left in each sequence of a ragged array once no pair can merge."""
        out = lens.copy()
        live = np.arange(len(lens))
        if not len(live):
            return out
        ids, lens = ids.copy(), lens.copy()
        rank = np.full(len(ids), NO_RANK, np.int64)  # of the pair that starts at each symbol
        merged = np.zeros(len(ids), np.int64)
        rank[:-1], merged[:-1] = self.find(ids[:-1], ids[1:])
        rank[np.cumsum(lens) - 1] = NO_RANK  # that pair would reach into the next sequence
        while True:
            best = np.minimum.reduceat(rank, np.cumsum(lens) - lens)
            go = best < NO_RANK
            if not go.all():
                out[live] = lens
                keep = np.repeat(go, lens)
                ids, rank, merged = ids[keep], rank[keep], merged[keep]
                live, lens, best = live[go], lens[go], best[go]
                if not len(live):
                    return out
            where = np.flatnonzero(rank == np.repeat(best, lens))
            first = np.cumsum(lens) - lens
            owner = np.searchsorted(first, where, "right") - 1
            at = where[np.append(True, owner[1:] != owner[:-1])]
            ids[at] = merged[at]
            keep = np.ones(len(ids), bool)
            keep[at + 1] = False
            rank[at] = rank[at + 1]  # NO_RANK stays at a sequence's end
            ids, rank, merged = ids[keep], rank[keep], merged[keep]
            at -= np.arange(len(at))
            lens -= 1
            first = np.cumsum(lens) - lens
            right = at[at < first + lens - 1]
            rank[right], merged[right] = self.find(ids[right], ids[right + 1])
            left = at[at > first] - 1
            rank[left], merged[left] = self.find(ids[left], ids[left + 1])

    def count_long(self, ids: list[int]) -> int:
        """The same merges for one long sequence: best rank first, leftmost among equals."""
        n = len(ids)
        ids = list(ids)
        after = [*range(1, n), -1]
        before = [-1, *range(n - 1)]
        heap: list[tuple[int, int, int, int]] = []
        table, base = self.table, self.base

        def push(i: int) -> None:
            j = after[i]
            if j >= 0 and (hit := table.get(ids[i] * base + ids[j])):
                heapq.heappush(heap, (hit[0], i, ids[i], ids[j]))

        for i in range(n - 1):
            push(i)
        left = n
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j < 0 or ids[j] != b:
                continue
            ids[i] = table[a * base + b][1]
            ids[j] = -1
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            left -= 1
            push(i)
            if before[i] >= 0:
                push(before[i])
        return left


_models: dict[str, PieceModel] = {}
_known: dict[str, dict[str, int]] = {}


def count_texts(texts: list[str], path: str) -> list[int]:
    """Tokens of each text under the model at ``path``."""
    if path not in _models:
        _models[path] = PieceModel(path)
    model, known = _models[path], _known.setdefault(path, {})
    if len(known) > REMEMBER:
        known.clear()
    split = []
    extra = []
    for text in texts:
        cuts = [c for c in "\n\t\r" if c in model.alone_in_text and c in text]
        extra.append(sum(map(text.count, cuts)))
        split.append(_pretokens((MARK + text.replace(" ", MARK)) if text else "", cuts))
    fresh = list({t for tokens in split for t in tokens if t not in known})
    if fresh:
        known.update(zip(fresh, model.count(fresh).tolist(), strict=True))
    get = known.__getitem__
    return [more + sum(map(get, tokens)) for more, tokens in zip(extra, split, strict=True)]


def _pretokens(marked: str, cuts: list[str]) -> list[str]:
    """Runs of marks with what follows them, apart from the characters in ``cuts``."""
    segments = re.split("[" + "".join(cuts) + "]+", marked) if cuts else [marked]
    out = []
    for segment in segments:
        if MARK + MARK in segment or segment.endswith(MARK):
            out += RUNS.findall(segment)
        elif segment:
            head, *parts = segment.split(MARK)
            if head:
                out.append(head)
            out += [MARK + p for p in parts]
    return out


COLUMNS = "n_bytes long, n_tokens long, over_limit boolean"
NAMES = [x.split()[0] for x in COLUMNS.split(", ")]


def count_tokens(docs: DataFrame, path: str, limit: int = 4096) -> DataFrame:
    """``docs`` (any columns, with ``text``) plus ``COLUMNS``; input columns of these names are replaced."""
    prepare(docs.sparkSession)
    rest = docs.drop(*NAMES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, _, off in slices(batches, "text", 4 << 20):
            texts = [x or "" for x in batch.column(batch.schema.get_field_index("text")).to_pylist()]
            n = np.array(count_texts(texts, path), np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.diff(off)), pa.array(n), pa.array(n > limit)], names=[*batch.schema.names, *NAMES])

    return with_columns(rest, run, COLUMNS)
