"""Document fingerprints: weighted SimHash of 128 bits and a permuted-block search.

Terms are the five-word shingles of the lower-cased (A-Z) text, repeats
included, with weight 2, and the words of seven bytes or more with weight 1;
a text of one to four words has all of them as its only shingle.  Each term's
hash votes its weight for or against each bit.  No terms: all bits are zero.

The search cuts fingerprints into radius + 1 blocks and permutes each block to
the front in its own table; fingerprints within the radius share a leading block
in at least one.  A pair is counted only in the first table it shares.  A shard
of a table is compared by array operations, never as emitted pairs; large
buckets are split by further blocks (see ``hamming``).

Defined cases: a null text is empty; equal texts have equal fingerprints; rows
that share a ``doc_id`` are ordered by text hash; a null ``doc_id`` comes last;
a table of one row is its own next document; extra columns are not carried.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skytrace.llm import textbatch as tb
from skytrace.llm.common import materialise, prepare, shuffle_partitions, slots
from skytrace.llm.hamming import STORED, Tables, dealt, segments
from skytrace.llm.neardup import bit_sums, pack_bits


@dataclass(frozen=True)
class SimHashParams:
    shingle: int = 5
    shingle_weight: float = 2.0
    long_word: int = 7
    word_weight: float = 1.0
    radius: int = 3
    shard_rows: int = 2048


def simhash(data: np.ndarray, off: np.ndarray, params: SimHashParams = SimHashParams()) -> tuple[np.ndarray, np.ndarray]:
    """High and low halves of each text's fingerprint."""
    low = tb.LOWER[data]
    starts, ends, first = tb.words(low, off)
    rows = len(off) - 1
    hashes = tb.hash_spans(low, starts, ends - starts, seed=5)
    grams, gram_row, _ = tb.ngrams(hashes, first, params.shingle)
    count = np.diff(first)
    few = np.flatnonzero((count > 0) & (count < params.shingle))
    if len(few):
        whole = np.zeros(len(few), np.uint64)
        for k in range(params.shingle - 1):
            has = count[few] > k
            whole[has] = tb.mix(whole[has] * tb.M1 + hashes[first[:-1][few[has]] + k])
        grams, gram_row = np.concatenate([grams, whole]), np.concatenate([gram_row, few])
    long = np.flatnonzero(ends - starts >= params.long_word)
    word_row = np.repeat(np.arange(rows), count)[long]
    terms = np.concatenate([grams, hashes[long]])
    row = np.concatenate([gram_row, word_row])
    weight = np.concatenate([np.full(len(grams), params.shingle_weight), np.full(len(long), params.word_weight)])
    order = np.argsort(row, kind="stable")
    terms, row, weight = terms[order], row[order], weight[order]
    total = np.bincount(row, weight, minlength=rows)[:, None]
    halves = (pack_bits(2 * bit_sums(tb.mix(terms + np.uint64(salt)), row, rows, weight) > total) for salt in (1, 2))
    high, lo = halves
    return high, lo


def likeness(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Share of equal bits."""
    return 1 - (np.bitwise_count(a[0] ^ b[0]).astype(float) + np.bitwise_count(a[1] ^ b[1])) / 128


def _of_texts(texts: list[str], params: SimHashParams) -> tuple[np.ndarray, np.ndarray]:
    return simhash(*tb.utf8(pa.array(texts, pa.large_string())), params)


EDITED = "doc_id long, n_chars long, edited_sha256 string, high long, low long, edited_high long, edited_low long, near_edited double, near_next double"
#: Bytes of text in hand at a time, and its own text at least.
CHUNK = 4 << 20
NO_ID = (1 << 63) - 1
WORD = (1 << 64) - 1


def _order(ids: np.ndarray, missing: np.ndarray) -> np.ndarray:
    """Numbers that rise as ids fall; a missing id comes last."""
    return np.where(missing, np.iinfo(np.int64).max, ~ids)


def order_keys(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """A row's place in the order, from (doc_id, hash): by id, then by hash."""
    ids = batch.column(0)
    return _order(np.asarray(ids.fill_null(0)), np.asarray(ids.is_null())), np.asarray(batch.column(1))


def ranges(keys: tuple[np.ndarray, np.ndarray], cuts: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """How many of the cuts, which are in order, stand at or before each key."""
    out = np.searchsorted(cuts[0], keys[0], "left")
    last = np.searchsorted(cuts[0], keys[0], "right")
    for i in np.flatnonzero(last > out).tolist():  # cuts with the same id
        out[i] += np.searchsorted(cuts[1][out[i] : last[i]], keys[1][i], "right")
    return out


def edited_fingerprints(docs: DataFrame, params: SimHashParams = SimHashParams()) -> DataFrame:
    """Fingerprints of each text and of its edited text (see ``EDITED``).

    The edit takes its tail from the next document in descending ``doc_id``.
    Texts are range-partitioned once, by id and then text hash, with cuts from an
    evenly hashed sample of the keys (64 a range); each range also gets a copy of
    the first document of the range after it, so every neighbour is at hand.
    """
    spark = docs.sparkSession
    prepare(spark)
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).withColumn("hash", F.xxhash64("text"))
    n = shuffle_partitions(spark)
    light = materialise(source.select("doc_id", "hash"), "order-keys")
    every = max(1, light.count() // (64 * n))
    sample = light.where(F.pmod(F.xxhash64("doc_id", "hash"), F.lit(every)) == 0).toArrow().combine_chunks()
    found = order_keys(sample.to_batches()[0]) if sample.num_rows else (np.zeros(0, np.int64),) * 2
    by = np.lexsort(found[::-1])
    picked = by[np.unique(np.arange(1, n) * len(by) // n)] if len(by) else by
    cuts = found[0][picked], found[1][picked]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = order_keys(batch)
            yield pa.record_batch([pa.array(ranges(keys, cuts)), *map(pa.array, keys)], names=["range", "o", "h"])

    heads = light.mapInArrow(place, "range long, o long, h long").groupBy("range").agg(F.min(F.struct("o", "h")).alias("k"))
    first = {r["range"]: (r["k"]["o"], r["k"]["h"]) for r in heads.collect()}  # one row a range
    used = sorted(first)
    before = {after: at for at, after in zip(used, used[1:] + used[:1])}
    slot = np.array(slots(spark, n), np.int64)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: set[int] = set()
        for batch in batches:
            keys = order_keys(pa.RecordBatch.from_arrays([batch.column(0), batch.column(2)], names=["doc_id", "hash"]))
            mine = ranges(keys, cuts)
            copies = []
            for r in np.unique(mine).tolist():
                top = np.flatnonzero((mine == r) & (keys[0] == first[r][0]) & (keys[1] == first[r][1]))
                if len(top) and r not in sent:
                    sent.add(r)
                    copies.append((int(top[0]), before[r]))
            extra = np.array([i for i, _ in copies], np.int64)
            rows = np.concatenate([np.arange(batch.num_rows), extra])
            to = np.concatenate([mine, np.array([r for _, r in copies], np.int64)])
            tail = np.append(np.zeros(batch.num_rows, bool), np.ones(len(extra), bool))
            taken = batch.take(pa.array(rows)) if len(extra) else batch
            yield pa.RecordBatch.from_arrays([*taken.columns[:2], pa.array(slot[to % n]), pa.array(to), pa.array(tail), pa.array(keys[0][rows]), pa.array(keys[1][rows])], names=["doc_id", "text", "slot", "range", "tail", "o", "h"])

    dealt = source.select("doc_id", "text", "hash").mapInArrow(deal, "doc_id long, text string, slot long, range long, tail boolean, o long, h long")
    ordered = dealt.repartition(n, "slot").sortWithinPartitions("range", "tail", "o", "h").select("doc_id", "text", "range", "tail")

    def emit(ids: list, texts: list[str]) -> pa.RecordBatch:
        """All rows but the last, which is only the neighbour of the one before it."""
        edited, shas = [], []
        for text, after in zip(texts, texts[1:]):
            half = len(text) // 2
            edited.append(text[: len(text) - half] + after[:half])
            shas.append(hashlib.sha256(edited[-1].encode("utf-8", "surrogatepass")).hexdigest())
        own, changed = _of_texts(texts, params), _of_texts(edited, params)
        mine, after = (own[0][:-1], own[1][:-1]), (own[0][1:], own[1][1:])
        numbers = [x.view(np.int64) for x in (*mine, *changed)]
        values = [ids[:-1], [len(t) for t in texts[:-1]], shas, *numbers, likeness(mine, changed), likeness(mine, after)]
        types = [pa.int64(), pa.int64(), pa.large_string(), *[pa.int64()] * 4, pa.float64(), pa.float64()]
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, types, strict=True)], names=[x.split()[0] for x in EDITED.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list = []
        texts: list[str] = []
        held, in_tail = 0, False
        for batch in batches:
            for doc, text, tail in zip(*(batch.column(i).to_pylist() for i in (0, 1, 3)), strict=True):
                if tail and in_tail:
                    continue  # only the first row of the range after counts
                in_tail = bool(tail)
                ids.append(doc)
                texts.append(text)
                held += len(text)
                if tail or held >= CHUNK:
                    if len(ids) > 1:
                        yield emit(ids, texts)
                    ids, texts = ([], []) if tail else (ids[-1:], texts[-1:])
                    held = sum(map(len, texts))

    return ordered.mapInArrow(run, EDITED)


def near_counts(fps: DataFrame, params: SimHashParams = SimHashParams()) -> DataFrame:
    """(high, low, n_near, near_doc_id) of each distinct fingerprint that has others within the radius.

    ``n_near`` counts them, and ``near_doc_id`` is the smallest ``doc_id`` that carries one of them.
    """
    tables = Tables(128, params.radius)
    rows = fps.groupBy("high", "low").agg(F.coalesce(F.min("doc_id"), F.lit(NO_ID)).alias("rep"))

    def compare(table: int, a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
        """Which of ``a`` and ``b`` (low and high halves) are near and don't meet in an earlier table."""
        x = [p[:, None] ^ q[None, :] for p, q in zip(a, b)]
        near = np.bitwise_count(x[0]) + np.bitwise_count(x[1]) <= params.radius
        for mask in tables.earlier(table):
            near &= (x[0] & np.uint64(mask & WORD) | x[1] & np.uint64(mask >> 64)) != 0
        return near

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nothing = np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
        key, stored, seen, best = None, nothing, np.zeros(0, np.int64), np.zeros(0, np.int64)

        def found(parts: tuple, n: np.ndarray, rep: np.ndarray) -> Iterator[pa.RecordBatch]:
            if (hit := n > 0).any():
                yield pa.record_batch([pa.array(parts[1][hit].view(np.int64)), pa.array(parts[0][hit].view(np.int64)), pa.array(n[hit]), pa.array(rep[hit])], names=["high", "low", "n", "near"])

        for now, role, (low, high, rep) in segments(batches, 3):
            if now != key:
                yield from found(stored, seen, best)
                key, stored, seen, best = now, nothing, np.zeros(0, np.int64), np.zeros(0, np.int64)
            mine = np.ascontiguousarray(low).view(np.uint64), np.ascontiguousarray(high).view(np.uint64), rep
            for s in range(0, len(rep), 256):
                cut = tuple(p[s : s + 256] for p in mine)
                n, least = np.zeros(len(cut[2]), np.int64), np.full(len(cut[2]), NO_ID)
                if len(stored[2]):
                    near = compare(now[0], cut[:2], stored[:2])
                    n += near.sum(axis=1)
                    seen += near.sum(axis=0)
                    np.minimum(least, np.where(near, stored[2][None, :], NO_ID).min(axis=1), out=least)
                    np.minimum(best, np.where(near, cut[2][:, None], NO_ID).min(axis=0), out=best)
                if role == STORED:
                    near = compare(now[0], cut[:2], cut[:2])
                    np.fill_diagonal(near, False)
                    n += near.sum(axis=1)
                    np.minimum(least, np.where(near, cut[2][None, :], NO_ID).min(axis=1), out=least)
                    stored = tuple(np.concatenate([p, q]) for p, q in zip(stored, cut))
                    seen, best = np.concatenate([seen, n]), np.concatenate([best, least])
                else:
                    yield from found(cut, n, least)
        yield from found(stored, seen, best)

    pairs = dealt(rows, tables, ["low", "high"], params.shard_rows).mapInArrow(count, "high long, low long, n long, near long")
    least = F.min("near")
    return pairs.groupBy("high", "low").agg(F.sum("n").alias("n_near"), F.when(least < NO_ID, least).alias("near_doc_id"))


def fingerprint_documents(docs: DataFrame, params: SimHashParams = SimHashParams()) -> DataFrame:
    """``edited_fingerprints`` with hexadecimal fingerprints, and ``n_near`` and ``near_doc_id`` from the permuted tables."""
    rows = materialise(edited_fingerprints(docs, params), "fingerprints")
    near = near_counts(rows, params).select(F.col("high").alias("h"), F.col("low").alias("l"), "n_near", "near_doc_id")
    joined = rows.join(near, (F.col("high") == F.col("h")) & (F.col("low") == F.col("l")), "left")
    text = lambda a, b: F.lower(F.concat(F.lpad(F.hex(a), 16, "0"), F.lpad(F.hex(b), 16, "0")))
    return joined.select(
        "doc_id", "n_chars", "edited_sha256", text("high", "low").alias("fingerprint"), text("edited_high", "edited_low").alias("edited_fingerprint"), "near_edited", "near_next", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "near_doc_id"
    )
