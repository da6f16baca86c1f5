"""Quality rules: base counts and distribution divergence from language references.

Two corpus-wide histograms describe each language: the share of each character
class, and the share of each of its most common short words.  A document's own
histograms are compared to them with the Jensen-Shannon distance (0 to 1).
Documents under ``min_words`` are never judged by divergence, as their
histograms are mostly noise, and for longer ones the distance that sampling
alone produces is allowed on top of the threshold.

References of the languages with most words are broadcast, ``broadcast_languages``
at most; rows of any further language are joined with theirs.  The verdict is the
same either way.

Defined cases: a null or empty text has no words and fails the base rule; a
null ``lang`` is a language of its own, and every language, however rare, has its
own reference; repeated rows are judged alike; extra columns stay.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from skytrace.llm import textbatch as tb
from skytrace.llm.common import extended, materialise, prepare, quoted, with_columns


@dataclass(frozen=True)
class QualityParams:
    min_words: int = 50
    max_repeat_percent: int = 50
    common_words: int = 64
    max_char_distance: float = 0.30
    max_word_distance: float = 0.42
    noise_allowance: float = 0.2
    #: References sent to the executors; rows of further languages are joined with theirs (layout only).
    broadcast_languages: int = 4096


LOWER_CASE, UPPER_CASE, DIGIT, BLANK, SENTENCE, SYMBOL, OTHER_ASCII, NON_ASCII = range(8)
N_CLASSES = 8
SKIP = 8  # continuation bytes

CLASS = np.full(256, OTHER_ASCII, np.uint8)
CLASS[[ord(c) for c in "abcdefghijklmnopqrstuvwxyz"]] = LOWER_CASE
CLASS[[ord(c) for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"]] = UPPER_CASE
CLASS[[ord(c) for c in "0123456789"]] = DIGIT
CLASS[tb.SPACE] = BLANK
CLASS[[ord(c) for c in ".,;:?'\"()-"]] = SENTENCE
CLASS[[ord(c) for c in "#*$%&|<>"]] = SYMBOL
CLASS[128:] = NON_ASCII
CLASS[128:192] = SKIP

IS_SYMBOL = CLASS == SYMBOL
#: Bytes cut from a word's end before it is looked up among the common words.
TRAILING = np.zeros(256, bool)
TRAILING[[ord(c) for c in ".,;:?!"]] = True


def short_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Words of up to 8 bytes as integers, lower-cased, one trailing mark cut; 0 for longer ones."""
    cut = TRAILING[data[ends - 1]] & (ends - starts > 1)
    lens = ends - starts - cut
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[: len(data)] = tb.LOWER[data]
    eight = np.ndarray((len(data) + 1,), "<u8", padded.data, strides=(1,))
    key = eight[starts].astype(np.uint64)
    drop = np.uint64(8) * (np.uint64(8) - np.minimum(lens, 8).astype(np.uint64))
    return np.where(lens <= 8, (key << drop) >> drop, np.uint64(0)).view(np.int64)


def class_counts(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Rows by character classes."""
    kind = CLASS[data]
    return np.stack([tb.per_row(kind == k, off) for k in range(N_CLASSES)], axis=1)


def base_counts(data: np.ndarray, off: np.ndarray) -> dict[str, np.ndarray]:
    """The base measures of each text, and the word spans they rest on."""
    starts, ends, first = tb.words(data, off)
    blank = tb.SPACE[data]
    hashes = tb.hash_spans(data, starts, ends - starts)
    grams, row, begin = tb.ngrams(hashes, first, 3)
    keyed = tb.mix(grams + tb.mix(row.astype(np.uint64) + tb.M3))
    ordered = np.sort(keyed)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    covered = np.zeros(len(starts) + 1, bool)
    if len(twice):
        at = np.minimum(np.searchsorted(twice, keyed), len(twice) - 1)
        hit = begin[twice[at] == keyed]
        for k in range(3):
            covered[hit + k] = True
    duplicate_lines = np.zeros(len(off) - 1, np.int64)
    for i in np.flatnonzero(tb.per_row(data == 10, off)):
        lines = Counter(x for x in data[off[i] : off[i + 1]].tobytes().split(b"\n") if x.split())
        duplicate_lines[i] = lines.total() - len(lines)
    return {
        "starts": starts,
        "ends": ends,
        "first": first,
        "n_words": np.diff(first),
        "word_chars": tb.per_row(tb.LEAD[data] & ~blank, off),
        "n_symbols": tb.per_row(IS_SYMBOL[data], off),
        "n_dup_lines": duplicate_lines,
        "n_repeat_words": tb.per_row(covered[:-1], first),
    }


def jensen_shannon(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Distance between rows of two arrays of shares, in base 2."""
    m = (p + q) / 2

    def part(a: np.ndarray) -> np.ndarray:
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(a > 0, a * np.log2(np.where(a > 0, a, 1) / np.where(m > 0, m, 1)), 0.0).sum(axis=-1)

    return np.sqrt(np.clip((part(p) + part(q)) / 2, 0, 1))


def _shares(counts: np.ndarray) -> np.ndarray:
    return counts / np.maximum(counts.sum(axis=-1, keepdims=True), 1)


def corpus_histograms(docs: DataFrame) -> DataFrame:
    """(lang, kind, key, n): kind 0 counts characters by class, kind 1 words by short word (key 0: other)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, off in tb.slices(batches, "text"):
            langs = batch.column(batch.schema.get_field_index("lang")).to_pylist()
            starts, ends, first = tb.words(data, off)
            keys = short_words(data, starts, ends)
            classes = class_counts(data, off)
            names = list(dict.fromkeys(langs))
            number = {x: i for i, x in enumerate(names)}
            of_row = np.array([number[x] for x in langs])
            of_word = np.repeat(of_row, np.diff(first))
            out = ([], [], [], [])
            for i, name in enumerate(names):
                total = classes[of_row == i].sum(axis=0)
                found, n = np.unique(keys[of_word == i], return_counts=True)
                for kind, k, c in ((0, np.arange(N_CLASSES), total), (1, found, n)):
                    out[0].extend([name] * len(k))
                    out[1].append(np.full(len(k), kind, np.int32))
                    out[2].append(k.astype(np.int64))
                    out[3].append(c.astype(np.int64))
            yield pa.record_batch([pa.array(out[0], pa.large_string()), *(pa.array(np.concatenate(x)) for x in out[1:])], names=["lang", "kind", "key", "n"])

    return docs.select("lang", "text").mapInArrow(count, "lang string, kind int, key long, n long").groupBy("lang", "kind", "key").agg(F.sum("n").alias("n"))


def references(docs: DataFrame, params: QualityParams) -> DataFrame:
    """(lang, words, entries) of every language: its words in all, and (kind, key, n) of its character classes and common words."""
    counts = materialise(corpus_histograms(docs), "quality-counts")
    w = Window.partitionBy("lang").orderBy(F.desc("n"), "key")
    top = counts.where("kind = 1 and key <> 0").withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= params.common_words).drop("rank")
    total = counts.where("kind = 1").groupBy("lang").agg(F.sum("n").alias("n")).select("lang", F.lit(2).alias("kind"), F.lit(0).cast("long").alias("key"), "n")
    entries = counts.where("kind = 0").unionByName(top).unionByName(total)
    words = F.coalesce(F.sum(F.when(F.col("kind") == 2, F.col("n"))), F.lit(0)).alias("words")
    return materialise(entries.groupBy("lang").agg(words, F.collect_list(F.struct("kind", "key", "n")).alias("entries")), "quality-references")


def reference(entries: list[dict]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Common words as integers in order, their shares and that of all others, and the shares of the classes."""
    words = sorted((e["key"], e["n"]) for e in entries if e["kind"] == 1)
    total = sum(e["n"] for e in entries if e["kind"] == 2)
    classes = np.zeros(N_CLASSES)
    for e in entries:
        if e["kind"] == 0:
            classes[e["key"]] = e["n"]
    n = [float(c) for _, c in words]
    return np.array([k for k, _ in words], np.int64), _shares(np.array([*n, total - sum(n)])), _shares(classes)


def distances(data: np.ndarray, off: np.ndarray, base: dict, langs: list, refs: dict, params: QualityParams) -> dict[str, np.ndarray]:
    """Distance to the reference, and the limit it must not pass, by characters and by words."""
    n = len(off) - 1
    classes, keys = class_counts(data, off), short_words(data, base["starts"], base["ends"])
    out = {k: np.zeros(n) for k in ("char_distance", "word_distance", "char_limit", "word_limit")}
    rows_of: dict = {}
    for i, name in enumerate(langs):
        rows_of.setdefault(name, []).append(i)
    for name, held in rows_of.items():
        rows = np.array(held)
        known, word_shares, class_shares = refs[name]
        picked = np.concatenate([np.arange(base["first"][r], base["first"][r + 1]) for r in rows])
        lens = base["n_words"][rows]
        local = np.repeat(np.arange(len(rows)), lens)
        mine = keys[picked]
        if len(known):
            at = np.minimum(np.searchsorted(known, mine), len(known) - 1)
            column = np.where(known[at] == mine, at, len(known))
        else:
            column = np.zeros(len(mine), np.int64)
        width = len(known) + 1
        counts = np.bincount(local * width + column, minlength=len(rows) * width).reshape(len(rows), width)
        out["word_distance"][rows] = jensen_shannon(_shares(counts), word_shares)
        out["char_distance"][rows] = jensen_shannon(_shares(classes[rows]), class_shares)
        for k, bins, size in (("word_limit", width, lens), ("char_limit", N_CLASSES, classes[rows].sum(axis=1))):
            noise = (bins - 1) / (8 * np.log(2) * np.maximum(size, 1))
            limit = params.max_word_distance if k == "word_limit" else params.max_char_distance
            out[k][rows] = np.sqrt(limit**2 + params.noise_allowance * noise)
    return out


COLUMNS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, char_distance double, word_distance double, kept boolean"
NAMES = [x.split()[0] for x in COLUMNS.split(", ")]


def judged(batch: pa.RecordBatch, data: np.ndarray, off: np.ndarray, refs: dict, params: QualityParams) -> list[pa.Array]:
    langs = batch.column(batch.schema.get_field_index("lang")).to_pylist()
    base = base_counts(data, off)
    far = distances(data, off, base, langs, refs, params)
    failed = (base["n_words"] < params.min_words) | (100 * base["n_repeat_words"] > params.max_repeat_percent * base["n_words"])
    kept = ~failed & (far["char_distance"] <= far["char_limit"]) & (far["word_distance"] <= far["word_limit"])
    new = [base["n_words"], base["word_chars"], base["n_symbols"], base["n_dup_lines"], base["n_repeat_words"], failed, far["char_distance"], far["word_distance"], kept]
    return [pa.array(x) for x in new]


def judge(docs: DataFrame, params: QualityParams = QualityParams()) -> DataFrame:
    """``docs`` (any columns, with ``text`` and ``lang``) plus ``COLUMNS``.

    Columns of the input that carry one of these names are replaced.
    """
    spark = docs.sparkSession
    prepare(spark)
    found = references(docs, params)
    largest = found.orderBy(F.desc("words"), "lang").limit(params.broadcast_languages).collect()
    known = spark.sparkContext.broadcast({r["lang"]: reference([e.asDict() for e in r["entries"]]) for r in largest})
    rest = docs.drop(*NAMES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, off in tb.slices(batches, "text"):
            yield pa.RecordBatch.from_arrays([*batch.columns, *judged(batch, data, off, known.value, params)], names=[*batch.schema.names, *NAMES])

    if len(largest) < params.broadcast_languages or found.count() == len(largest):
        return with_columns(rest, run, COLUMNS)
    names = [r["lang"] for r in largest]
    common = F.col("lang").isin([x for x in names if x is not None]) if None not in names else F.col("lang").isNull() | F.col("lang").isin([x for x in names if x is not None])
    common = F.coalesce(common, F.lit(False))

    def run_joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, off in tb.slices(batches, "text"):
            langs, entries = batch.column(2).to_pylist(), batch.column(3)
            where = {x: i for i, x in enumerate(langs)}
            refs = {x: reference(entries[i].as_py()) for x, i in where.items()}
            yield pa.RecordBatch.from_arrays([batch.column(0), *judged(batch, data, off, refs, params)], names=["row", *NAMES])

    # the row is packed, so its columns' names meet no others
    others = rest.where(~common).select(F.struct(*quoted(rest.columns)).alias("row"), "text", "lang")
    r = found.select(F.col("lang").alias("of"), "entries")
    joined = others.join(r, others["lang"].eqNullSafe(r["of"])).select("row", "text", "lang", "entries")
    packed = joined.mapInArrow(run_joined, extended(others.select("row"), COLUMNS))
    return with_columns(rest.where(common), run, COLUMNS).union(packed.select("row.*", *NAMES))
