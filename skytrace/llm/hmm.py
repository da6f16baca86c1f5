"""Language-model scoring with a hidden Markov model.

Learning.  Texts are lower-cased (A-Z) and cut into words, each text closed by
one end token.  All tokens of the training texts are counted, exactly and over the
whole corpus.  The most frequent ones, ``vocabulary`` at most, have emission
probabilities of their own in every state.  Any other word's are those of its
ending (``endings`` classes of the last three bytes, a bound of the model's size
that no word is left out by), times its own share of the class by corpus counts,
with one unit in each class for unseen words.  Latent states start from a hard
labelling (group of the text, shape of the word) and are trained by Baum-Welch:
tasks run forward-backward over their texts, expected counts are summed across
partitions, and the driver, which holds only tables of states by symbols,
estimates again, until a round gains less than ``tolerance`` a token or after
``rounds``.  Nothing is learned from held-out rows.

Groups.  The most frequent words keep company in texts: their common occurrences
are counted over all training texts, and clusters of them group the texts.

Long texts are trained on in cores of ``span`` tokens; ``margin`` tokens on either
side are read along so that the states at a core's ends are known, but not
counted.  Scoring runs the scaled forward recursion over the whole text, never cut.

Words are identified by 64-bit hashes.  Counts of the most frequent, ``lookup`` at
most, go to the executors; texts' other words are joined with the count table
(layout only).  Defined cases: a null or empty text is its end token; a null
``doc_id`` counts as empty text in the split; repeated rows train and score each
for itself; an empty table gives no rows; extra columns are not carried.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skytrace.llm import textbatch as tb
from skytrace.llm.common import materialise, prepare


@dataclass(frozen=True)
class HmmParams:
    groups: int = 4
    shapes: int = 3
    vocabulary: int = 32_768
    endings: int = 16_384
    lookup: int = 524_288
    #: Most frequent tokens whose company groups the texts.
    anchors: int = 128
    #: Tokens seen less often have no symbol of their own: they teach how likely a state is to emit unseen ones.
    min_count: int = 2
    rounds: int = 5
    #: Gain in natural log-likelihood a token under which training ends.
    tolerance: float = 0.01
    span: int = 512
    margin: int = 16
    #: Pseudo-counts of the unigram distribution in each state, and of each transition.
    emission_prior: float = 200.0
    transition_prior: float = 1.0
    modulus: int = 7
    held_out: int = 2
    #: Tokens that a worker has in hand when it trains or scores.
    batch_tokens: int = 1_000_000

    @property
    def states(self) -> int:
        return self.groups * self.shapes


END = np.uint64(0x1D5C0A7E5EED0001)
SEED = 10
#: Units of an expected count in the exact sums.
UNIT = 1 << 16


def is_held_out(doc_id: int | None, params: HmmParams) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % params.modulus == params.held_out


@dataclass
class Tokens:
    """Tokens of all texts in a row, each text's end included; ``first`` has where each text's begin (one more at the end)."""

    hashes: np.ndarray
    shapes: np.ndarray
    endings: np.ndarray
    first: np.ndarray


def tokens(data: np.ndarray, off: np.ndarray, params: HmmParams) -> Tokens:
    low = tb.LOWER[data]
    starts, ends, first = tb.words(low, off)
    count = np.diff(first)
    at = np.arange(len(starts)) + np.repeat(np.arange(len(count)), count)
    out = np.full(len(starts) + len(count), END, np.uint64)
    out[at] = tb.hash_spans(low, starts, ends - starts, SEED)
    shape = np.ones(len(out), np.uint8)
    last, head = data[ends - 1], data[starts]
    shape[at] = np.where((last == 46) | (last == 33) | (last == 63), 1, np.where((head >= 65) & (head <= 90), 2, 0))
    ending = np.zeros(len(out), np.int64)
    tail = np.maximum(starts, ends - 3)
    ending[at] = (tb.hash_spans(low, tail, ends - tail, SEED + 1) % np.uint64(params.endings)).astype(np.int64)
    return Tokens(out, shape, ending, first + np.arange(len(first)))


def token_counts(docs: DataFrame, params: HmmParams) -> DataFrame:
    """(h, ending, c): how often each token stands in the training texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        held = 0

        def merged() -> pa.RecordBatch:
            h, e, n = (np.concatenate(x) for x in zip(*found))
            h, at, inverse = np.unique(h, return_index=True, return_inverse=True)
            c = np.bincount(inverse, n, len(h)).astype(np.int64)
            return pa.record_batch([pa.array(h.view(np.int64)), pa.array(e[at]), pa.array(c)], names=["h", "ending", "c"])

        for batch, data, off in tb.slices(batches, "text"):
            train = np.array([not is_held_out(x, params) for x in batch.column(0).to_pylist()])
            t = tokens(data, off, params)
            mine = np.repeat(train, np.diff(t.first))
            u, at, n = np.unique(t.hashes[mine], return_index=True, return_counts=True)
            found.append((u, t.endings[mine][at], n))
            held += len(u)
            if held > 2_000_000:
                yield merged()
                found, held = [], 0
        if held:
            yield merged()

    counted = docs.select("doc_id", "text").mapInArrow(run, "h long, ending long, c long")
    return counted.groupBy("h").agg(F.min("ending").alias("ending"), F.sum("c").alias("c"))


@dataclass
class Vocabulary:
    hashes: np.ndarray  # sorted; the most frequent tokens
    counts: np.ndarray
    symbols: np.ndarray  # by frequency; -1 for those that have their ending's
    own: np.ndarray  # counts of the tokens that have a symbol, by symbol
    units: np.ndarray  # of each ending: tokens and types that have its symbol, and one for the unseen
    n: int
    v: int

    @property
    def size(self) -> int:
        return len(self.own) + len(self.units)

    @property
    def mass(self) -> float:
        """What the unigram weights, a token's count and one, add up to."""
        return float((self.own + 1).sum() + self.units.sum())

    @property
    def weights(self) -> np.ndarray:
        return np.append(self.own + 1.0, self.units) / self.mass


def size_bin() -> Column:
    """Bins of counts, sixteen to a doubling."""
    return F.floor(F.log2("c") * 16)


def vocabulary(counts: DataFrame, params: HmmParams) -> Vocabulary:
    """The most frequent tokens are those above a count that a histogram of counts tells, so no task sorts the others."""
    total = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    bins = {r["bin"]: r["n"] for r in counts.groupBy(size_bin().alias("bin")).agg(F.count("*").alias("n")).collect()}  # a thousand at most

    def least(most: int) -> int:
        """The lowest bin such that it and all above hold at most so many tokens."""
        held, out = 0, 1 << 20
        for b in sorted(bins, reverse=True):
            held += bins[b]
            if held > most:
                break
            out = b
        return out

    named = (size_bin() >= least(params.vocabulary)) & (F.col("c") >= params.min_count)
    top = counts.where((size_bin() >= least(params.lookup)) | named).select("h", "c", named.alias("own")).toArrow()
    units = np.ones(params.endings)
    for r in counts.where(~named).groupBy("ending").agg(F.sum(F.col("c") + 1).alias("n")).collect():  # a row an ending
        units[r["ending"]] += r["n"]
    h, c, own = top.column("h").to_numpy().view(np.uint64), top.column("c").to_numpy(), top.column("own").to_numpy().astype(bool)
    order = np.lexsort((h, -c, ~own))
    h, c, m = h[order], c[order], int(own.sum())
    symbols = np.where(np.arange(len(h)) < m, np.arange(len(h)), -1)
    by_hash = np.argsort(h)
    return Vocabulary(h[by_hash], c[by_hash], symbols[by_hash], c[:m], units, total["n"], total["v"])


ENCODED = "row_id long, doc_id long, held_out boolean, n_tokens long, known long, logs double, rare_logs double, ids binary, shapes binary, unknown array<bigint>"
ENCODED_NAMES = [x.split()[0] for x in ENCODED.split(", ")]


def encode(docs: DataFrame, vocab, params: HmmParams) -> DataFrame:
    """Symbols of each text, the sums over words that are looked up, and the hashes of all others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v: Vocabulary = vocab.value
        row_id = TaskContext.get().partitionId() << 36
        log_count, log_units = np.log10(v.counts + 1.0), np.log10(v.units)
        for batch, data, off in tb.slices(batches, "text"):
            ids = batch.column(0).to_pylist()
            t = tokens(data, off, params)
            h, first = t.hashes, t.first
            at = np.minimum(np.searchsorted(v.hashes, h), max(len(v.hashes) - 1, 0))
            hit = v.hashes[at] == h if len(v.hashes) else np.zeros(len(h), bool)
            symbol = np.where(hit, v.symbols[at] if len(v.symbols) else 0, -1)
            rare = symbol < 0
            logs = np.where(hit, log_count[at] if len(log_count) else 0.0, 0.0)
            n = np.diff(first)
            total = np.concatenate([[0.0], np.cumsum(logs)])
            rare_total = np.concatenate([[0.0], np.cumsum(np.where(rare, logs - log_units[t.endings], 0.0))])
            symbols = np.where(rare, len(v.own) + t.endings, symbol).astype("<u2").tobytes()
            shapes = t.shapes.tobytes()
            cut = first.tolist()
            unknown = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(tb.per_row(~hit, first))), pa.int32()), pa.array(h[~hit].view(np.int64)))
            held = [is_held_out(x, params) for x in ids]
            columns = [
                pa.array(np.arange(row_id, row_id + len(ids))),
                pa.array(ids, pa.int64()),
                pa.array(held),
                pa.array(n),
                pa.array(tb.per_row(hit, first)),
                pa.array(total[first[1:]] - total[first[:-1]]),
                pa.array(rare_total[first[1:]] - rare_total[first[:-1]]),
                pa.array([symbols[2 * a : 2 * b] for a, b in zip(cut, cut[1:])], pa.large_binary()),
                pa.array([None if x else shapes[a:b] for x, a, b in zip(held, cut, cut[1:])], pa.large_binary()),
                unknown,
            ]
            row_id += len(ids)
            yield pa.RecordBatch.from_arrays(columns, names=ENCODED_NAMES)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, ENCODED)


def text_groups(training: DataFrame, vocab: Vocabulary, params: HmmParams) -> np.ndarray:
    """How much one occurrence of each of the most frequent words (the anchors; symbols but the end) speaks for each group."""
    end = int(np.searchsorted(vocab.hashes, END))
    ends = int(vocab.symbols[end]) if end < len(vocab.hashes) and vocab.hashes[end] == END else -1
    n = min(params.anchors, len(vocab.own))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        together = np.zeros((n, n), np.int64)
        for (ids,) in _batched(batches, params.batch_tokens, "ids"):
            seen = (anchor_counts(ids, n) > 0).astype(np.float32)
            together += (seen.T @ seen).astype(np.int64)
        i, j = np.nonzero(together)
        yield pa.record_batch([pa.array(i), pa.array(j), pa.array(together[i, j])], names=["i", "j", "n"])

    together = np.zeros((n, n))
    for r in training.select("ids").mapInArrow(run, "i long, j long, n long").groupBy("i", "j").agg(F.sum("n").alias("n")).collect():  # anchors squared
        together[r["i"], r["j"]] = r["n"]
    keep = np.arange(n) != ends
    out = np.zeros((n, params.groups))
    out[keep] = group_weights(together[np.ix_(keep, keep)], params.groups)
    return out


def group_weights(together: np.ndarray, groups: int) -> np.ndarray:
    """Clusters of anchors by the company they keep, as weights (anchors by groups)."""
    n = len(together)
    own = np.sqrt(np.maximum(np.diag(together), 1))
    rows = together / own[:, None] / own[None, :]
    rows /= np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)
    centres = [0] if n else []
    while len(centres) < min(groups, n):  # the next centre is the frequent anchor that is least like the others
        centres.append(int(np.argmax((1 - (rows @ rows[centres].T).max(axis=1)) * np.log1p(own))))
    if not n:
        return np.zeros((0, groups))
    middle = rows[centres]
    for _ in range(20):
        of = np.argmax(rows @ middle.T, axis=1)
        middle = np.stack([rows[of == g].mean(axis=0) if (of == g).any() else middle[g] for g in range(len(centres))])
    out = np.zeros((n, groups))
    out[np.arange(n), of] = 1.0
    share = (out * own[:, None] ** 2).sum(axis=0)
    return out / np.sqrt(np.maximum(share, 1.0))


def anchor_counts(ids: list[bytes], n: int) -> np.ndarray:
    """Texts by anchors."""
    x = np.frombuffer(b"".join(ids), "<u2").astype(np.int64)
    text = np.repeat(np.arange(len(ids)), [len(i) // 2 for i in ids])
    return np.bincount((text * n + x)[x < n], minlength=len(ids) * n).reshape(len(ids), n)


@dataclass
class Model:
    start: np.ndarray  # states
    move: np.ndarray  # states by states
    emit: np.ndarray  # symbols by states

    @property
    def usual(self) -> np.ndarray:
        """Where the chain is in the long run: how a margin inside a text starts."""
        p = self.start.copy()
        for _ in range(64):
            p = p @ self.move
        return p / p.sum()

    @staticmethod
    def estimate(start: np.ndarray, move: np.ndarray, emit: np.ndarray, weights: np.ndarray, params: HmmParams) -> Model:
        """Smoothed estimates from expected counts; ``weights`` are the symbols' unigram shares."""
        k = params.states
        m = (move + params.transition_prior) / (move.sum(axis=1, keepdims=True) + params.transition_prior * k)
        s = (start + params.transition_prior) / (start.sum() + params.transition_prior * k)
        e = (emit + params.emission_prior * weights[:, None]) / (emit.sum(axis=0) + params.emission_prior)
        return Model(s, m, e)


def time_major(lens: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """For sequences laid end to end: their order by length, token places step by step, and how many are live at each step."""
    order = np.argsort(-lens, kind="stable")
    starts = (np.cumsum(lens) - lens)[order]
    ordered = lens[order]
    steps = int(ordered[0]) if len(ordered) else 0
    live = np.searchsorted(-ordered, -np.arange(steps), "left")
    where = np.concatenate([starts[:n] + t for t, n in enumerate(live.tolist())]) if steps else np.zeros(0, np.int64)
    return order, where, live.tolist()


def forward(ids: np.ndarray, lens: np.ndarray, model: Model) -> np.ndarray:
    """Natural log-likelihood of each sequence (none is empty), by the scaled forward recursion."""
    order, where, live = time_major(lens)
    out = np.zeros(len(lens))
    symbols = ids[where]
    at, a = 0, np.zeros((0, 0))
    logs = np.zeros(len(lens))
    for t, n in enumerate(live):
        e = model.emit[symbols[at : at + n]]
        a = e * model.start if t == 0 else (a[:n] @ model.move) * e
        c = a.sum(axis=1)
        a /= c[:, None]
        logs[:n] += np.log(c)
        at += n
    out[order] = logs
    return out


def spans(lens: np.ndarray, params: HmmParams) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first, length, margin before, core) of the spans that texts laid end to end are trained in."""
    pieces = -(-lens // params.span)
    text = np.repeat(np.arange(len(lens)), pieces)
    begin = (np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * params.span
    end = np.minimum(begin + params.span, lens[text])
    head = np.maximum(begin - params.margin, 0)
    tail = np.minimum(end + params.margin, lens[text])
    return (np.cumsum(lens) - lens)[text] + head, tail - head, begin - head, end - begin


def expected_counts(ids: np.ndarray, lens: np.ndarray, model: Model, params: HmmParams) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Expected counts of texts laid end to end: symbols by states, moves and starts; and their log-likelihood."""
    first, size, before, core = spans(lens, params)
    place = np.repeat(first - (np.cumsum(size) - size), size) + np.arange(size.sum())
    order, where, live = time_major(size)
    symbols = ids[place[where]]
    inside = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    counts = ((inside >= np.repeat(before, size)) & (inside < np.repeat(before + core, size)))[where].astype(np.float32)
    k = len(model.start)
    e_all, m = model.emit.astype(np.float32), model.move.astype(np.float32)
    heads = np.zeros(len(ids), bool)
    heads[np.cumsum(lens) - lens] = True
    whole = heads[first[order]]  # spans that start with their text
    a = np.empty((len(where), k), np.float32)
    scale = np.empty(len(where), np.float32)
    at, bounds = 0, []
    for t, n in enumerate(live):
        e = e_all[symbols[at : at + n]]
        if t == 0:
            now = e * np.where(whole[:, None], model.start, model.usual).astype(np.float32)
        else:
            now = (a[bounds[-1][0] : bounds[-1][0] + n] @ m) * e
        c = now.sum(axis=1)
        now /= c[:, None]
        a[at : at + n] = now
        scale[at : at + n] = c
        bounds.append((at, n))
        at += n
    gain = float(np.log(scale.astype(np.float64)) @ counts)
    after = None
    move, start = np.zeros((k, k)), np.zeros(k)
    for t in range(len(live) - 1, -1, -1):
        at, n = bounds[t]
        b = np.ones((n, k), np.float32)
        if after is not None:
            b[: len(after)] = after @ m.T
            move += m * (a[at : at + len(after)].T @ (after * counted_after[:, None]))
        after = b * e_all[symbols[at : at + n]] / scale[at : at + n, None]
        counted_after = counts[at : at + n]
        a[at : at + n] *= b  # now the state posteriors
    if live:
        start += a[: live[0]][whole].sum(axis=0)
    a *= counts[:, None]
    emit = np.stack([np.bincount(symbols, a[:, s], len(e_all)) for s in range(k)], axis=1)
    return emit, move, start, gain


def _batched(batches: Iterator[pa.RecordBatch], limit: int, *names: str) -> Iterator[list[list]]:
    """Columns of rows until ``limit`` tokens are in hand; the last column named holds them as binary."""
    held: list[list] = [[] for _ in names]
    size = 0
    for batch in batches:
        columns = [batch.column(batch.schema.get_field_index(n)).to_pylist() for n in names]
        for row in zip(*columns, strict=True):
            for h, x in zip(held, row, strict=True):
                h.append(x)
            size += len(row[-1]) // 2
            if size >= limit:
                yield held
                held, size = [[] for _ in names], 0
    if held[0]:
        yield held


def _count_schema(k: int) -> str:
    return ", ".join(["symbol int", *(f"k{i} long" for i in range(k))])


def gather(rows: DataFrame, size: int, params: HmmParams) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Sums over all tasks: starts, moves, emissions (symbols by states), and the log-likelihood a token."""
    k = params.states
    summed = rows.groupBy("symbol").agg(*(F.sum(f"k{i}").alias(f"k{i}") for i in range(k))).toArrow()
    full = np.zeros((size + k + 2, k))
    if summed.num_rows:
        full[summed.column("symbol").to_numpy()] = np.stack([summed.column(f"k{i}").to_numpy() for i in range(k)], axis=1) / UNIT
    return full[size + k], full[size : size + k], full[:size], full[-1, 0] / max(full[-1, 1], 1.0)


def _count_batch(emit: np.ndarray, move: np.ndarray, start: np.ndarray, gain: float, n: int) -> pa.RecordBatch:
    last = np.zeros((1, len(start)))
    last[0, :2] = gain, n
    # whole units: sums don't depend on the order of tasks
    units = np.rint(np.concatenate([emit, move, start[None], last]) * UNIT).astype(np.int64)
    used = np.flatnonzero(units.any(axis=1))
    return pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), *(pa.array(units[used, i]) for i in range(units.shape[1]))], names=["symbol", *(f"k{i}" for i in range(units.shape[1]))])


def hard_labels(ids: list[bytes], shapes: list[bytes], votes: np.ndarray, params: HmmParams) -> np.ndarray:
    """The state that each token of the texts starts in: its text's group and its own shape."""
    group = np.argmax(anchor_counts(ids, len(votes)) @ votes, axis=1) if len(votes) else np.zeros(len(ids), np.int64)
    return np.repeat(group, list(map(len, shapes))) * params.shapes + np.frombuffer(b"".join(shapes), np.uint8) % params.shapes


def train(encoded: DataFrame, vocab: Vocabulary, params: HmmParams) -> Model:
    spark: SparkSession = encoded.sparkSession
    k, size = params.states, vocab.size
    training = encoded.where("not held_out")
    votes = text_groups(training, vocab, params)

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        emit, move, start, n = np.zeros(size * k), np.zeros(k * k), np.zeros(k), 0
        for shapes, ids in _batched(batches, params.batch_tokens, "shapes", "ids"):
            s = hard_labels(ids, shapes, votes, params)
            x = np.frombuffer(b"".join(ids), "<u2").astype(np.int64)
            first = np.cumsum([0, *map(len, shapes)])[:-1]
            emit += np.bincount(x * k + s, minlength=size * k)
            joined = np.ones(len(s), bool)
            joined[first] = False
            move += np.bincount((s[:-1] * k + s[1:])[joined[1:]], minlength=k * k)
            start += np.bincount(s[first], minlength=k)
            n += len(s)
        yield _count_batch(emit.reshape(size, k), move.reshape(k, k), start, 0.0, n)

    start, move, emit, _ = gather(training.select("shapes", "ids").mapInArrow(label, _count_schema(k)), size, params)
    model, likely = Model.estimate(start, move, emit, vocab.weights, params), -np.inf
    for _ in range(params.rounds):
        shared = spark.sparkContext.broadcast(model)

        def learn(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            sums, gain, n = [np.zeros((size, k)), np.zeros((k, k)), np.zeros(k)], 0.0, 0
            for (ids,) in _batched(batches, params.batch_tokens, "ids"):
                x = np.frombuffer(b"".join(ids), "<u2").astype(np.int64)
                *counts, more = expected_counts(x, np.array([len(i) // 2 for i in ids]), shared.value, params)
                for total, c in zip(sums, counts):
                    total += c
                gain, n = gain + more, n + len(x)
            yield _count_batch(*sums, gain, n)

        start, move, emit, now = gather(training.select("ids").mapInArrow(learn, _count_schema(k)), size, params)
        shared.unpersist()
        model = Model.estimate(start, move, emit, vocab.weights, params)
        if now - likely < params.tolerance:
            break
        likely = now
    return model


def score(docs: DataFrame, params: HmmParams = HmmParams()) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for every row of ``docs`` (doc_id, text)."""
    if params.vocabulary + params.endings > 1 << 16:
        raise ValueError("symbols are numbered in 16 bits")
    spark = docs.sparkSession
    prepare(spark)
    counts = materialise(token_counts(docs, params), "token-counts")
    vocab = vocabulary(counts, params)
    n, v = vocab.n, vocab.v
    encoded = materialise(encode(docs, spark.sparkContext.broadcast(vocab), params), "encoded")
    model = spark.sparkContext.broadcast(train(encoded, vocab, params))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, ids in _batched(batches, 4 * params.batch_tokens, "row_id", "ids"):
            x = np.frombuffer(b"".join(ids), "<u2").astype(np.int64)
            lens = np.array([len(i) // 2 for i in ids])
            yield pa.record_batch([pa.array(row, pa.int64()), pa.array(forward(x, lens, model.value) / np.log(10))], names=["row_id", "model_log"])

    unknown = encoded.select("row_id", F.explode("unknown").alias("h")).join(counts, "h")
    unknown = unknown.groupBy("row_id").agg(F.count("*").alias("more_known"), F.sum(F.log10(F.col("c") + 1)).alias("more_logs"))
    scored = encoded.select("row_id", "ids").mapInArrow(run, "row_id long, model_log double")
    rows = encoded.drop("ids", "shapes", "unknown").join(scored, "row_id").join(unknown, "row_id", "left")
    more = F.coalesce("more_logs", F.lit(0.0))
    return rows.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("logs") + more - F.col("n_tokens") * F.log10(F.lit(float(n + v + 1)))).alias("base_score"),
        (F.col("model_log") + F.col("rare_logs") + more).alias("score"),
    )
