"""Packing, mixing and language-model scoring."""

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from skytrace.llm import hmm, mixing, packing

BPE = public_tokenizers.path("byte_bpe_50k.json")


def check_pack(docs, rows, params):
    tok = Tokenizer.from_file(BPE)
    want = Counter()
    ids_of = {}
    for r in docs.select("doc_id", "text").collect():
        ids = np.array(tok.encode(r.text or "", add_special_tokens=False).ids + [params.end_id], "<u4")
        want[(r.doc_id, ids.tobytes())] += 1
        ids_of.setdefault(r.doc_id, []).append(ids)
    for r in rows:
        assert any(len(i) == r.doc_tokens and zlib.crc32(i[r.start : r.start + r.length].tobytes()) == r.ids_crc32 for i in ids_of[r.doc_id])
    covered = defaultdict(list)
    for r in rows:
        covered[r.doc_id].append((r.start, r.length))
    for doc, parts in ids_of.items():
        assert sum(n for _, n in covered[doc]) == sum(map(len, parts))
        if len(parts) == 1:
            at = 0
            for start, n in sorted(covered[doc]):
                assert start == at and n > 0
                at += n
    windows = defaultdict(list)
    for r in rows:
        windows[r.sequence_id].append((r.offset, r.length))
    for pieces in windows.values():
        at = 0
        for offset, n in sorted(pieces):
            assert offset == at
            at += n
        assert at <= params.capacity
    total = sum(len(i) for parts in ids_of.values() for i in parts)
    return total, len(windows)


def test_packing(documents, odd, none):
    p = packing.PackParams()
    total, n = check_pack(documents, packing.pack(documents, BPE, p).collect(), p)
    assert n <= total / p.capacity * 1.05 + 2
    check_pack(odd, packing.pack(odd, BPE, p).collect(), p)
    assert packing.pack(none, BPE).count() == 0


def test_packing_merges_many_partitions(documents):
    p = packing.PackParams(capacity=256, open_windows=4, min_piece=8)
    check_pack(documents.limit(60), packing.pack(documents.limit(60).repartition(40), BPE, p).collect(), p)


def test_ids_match_the_library(odd):
    tok = Tokenizer.from_file(BPE)
    for t in ["", " a  b\n\n c ", "it's <|endoftext|> é日本 😀", "　x y", *[r.text or "" for r in odd.collect()]]:
        assert packing.encode(t, BPE).tolist() == tok.encode(t, add_special_tokens=False).ids


def test_tokenizer_files_that_the_fast_encoder_cannot_read():
    import json

    with open(BPE, encoding="utf-8") as f:
        file = json.load(f)
    assert len(packing.plain_ranks(file)) == 50_256
    for change in ({"normalizer": {"type": "NFC"}}, {"pre_tokenizer": {"type": "Whitespace"}}, {"added_tokens": []}, {"model": file["model"] | {"dropout": 0.1}}, {"model": file["model"] | {"merges": file["model"]["merges"][::-1]}}):
        assert packing.plain_ranks(file | change) is None


def brute_targets(sizes, params):
    weights = {s: params.weights[i % len(params.weights)] for i, s in enumerate(sorted(sizes, key=lambda s: (s is None, s or "")))}
    left, total, out = dict(weights), params.budget * sum(sizes.values()), {}
    while left:
        level = (total - sum(out.values())) / sum(left.values())
        full = [s for s in left if level * left[s] > params.cap * sizes[s]]
        if not full:
            out |= {s: level * w for s, w in left.items()}
            break
        for s in full:
            out[s] = params.cap * sizes[s]
            del left[s]
    return out


def test_mixing(documents, odd, none):
    p = mixing.MixParams()
    for df in (documents, odd):
        light = mixing.with_size(df).select("doc_id", "source", "size")
        rows = mixing.copies(light, p).collect()
        assert len(rows) == df.count()
        sizes = defaultdict(int)
        taken = defaultdict(int)
        for r in rows:
            sizes[r.source] += r.size
            taken[r.source] += r.size * r.copies
            assert 0 <= r.copies <= p.cap
        want = brute_targets(sizes, p)
        for r in rows:
            assert r.source_size == sizes[r.source]
            assert r.target == pytest.approx(want[r.source], abs=1e-6)
        if df is documents:
            for s, t in want.items():
                assert abs(taken[s] - t) <= 0.05 * t + 50
        again = mixing.copies(light.repartition(5), p).collect()
        key = lambda x: sorted((r.doc_id or -1, r.source or "", r.size, r.copies) for r in x)
        assert key(again) == key(rows)
    assert mixing.copies(mixing.with_size(none).select("doc_id", "source", "size")).count() == 0


def test_rates_balance_entropy(documents):
    """The optimum's conditions: each source meets its target, and rates are tilts exp(m * size) cut at the cap, with one m a source."""
    p = mixing.MixParams()
    by_source = defaultdict(list)
    for r in mixing.copies(mixing.with_size(documents).select("doc_id", "source", "size"), p).collect():
        by_source[r.source].append(r)
    tilted = 0
    for rows in by_source.values():
        assert sum(r.size * r.rate for r in rows) == pytest.approx(rows[0].target, rel=1e-6)
        slopes = [math.log(r.rate) / r.size for r in rows if r.size and r.rate < p.cap * (1 - 1e-9)]
        if slopes:
            tilted += 1
            assert slopes == pytest.approx([slopes[0]] * len(slopes), rel=1e-6)
            assert all(r.rate == pytest.approx(min(p.cap, math.exp(slopes[0] * r.size)), rel=1e-6) for r in rows if r.size)
    assert tilted
    with pytest.raises(RuntimeError):
        mixing.copies(mixing.with_size(documents).select("doc_id", "source", "size"), mixing.MixParams(max_steps=1))


def test_targets_of_many_sources(spark):
    rng = np.random.default_rng(4)
    sizes = {(f"s{i:03d}" if i else None): int(rng.integers(0, 4000) ** 2 // 1000) for i in range(200)}
    df = spark.createDataFrame(list(sizes.items()), "source string, size bigint").repartition(7)
    got = {r.source: r.target for r in mixing.targets(df).collect()}
    want = brute_targets(sizes, mixing.MixParams())
    assert got == {s: pytest.approx(t, abs=1e-6) for s, t in want.items()}


def test_equal_rows_fill_many_buckets(spark):
    rows = [(None, "one", "same text of five words")] * 300 + [(i, "two", "a b c " * (i % 5)) for i in range(100)]
    df = spark.createDataFrame(rows, "doc_id bigint, source string, text string").withColumn("id_", F.lit("x")).withColumn("hash_", F.rand(1)).repartition(4)
    p = mixing.MixParams(bucket_rows=20)
    sizes = mixing.with_size(df.drop("hash_")).select("doc_id", "source", "size")
    found = mixing.copies(sizes, p)
    assert found.count() == 400
    target = {r.source: r.target for r in found.collect()}
    for df_ in (df, df.drop("hash_")):
        mixed = mixing.mix(df_, p)
        assert mixed.columns == df_.columns
        taken = {r.source: r.n for r in mixing.with_size(mixed).groupBy("source").agg(F.sum("size").alias("n")).collect()}
        assert all(abs(taken[s] - t) <= 0.1 * t + 30 for s, t in target.items())


def test_mix_repeats_rows(odd):
    light = mixing.with_size(odd).select("doc_id", "source", "size")
    want = Counter()
    for r in mixing.copies(light).collect():
        want[r.source] += r.size * r.copies
    got = Counter()
    for r in mixing.with_size(mixing.mix(odd)).collect():
        got[r.source] += r.size
    assert {k: v for k, v in got.items() if v} == {k: v for k, v in want.items() if v}


def naive_log_likelihood(ids, model):
    a = model.start * model.emit[ids[0]]
    for x in ids[1:]:
        a = (a @ model.move) * model.emit[x]
    return math.log(a.sum())


def random_model(rng, states=3, symbols=5):
    m = hmm.Model(rng.random(states), rng.random((states, states)), rng.random((symbols, states)))
    m.start /= m.start.sum()
    m.move /= m.move.sum(axis=1, keepdims=True)
    m.emit /= m.emit.sum(axis=0)
    return m


def test_forward_is_exact():
    rng = np.random.default_rng(1)
    model = random_model(rng)
    lens = np.array([4, 1, 7, 2, 7])
    ids = rng.integers(0, 5, lens.sum())
    cuts = np.cumsum(lens)[:-1]
    assert hmm.forward(ids, lens, model) == pytest.approx([naive_log_likelihood(x, model) for x in np.split(ids, cuts)])


def brute_counts(seqs, model):
    from itertools import product

    k, v = len(model.start), len(model.emit)
    emit, move, start, gain = np.zeros((v, k)), np.zeros((k, k)), np.zeros(k), 0.0
    for x in seqs:
        weight = {}
        for path in product(range(k), repeat=len(x)):
            p = model.start[path[0]] * model.emit[x[0], path[0]]
            for t in range(1, len(x)):
                p *= model.move[path[t - 1], path[t]] * model.emit[x[t], path[t]]
            weight[path] = p
        total = sum(weight.values())
        gain += math.log(total)
        for path, p in weight.items():
            start[path[0]] += p / total
            for t, s in enumerate(path):
                emit[x[t], s] += p / total
                if t:
                    move[path[t - 1], s] += p / total
    return emit, move, start, gain


def test_expected_counts_are_exact():
    rng = np.random.default_rng(2)
    model = random_model(rng, 2, 3)
    seqs = [np.array([0, 1, 2, 1]), np.array([2]), np.array([1, 1])]
    got = hmm.expected_counts(np.concatenate(seqs), np.array([4, 1, 2]), model, hmm.HmmParams())
    for g, w in zip(got, brute_counts(seqs, model)):
        assert g == pytest.approx(w, abs=1e-4)


def test_spans_count_as_whole_texts_do():
    rng = np.random.default_rng(5)
    model = random_model(rng, 4, 9)
    lens = np.array([300, 7, 64, 65, 1, 128])
    ids = rng.integers(0, 9, lens.sum())
    whole = hmm.expected_counts(ids, lens, model, hmm.HmmParams())
    for g, w in zip(hmm.expected_counts(ids, lens, model, hmm.HmmParams(span=64)), whole):
        assert g == pytest.approx(w, rel=2e-3, abs=2e-3)


def test_company_of_words_groups_texts():
    rng = np.random.default_rng(1)
    together = np.zeros((30, 30))
    for g in range(3):
        for _ in range(200):
            seen = rng.choice(np.arange(10 * g, 10 * g + 10), 6, replace=False)
            together[np.ix_(seen, seen)] += 1
    of = np.argmax(hmm.group_weights(together, 3), axis=1)
    assert [len(set(of[10 * g : 10 * g + 10])) for g in range(3)] == [1, 1, 1] and len(set(of)) == 3


def brute_base(rows):
    texts, counts = [], Counter()
    for r in rows:
        w = [*(r.text or "").encode().lower().split(), None]
        held = zlib.crc32(b"" if r.doc_id is None else str(r.doc_id).encode()) % 7 == 2
        texts.append((r.doc_id, held, w))
        if not held:
            counts.update(w)
    n, v = sum(counts.values()), len(counts)
    out = Counter()
    for doc, held, w in texts:
        score = sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in w)
        out[(doc, held, len(w), sum(counts[x] > 0 for x in w), n, round(score, 5))] += 1
    return out


def brute_scores(rows, params, votes):
    """The model's score of every text: the same training in one piece, over plain dictionaries of words."""
    view = lambda r: hmm.tokens(*hmm.tb.utf8(hmm.pa.array([r.text or ""], hmm.pa.large_string())), params)
    texts = [[*(w for w in (r.text or "").encode().lower().split()), b""] for r in rows]
    seen = [view(r) for r in rows]
    held = [hmm.is_held_out(r.doc_id, params) for r in rows]
    counts = Counter(w for t, out in zip(texts, held) if not out for w in t)
    hash_of = {w: int(h) for t, x in zip(texts, seen) for w, h in zip(t, x.hashes)}
    ending = {w: int(e) for t, x in zip(texts, seen) for w, e in zip(t, x.endings)}
    bins = Counter(int(math.log2(c) * 16) for c in counts.values())
    least = min((b for b in bins if sum(n for x, n in bins.items() if x >= b) <= params.vocabulary), default=10**6)
    own = sorted((w for w, c in counts.items() if c >= params.min_count and int(math.log2(c) * 16) >= least), key=lambda w: (-counts[w], hash_of[w]))
    at = {w: i for i, w in enumerate(own)}
    units = np.ones(params.endings)
    for w, c in counts.items():
        if w not in at:
            units[ending[w]] += c + 1
    weights = np.array([counts[w] + 1 for w in own] + units.tolist())
    ids = [np.array([at.get(w, len(own) + ending[w]) for w in t]) for t in texts]
    train = [i for i, out in enumerate(held) if not out]
    k = params.states
    emit, move, start = np.zeros((len(weights), k)), np.zeros((k, k)), np.zeros(k)
    for i in train:
        state = hmm.hard_labels([ids[i].astype("<u2").tobytes()], [seen[i].shapes.tobytes()], votes, params)
        np.add.at(emit, (ids[i], state), 1)
        np.add.at(move, (state[:-1], state[1:]), 1)
        start[state[0]] += 1
    estimate = lambda s, m, e: hmm.Model.estimate(s, m, e, weights / weights.sum(), params)
    model = estimate(start, move, emit)
    for _ in range(params.rounds):
        emit, move, start, _ = hmm.expected_counts(np.concatenate([ids[i] for i in train]), np.array([len(ids[i]) for i in train]), model, params)
        model = estimate(start, move, emit)
    more = [sum(math.log10((counts[w] + 1) / units[ending[w]]) for w in t if w not in at) for t in texts]
    return [naive_log_likelihood_scaled(x, model) / math.log(10) + m for x, m in zip(ids, more)]


def naive_log_likelihood_scaled(ids, model):
    a, out = model.start * model.emit[ids[0]], 0.0
    for x in ids[1:]:
        out += math.log(a.sum())
        a = (a / a.sum() @ model.move) * model.emit[x]
    return out + math.log(a.sum())


def test_hmm_scores(documents, odd, none, monkeypatch):
    """Base and model scores against plain code, with most of the vocabulary outside the symbols and the lookup."""
    seen = []
    original = hmm.text_groups
    monkeypatch.setattr(hmm, "text_groups", lambda *a: seen.append(original(*a)) or seen[-1])
    small = hmm.HmmParams(vocabulary=200, endings=300, lookup=900, rounds=2, tolerance=-math.inf)
    for df in (documents.orderBy("doc_id").limit(120), odd):
        df = df.repartition(3, "doc_id")
        rows = df.collect()
        found = hmm.score(df, small).collect()
        assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in found) == brute_base(rows)
        want = sorted(brute_scores(rows, small, seen[-1]))
        assert sorted(r.score for r in found) == pytest.approx(want, rel=1e-3, abs=0.05)
    assert hmm.score(none).count() == 0


def test_hmm_learns_nothing_from_held_out_rows(spark, documents):
    p = hmm.HmmParams(rounds=1)
    rows = documents.limit(60).collect()
    made = [(r.doc_id, r.text if not hmm.is_held_out(r.doc_id, p) else "other words " * 50, r.lang if not hmm.is_held_out(r.doc_id, p) else "xx") for r in rows]
    schema = "doc_id bigint, text string, lang string"
    plain = spark.createDataFrame([(r.doc_id, r.text, r.lang) for r in rows], schema).coalesce(1)
    changed = spark.createDataFrame(made, schema).coalesce(1)
    a, b = ({r.doc_id: r.score for r in hmm.score(df, p).collect() if not r.held_out} for df in (plain, changed))
    assert a == pytest.approx(b, rel=1e-6) and len(a) > 30


def test_hmm_beats_the_base_on_held_out_text(documents):
    held = [r for r in hmm.score(documents).collect() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
