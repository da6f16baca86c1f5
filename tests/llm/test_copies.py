"""Fingerprints, near-duplicates and suffix dedup against brute force."""

import hashlib
import random

import numpy as np
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from skytrace.llm import fingerprints, neardup, suffixdedup


def brute_edits(rows):
    order = sorted(rows, key=lambda r: (-(r.doc_id if r.doc_id is not None else -(1 << 63))))
    out = {}
    for r, after in zip(order, order[1:] + order[:1]):
        t, n = r.text or "", after.text or ""
        half = len(t) // 2
        out[r.doc_id] = (len(t), hashlib.sha256((t[: len(t) - half] + n[:half]).encode()).hexdigest())
    return out


def test_fingerprints(documents, odd, none):
    rows = fingerprints.fingerprint_documents(documents).collect()
    want = brute_edits(documents.collect())
    assert {r.doc_id: (r.n_chars, r.edited_sha256) for r in rows} == want
    by_text = {}
    text = {r.doc_id: r.text for r in documents.collect()}
    for r in rows:
        assert by_text.setdefault(text[r.doc_id], r.fingerprint) == r.fingerprint
        assert len(r.fingerprint) == 32 and 0 <= r.near_next <= 1
    assert np.mean([r.near_edited > r.near_next for r in rows]) > 0.95
    distinct = odd.where("doc_id is null or doc_id <> 7")
    got = {r.doc_id: (r.n_chars, r.edited_sha256) for r in fingerprints.fingerprint_documents(distinct).collect()}
    assert got == brute_edits(distinct.collect())
    assert fingerprints.fingerprint_documents(odd).count() == odd.count()
    assert fingerprints.fingerprint_documents(none).count() == 0


def test_fingerprint_bits_and_likeness_by_brute_force(spark, documents):
    """Every bit of the fingerprints, the likenesses and the neighbours, by plain code over the same term hashes."""
    from skytrace.llm import textbatch as tb

    p = fingerprints.SimHashParams()

    def word_hash(w):
        return int(tb.hash_spans(np.frombuffer(w, np.uint8), np.array([0]), np.array([len(w)]), 5)[0])

    def mixed(x):
        return int(tb.mix(np.array([x & (1 << 64) - 1], np.uint64))[0])

    def plain(text):
        words = text.encode().lower().split()
        hashes = [word_hash(w) for w in words]
        terms = [(h, p.word_weight) for w, h in zip(words, hashes) if len(w) >= p.long_word]
        for i in range(max(1, len(words) - p.shingle + 1) if words else 0):
            x = 0
            for h in hashes[i : i + p.shingle]:
                x = mixed(x * int(tb.M1) + h)
            terms.append((x, p.shingle_weight))
        out = 0
        for half, salt in ((1, 1), (0, 2)):
            votes = np.zeros(64)
            for x, weight in terms:
                bits = mixed(x + salt) >> np.arange(64, dtype=object) & 1
                votes += np.where(bits.astype(bool), weight, -weight)
            out |= sum(1 << k for k in range(64) if votes[k] > 0) << 64 * half
        return out

    texts = [r.text for r in documents.orderBy("doc_id").limit(12).collect()] + ["", "one two", "a b c d e", "internationalization"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    rows = {r.doc_id: r for r in fingerprints.fingerprint_documents(df).collect()}
    own = [plain(t) for t in texts]
    for i, t in enumerate(texts):
        after = texts[i - 1]
        half = len(t) // 2
        changed = plain(t[: len(t) - half] + after[:half])
        assert rows[i].fingerprint == f"{own[i]:032x}" and rows[i].edited_fingerprint == f"{changed:032x}"
        assert rows[i].near_edited == 1 - (own[i] ^ changed).bit_count() / 128 and rows[i].near_next == 1 - (own[i] ^ own[i - 1]).bit_count() / 128
        near = {f for f in own if f != own[i] and (f ^ own[i]).bit_count() <= p.radius}
        assert rows[i].n_near == len(near) and rows[i].near_doc_id == min((k for k, f in enumerate(own) if f in near), default=None)


def test_fingerprints_over_many_partitions(spark):
    rows = [(i // 3 if i % 5 else None, f"text {i % 40} of some words and more {i % 7}") for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(7)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2000")
    try:
        got = sorted((str(r.doc_id), r.n_chars, r.edited_sha256) for r in fingerprints.edited_fingerprints(df).select("doc_id", "n_chars", "edited_sha256").coalesce(8).collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert got == sorted((str(r.doc_id), r.n_chars, r.edited_sha256) for r in fingerprints.edited_fingerprints(df).collect())


def bit_words(x, n):
    return tuple((w := x >> 64 * i & (1 << 64) - 1) - (1 << 64) * (w >> 63) for i in range(n))


def test_near_counts_are_exact(spark):
    rnd = random.Random(4)
    centres = [rnd.getrandbits(128) for _ in range(6)]
    fps = set()
    for c in centres:
        for _ in range(60):
            x = c
            for _ in range(rnd.randint(0, 4)):
                x ^= 1 << rnd.randrange(128)
            fps.add(x)
    ids = {x: i for i, x in enumerate(sorted(fps))}
    df = spark.createDataFrame([(*bit_words(x, 2)[::-1], i) for x, i in ids.items()], "high bigint, low bigint, doc_id bigint")
    for shard in (2048, 16, 2):  # the smallest makes buckets split by further blocks
        rows = fingerprints.near_counts(df, fingerprints.SimHashParams(shard_rows=shard)).collect()
        got = {((r.high & (1 << 64) - 1) << 64) | (r.low & (1 << 64) - 1): (r.n_near, r.near_doc_id) for r in rows}
        assert got == {a: (len(n), min(n)) for a in fps if (n := [ids[b] for b in fps if a != b and (a ^ b).bit_count() <= 3])}


def test_splitting_hot_buckets_is_linear(spark):
    """A bucket of m fingerprints makes rows in proportion to m, not to its square."""
    from pyspark.sql import functions as F

    from skytrace.llm import hamming

    tables = hamming.Tables(64, 4)
    made = {}
    for m in (1000, 4000):
        df = spark.range(m).select(F.shiftright(F.xxhash64("id"), 13).bitwiseAND(F.lit((1 << 51) - 1)).alias("fp"), F.col("id").alias("rep"))
        made[m] = hamming.dealt(df, tables, ["fp"], 8).count()
    assert made[4000] < 6 * made[1000]


def brute_components(rows, shingle=4, radius=4):
    fps = []
    for r in rows:
        w = (r.text or "").encode().lower().split()
        grams = [b" ".join(w[i : i + shingle]) for i in range(max(1, len(w) - shingle + 1))] if w else []
        counts = [0] * 64
        for g in grams:
            h = xxhash.xxh64_intdigest(g, 42)
            for k in range(64):
                counts[k] += h >> k & 1
        fps.append(sum(1 << k for k in range(64) if 2 * counts[k] > len(grams)))
    return fps, join(len(fps), ((i, j) for i in range(len(fps)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= radius or rows[i].doc_id is not None and rows[i].doc_id == rows[j].doc_id), [r.doc_id for r in rows])


def join(n, links, ids):
    parent = list(range(n))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        parent[root(a)] = root(b)
    low = {}
    for i in range(n):
        if ids[i] is not None:
            low[root(i)] = min(low.get(root(i), ids[i]), ids[i])
    return [low.get(root(i)) for i in range(n)]


def test_near_duplicates(documents, odd, none):
    for df in (documents, odd):
        rows = df.select("doc_id", "text").collect()
        fps, components = brute_components(rows)
        want = sorted((str(r.doc_id), f"{f:016x}", str(c)) for r, f, c in zip(rows, fps, components))
        got = neardup.near_duplicates(df).select("doc_id", neardup.hex_fingerprint().alias("h"), "component_id").collect()
        assert sorted((str(r.doc_id), r.h, str(r.component_id)) for r in got) == want
    assert neardup.near_duplicates(none).count() == 0


def test_bucket_layouts_find_all_links(spark):
    from skytrace.llm.components import components
    from skytrace.llm.hamming import dealt

    rnd = random.Random(9)
    fps = set()
    for _ in range(8):
        x = rnd.getrandbits(64)
        for _ in range(40):
            fps.add(x)
            for _ in range(rnd.randint(1, 5)):
                x ^= 1 << rnd.randrange(64)
    fps = sorted(fps)
    want = join(len(fps), ((i, j) for i in range(len(fps)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 4), list(range(len(fps))))
    df = spark.createDataFrame([(*bit_words(x, 1), i) for i, x in enumerate(fps)], "fp bigint, rep bigint")
    for n, shard, split in ((1, 2048, 8), (1, 8, 8), (1, 12, 1), (10**7, 12, 1)):
        params = neardup.NearDupParams(shard_rows=shard)
        links = dealt(df, neardup.layout(n, params), ["fp"], shard, split).mapInArrow(lambda b: neardup.bucket_links(b, 4), "a long, b long")
        found = {r.node: r.component for r in components(links).collect()}
        assert [found.get(i, i) for i in range(len(fps))] == want


def test_large_ids_keep_their_component(spark):
    rows = [(1 << 62, "same words here today"), ((1 << 63) - 1, "same words here today"), (-(1 << 63), "quite another text of five"), (None, "same words here today")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: r.component_id for r in neardup.near_duplicates(df).collect()}
    assert got == {1 << 62: 1 << 62, (1 << 63) - 1: 1 << 62, -(1 << 63): -(1 << 63), None: 1 << 62}


@given(st.lists(st.integers(0, 2**16 - 1), min_size=1, max_size=60, unique=True), st.integers(0, 2**16 - 1), st.integers(0, 6))
@settings(max_examples=80, deadline=None)
def test_bk_tree(fps, asked, radius):
    tree = neardup.BKTree()
    for i, fp in enumerate(fps):
        tree.add(fp, i)
    assert sorted(tree.within(asked, radius)) == [i for i, fp in enumerate(fps) if (fp ^ asked).bit_count() <= radius]


def shingles(text):
    w = (text or "").encode().lower().split()
    return {b" ".join(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def test_deduplicate(spark, documents, odd, none):
    rnd = random.Random(7)
    base = [" ".join(rnd.choice("abcdefghij") * rnd.randint(1, 4) + str(rnd.randrange(60)) for _ in range(120)) for _ in range(4)]
    made = []
    for t in base:
        for edits in (0, 0, 1, 2, 3, 4, 12):
            w = t.split()
            for _ in range(edits):
                w[rnd.randrange(len(w))] = f"edit{rnd.randrange(999)}"
            made.append(" ".join(w))
    near = spark.createDataFrame([(i, t) for i, t in enumerate(made)], "doc_id bigint, text string").repartition(3)
    for df in (near, documents.select("doc_id", "text")):
        rows = df.collect()
        sets = [shingles(r.text) for r in rows]
        alike = lambda a, b: a == b or len(a & b) >= 0.8 * len(a | b)
        low = join(len(rows), ((i, j) for i in range(len(rows)) for j in range(i) if alike(sets[i], sets[j])), [r.doc_id for r in rows])
        assert sorted(r.doc_id for r in neardup.deduplicate(df).collect()) == sorted(set(low))
    kept = neardup.deduplicate(odd)
    assert kept.columns == odd.columns
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(7) == 1 and 1 in ids and 2 not in ids and 5 in ids and 6 not in ids and None in ids
    assert neardup.deduplicate(none).count() == 0


def edited_group(rnd, copies, words, edits):
    base = [f"w{rnd.randrange(10**6)}" for _ in range(words)]
    made = []
    for _ in range(copies):
        w = list(base)
        for _ in range(rnd.randint(*edits)):
            w[rnd.randrange(words)] = f"e{rnd.randrange(10**6)}"
        made.append(" ".join(w))
    return made


def test_refused_forest_links_split_no_group(spark):
    rnd = random.Random(4)
    made = [t for _ in range(6) for t in edited_group(rnd, 60, 150, (1, 4))]
    sets = [shingles(t) for t in made]
    low = join(len(made), ((i, j) for i in range(len(made)) for j in range(i) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])), list(range(len(made))))
    df = spark.createDataFrame(list(enumerate(made)), "doc_id bigint, text string").repartition(3)
    for changed in ({"shard_rows": 16, "shard_shingles": 2000}, {"shard_rows": 8, "split": 1, "hub_links": 4, "broadcast_keys": 0}):
        assert sorted(r.doc_id for r in neardup.deduplicate(df, neardup.DedupParams(**changed)).collect()) == sorted(set(low))


def test_copies_near_the_limit_by_brute_force(spark):
    """420 copies that are 0.75 to 0.85 alike, a passage that many share, and all clashing names."""
    rnd = random.Random(21)
    passage = " ".join(f"p{i}" for i in range(40))
    made = [f"{passage} {t}" for _ in range(7) for t in edited_group(rnd, 60, 260, (4, 12))]
    sets = [shingles(t) for t in made]
    low = join(len(made), ((i, j) for i in range(len(made)) for j in range(i) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])), list(range(len(made))))
    names = ["id", "k1", "k2", "k1_", "k2_", "n", "n_", "id_", "hash_", "row", "size", "a", "component", "set", "table.value"]
    df = spark.createDataFrame([(i, t, *["x"] * len(names)) for i, t in enumerate(made)], ["doc_id", "text", *names]).repartition(3)
    for changed in ({}, {"shard_rows": 12, "split": 1}):
        kept = neardup.deduplicate(df, neardup.DedupParams(**changed))
        assert kept.columns == df.columns
        assert sorted(r[0] for r in kept.collect()) == sorted(set(low))


def test_repeated_passages_hide_no_copy(spark):
    rnd = random.Random(5)
    made = []
    for _ in range(5):
        body, passage = (" ".join(f"w{rnd.randrange(10**6)}" for _ in range(n)) for n in (300, 30))
        made += [f"{body} {passage}", f"{body} {' '.join([passage] * 10)}"]
    df = spark.createDataFrame(list(enumerate(made)), "doc_id bigint, text string")
    assert sorted(r.doc_id for r in neardup.deduplicate(df).collect()) == [0, 2, 4, 6, 8]


def brute_removed(rows, length=100):
    order = sorted(rows, key=lambda r: -(1 << 63) if r[0] is None else r[0])
    seen, out = set(), {}
    for doc, text in order:
        b = (text or "").encode()
        gone = [False] * len(b)
        for p in range(len(b) - length + 1):
            s = b[p : p + length]
            if s in seen:
                gone[p : p + length] = [True] * length
            seen.add(s)
        rest = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out[doc] = (len(b), sum(gone), spans, hashlib.sha256(rest).hexdigest())
    return out


def removed(df, **k):
    return {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffixdedup.remove(df, **k).collect()}


def test_suffix_dedup(spark, documents, odd, none):
    rows = documents.select("doc_id", "text").limit(80)
    assert removed(rows) == brute_removed([tuple(r) for r in rows.collect()])
    distinct = odd.where("doc_id is null or doc_id <> 7").select("doc_id", "text", "fp")
    assert removed(distinct) == brute_removed([(r.doc_id, r.text) for r in distinct.collect()])
    assert suffixdedup.remove(odd).count() == odd.count()
    assert suffixdedup.remove(none).count() == 0


def test_suffix_dedup_of_random_repeats(spark):
    rnd = random.Random(11)
    pool = ["".join(rnd.choice("abcé ") for _ in range(rnd.randint(60, 400))) for _ in range(6)] + ["ab" * 150, "z" * 260, "abc" * 90]
    rows = []
    for i in range(60):
        parts = []
        for _ in range(rnd.randint(0, 4)):
            p = rnd.choice(pool)
            a = rnd.randrange(len(p))
            parts.append(p[a : a + rnd.randint(20, 300)])
            parts.append("".join(rnd.choice("xyz") for _ in range(rnd.randint(0, 30))))
        rows.append((i * 3, "".join(parts)))
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    assert removed(df) == brute_removed(rows)
    assert removed(df, length=40) == brute_removed(rows, 40)


def test_suffix_dedup_of_hot_grams(spark, monkeypatch):
    """A passage with ever different surroundings, dealt by ranges of distance, in slices of one text."""
    rnd = random.Random(12)
    passage = "".join(rnd.choice("abcdefgh ") for _ in range(260))
    noise = lambda n: "".join(rnd.choice("uvwxyz") for _ in range(n))
    rows = [(i, noise(rnd.randint(0, 60)) + passage[rnd.choice((0, 0, 7)) : rnd.choice((260, 260, 251))] + rnd.choice(("", "same tail of some", noise(40)))) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(12)
    assert removed(df, hot=2) == brute_removed(rows)


@given(st.lists(st.lists(st.binary(max_size=40).map(lambda b: bytes(x % 3 for x in b)), max_size=12), min_size=1, max_size=6))
@settings(max_examples=120, deadline=None)
def test_loser_tree(runs):
    runs = [sorted(r) for r in runs]
    prefixes = [[0, *(suffixdedup.common_prefix(a, b, 0) for a, b in zip(r, r[1:]))][: len(r)] for r in runs]
    source, lcp = suffixdedup.loser_tree(list(zip(runs, prefixes)))
    at = [0] * len(runs)
    out = []
    for s in source:
        out.append(runs[s][at[s]])
        at[s] += 1
    assert out == sorted(x for r in runs for x in r)
    assert lcp[1:] == [suffixdedup.common_prefix(a, b, 0) for a, b in zip(out, out[1:])]
