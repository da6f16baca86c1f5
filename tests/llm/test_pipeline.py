"""The pipeline and the registered queries."""

from collections import Counter

import corpus_pipeline as pipeline
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from skytrace.llm import neardup, quality, queries, secrets


def test_stages_take_effect(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    names = docs.columns
    before = {r.doc_id: r for r in docs.collect()}
    good = pipeline.quality_rules(spark, docs, sf)
    assert good.columns == names
    want = {r.doc_id for r in quality.judge(docs).where("kept").collect()}
    assert {r.doc_id for r in good.collect()} == want
    one = pipeline.simhash_near_dedup(spark, good, sf)
    assert one.columns == names
    assert {r.doc_id for r in one.collect()} == {r.doc_id for r in neardup.deduplicate(good).collect()}
    safe = pipeline.secret_scans(spark, one, sf)
    assert safe.columns == names
    for r in safe.collect():
        assert not secrets.base_spans(r.text) and r.n_chars == len(r.text)
        if not secrets.find_secrets(before[r.doc_id].text)[1]:
            assert r == before[r.doc_id]
    mixed = pipeline.mix_sources(spark, safe, sf)
    assert mixed.columns == names
    assert max(Counter(r.doc_id for r in mixed.collect()).values()) <= 2


def test_run(spark, sf):
    rows = pipeline.run(spark, sf).collect()
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for _, stage in pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf)
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = Counter()
    for r in docs.collect():
        want[r.doc_id] += len(tok.encode(r.text, add_special_tokens=False).ids) + 1
    got = Counter()
    for r in rows:
        got[r.doc_id] += r.length
    assert got == want


def test_stages_over_odd_rows(spark, odd, none, sf, tmp_path):
    """Nulls, empty and long texts, repeated rows, clashing names and empty tables, each stage on what the one before wrote."""
    more = odd.withColumns({c: F.lit(c) for c in ("k1", "row", "spans", "size", "kept", "id", "h1", "a.b", "copies")})
    for name, docs in (("odd", more), ("none", more.limit(0))):
        for i, (stage, run) in enumerate(pipeline.STAGES[:-1]):
            out = run(spark, docs, sf)
            assert out.schema.names == docs.schema.names and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema], stage
            out.write.parquet(f"{tmp_path}/{name}{i}")
            kept = spark.read.parquet(f"{tmp_path}/{name}{i}")
            assert all(r["a.b"] == "a.b" and r["kept"] == "kept" for r in kept.collect())
            if name == "none":
                assert kept.count() == 0
            elif stage == "quality_rules":
                assert {r.doc_id for r in kept.collect()} <= {5, 6}  # the others have under 50 words
                kept = more  # the next stages get all rows
            elif stage == "simhash_near_dedup":
                ids = [r.doc_id for r in kept.collect()]
                # 1 and 2, 3, 4 and 8, 5 and 6, and 7 twice are copies
                assert sorted(map(str, ids)) == sorted(map(str, [1, 3, 5, 7, 9, 10, None]))
            elif stage == "secret_scans":
                texts = {r.doc_id: r.text for r in kept.collect()}
                assert "Abcdef123456789" not in texts[9] and "<|endoftext|>" in texts[9] and texts[3] is None
            docs = kept
        pieces = pipeline.STAGES[-1][1](spark, docs, sf).collect()
        assert {r.doc_id for r in pieces} == {r.doc_id for r in docs.collect()}


def test_redaction(odd, none):
    rows = secrets.scan(odd, redact=True).collect()
    assert len(rows) == odd.count() and all(not secrets.base_spans(r.text or "") for r in rows)
    assert secrets.scan(none, redact=True).count() == 0


def test_names():
    assert [n for n, _ in pipeline.STAGES] == ["quality_rules", "simhash_near_dedup", "secret_scans", "mix_sources", "pack_sequences"]
    assert [f"op{i}" for i in range(1, 11)] == [n.split("_")[0] for n in queries.queries()]


def test_sql_twins(spark, sf, odd, tmp_path):
    import duckdb

    odd.where("doc_id is null or doc_id <> 7").write.parquet(f"{tmp_path}/documents.parquet")
    for d in (sf.replace("sf0.001", "sf0.01"), str(tmp_path)):
        con = duckdb.connect()
        con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{d}/documents.parquet{'/*.parquet' if d == str(tmp_path) else ''}')")
        for name, text in queries.oracle_sql().items():
            df = queries.queries()[name](spark, d)
            twin = con.execute(text)
            names = [c[0] for c in twin.description]
            assert sorted(names) == sorted(df.columns)
            assert sorted(map(str, twin.fetchall())) == sorted(str(tuple(r)) for r in df.select(*names).collect())
