"""A training-corpus pipeline: each stage applies one operator to all that its predecessor kept.

``STAGES`` are (name, function) pairs.  A function takes (spark, docs, sf_dir) and
returns a DataFrame, which is written as Parquet and read again as the next
one's ``docs``.  All but the last keep the columns of ``documents``, and any others
whatever their names.

Defined cases: null and empty texts fail the quality rule; where a stage gets such
texts all the same, those without words are copies of each other, hold no secret,
are taken once and packed as their end mark.  Repeated rows are copies, and one
stays.  Rows without id or source are treated as any other, the former yielding to
copies with an id.  Empty tables stay empty and keep their columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skytrace.llm import mixing, neardup, packing, quality, secrets
from skytrace.llm.common import materialise, quoted, table
from skytrace.llm.queries import tokenizer_path


def apart(docs: DataFrame, names: list[str]) -> tuple[DataFrame, list]:
    """``docs`` with other names for columns that an operator would replace, and how to select them back."""
    other = {c: f"{c} of documents" for c in docs.columns if c in names}
    back = [x.alias(c) for c, x in zip(docs.columns, quoted([other.get(c, c) for c in docs.columns]))]
    return docs.withColumnsRenamed(other), back


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rule or diverge from their language's reference go."""
    safe, back = apart(docs, quality.NAMES)
    return quality.judge(safe).where("kept").select(*back)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the row with the smallest id (then text) stays.

    Shingles of five words; a link stands if the fingerprints are near and the
    shingle sets are at least 0.8 alike.
    """
    return neardup.deduplicate(docs)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret is replaced by a placeholder; ``n_chars`` follows the text."""
    safe, back = apart(docs, secrets.NAMES)
    clean = secrets.scan(safe, redact=True)
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.when(F.col("spans") == "", F.col("n_chars")).otherwise(F.char_length("text")).cast(docs.schema["n_chars"].dataType))
    return clean.select(*back)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mix(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 2048 tokens."""
    return packing.pack(docs, tokenizer_path("byte_bpe_50k.json"))


STAGES = [
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", simhash_near_dedup),
    ("secret_scans", secret_scans),
    ("mix_sources", mix_sources),
    ("pack_sequences", pack_sequences),
]

#: Fingerprints, entropy balancing and packing have no SQL form; tests hold ``run`` against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
