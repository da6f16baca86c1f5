import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, n_words string, size double, fp string, kept string"


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls everywhere, empty and long texts, ties, repeated rows, and extra columns whose names clash."""
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa".split()
    long = " ".join(words[(i * 7 + i // 10) % 10] + str(i % 97) for i in range(6000))
    plain = "the cat sat on the mat and looked at the dog who was asleep in the sun all day long"
    rows = [
        (1, plain, "en", "a"),
        (2, plain, "en", "a"),
        (3, None, "en", None),
        (4, "", None, "b"),
        (None, "no id here at all", None, None),
        (5, long, "en", "b"),
        (6, long[:-9] + "x changed", "en", "c"),
        (7, "same row", None, "c"),
        (7, "same row", None, "c"),
        (8, "   \t\n ", "xx", ""),
        (9, "password = 'Abcdef123456789' und <|endoftext|> é日本", "de", "é"),
        (10, "x" * 5000, "en", "a"),
    ]
    return spark.createDataFrame([(i, t, lang, s, len(t or ""), "clash", 1.5, "clash", "clash") for i, t, lang, s in rows], DOCS).repartition(3)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def documents(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet").repartition(3)
