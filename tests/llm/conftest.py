import pytest

EDGE = [
    (1, "The quick brown fox jumps over the lazy dog again and again in the park.\nSecond line of this text here.", "en", "a"),
    (2, "The quick brown fox jumps over the lazy dog again and again in the park.\nSecond line of this text here.", "en", "a"),
    (3, None, None, None),
    (4, "", "en", "a"),
    (5, " \t\n ", "de", "b"),
    (6, "one", "en", "b"),
    (7, "one two", None, "b"),
    (None, "A text without an id that is long enough to count for something.", "en", "c"),
    (8, "Der schnelle braune Fuchs springt über den faulen Hund und läuft dann weit weg.", "de", "c"),
    (8, "Der schnelle braune Fuchs springt über den faulen Hund und läuft dann weit weg.", "de", "c"),
    (8, "Another text under an id that is used twice already, with other words.", "en", "c"),
    (9, "word " * 5000 + "end", "en", "a"),
    (10, "###$$$ %%% &&&&\n| a | b |\n| a | b |\n!!! 123 <x>", "en", None),
]
SCHEMA = "doc_id long, text string, lang string, source string"


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls, blanks, repeated rows and ids, a long text, and extra columns whose names operators also use."""
    from pyspark.sql import functions as F
    docs = spark.createDataFrame(EDGE, SCHEMA).withColumn("n_chars", F.length("text").cast("long"))
    for name in ("id", "fp", "size", "row", "bucket", "length", "n_words", "kept", "rank", "key"):
        docs = docs.withColumn(name, F.lit("x"))
    return docs


@pytest.fixture(scope="session")
def no_docs(edge_docs):
    return edge_docs.limit(0)


@pytest.fixture(scope="session")
def small(spark):
    return "/root/testdata/sf0.001"
