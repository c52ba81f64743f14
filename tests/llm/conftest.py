import pytest

SF = "/root/testdata/sf0.001"
LONG = "the quick brown fox jumps over the lazy dog " * 60_000


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Null ids, texts and labels, empty and long texts, repeated rows, and columns that results could clash with."""
    rows = [
        (1, "The cat sat on the mat and looked at the moon.", "en", 7, "x"),
        (1, "The cat sat on the mat and looked at the moon.", "en", 7, "x"),
        (2, None, "en", None, None),
        (3, "", None, 1, "y"),
        (4, " \n\t ", "fr", 1, "y"),
        (None, "Le chat dort sur le tapis et regarde la lune.", "fr", 2, None),
        (5, LONG, "en", 3, "z"),
        (6, "12345 !!! ...", None, None, "z"),
        (7, "le soleil et la lune sont dans le ciel", "fr", 4, "w"),
    ]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, score int, spans string")


@pytest.fixture(scope="session")
def no_docs(spark, odd_docs):
    return spark.createDataFrame([], odd_docs.schema)


@pytest.fixture(scope="session")
def documents(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
