import pytest

from bazaar.llm.common import documents


@pytest.fixture(scope="session")
def docs(spark):
    return documents(spark, "/root/testdata/sf0.001").cache()


LONG = "lorem ipsum dolor sit amet consectetur " * 4000


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty, blank and very long texts, repeated rows, extra columns of clashing names."""
    rows = [
        (1, None, "en", "a", 0), (2, "", "en", None, 0), (3, " \t\n ", None, "a", 4), (None, "only words here", "en", "a", 15),
        (None, None, None, None, None), (5, LONG, "en", "a", len(LONG)), (6, "same text twice " * 20, "en", "b", 1),
        (6, "same text twice " * 20, "en", "b", 1), (7, "same text twice " * 20, "en", "b", 1), (8, "x", "de", "b", 1),
        (9, "12345 67890 !!!", "de", "c", 15), (10, "Ünï ▁çódé 中文 🎉 \x00  end", "fr", "c", 20),
    ]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    from pyspark.sql import functions as F

    extra = ["kept", "fp", "k", "h", "host", "_id", "_text", "spans", "words", "component_id", "ids", "n_tokens", "at", "shard", "copies"]
    return frame.withColumns({c: F.lit("clash") for c in extra}).cache()


@pytest.fixture(scope="session")
def empty(odd):
    return odd.limit(0)
