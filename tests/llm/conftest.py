import pytest
from pyspark.sql import types as T

WIDE = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # Names that the operators use for their results.
    T.StructField("row", T.StringType()), T.StructField("Kept", T.StringType()), T.StructField("score", T.StringType()),
    T.StructField("mix_slot", T.StringType()), T.StructField("ids", T.StringType()), T.StructField("spans", T.StringType()),
])
BASE = "the quick brown fox jumps over the lazy dog and then walks home along the river where many other foxes live " * 2


def odd_rows():
    """NULLs in every column, empty and blank texts, ties, repeated rows, and one very long text."""
    extra = ("r", "k", "s", "m", "i", "p")
    texts = [None, "", "  \n\t ", "one", "One", BASE, BASE.replace(" ", "\n"), BASE + "end", "1234", "été über ñandú 日本語 🙂",
             "mail me at jo.doe@example.org or +1 (201) 555-0123, card 4539578763621486, host 10.0.0.7 end", "word " * 40_000]
    rows = [(at, text, "en" if at % 2 else "de", f"s{at % 2}", len(text or ""), *extra) for at, text in enumerate(texts)]
    rows += [rows[5], rows[5], (None, BASE, None, None, None, *[None] * 6), (None, None, None, None, None, *[None] * 6), (99, None, "en", None, 0, *extra)]
    return rows


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(odd_rows(), WIDE)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], WIDE)
