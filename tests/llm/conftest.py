import pytest
from pyspark.sql import types as T

from civiq.session import apply_settings

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # Names that the operators use themselves.
    T.StructField("id", T.StringType()), T.StructField("fp", T.StringType()), T.StructField("found", T.StringType()),
    T.StructField("digest", T.StringType()), T.StructField("removed", T.StringType()),
])
LONG = " ".join(f"word{i % 977} stone{i % 31}" for i in range(30_000))
PASSAGE = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen"
ODD = [
    (1, f"{PASSAGE} alpha beta\nshared line of seven plain words here", "en"),
    (2, f"gamma delta {PASSAGE}\nshared line of seven plain words here", "en"),
    (2, f"gamma delta {PASSAGE}\nshared line of seven plain words here", "en"),
    (3, None, "en"), (4, "", None), (5, " \t\n\n ", "fr"), (6, "!!! 123 ...", "fr"),
    (7, LONG, "en"), (8, LONG, "en"), (9, "kurz", "de"), (10, "kurz", "de"), (None, "ohne Nummer kurz", "de"), (None, None, None),
    (11, "Ünïcödé 漢字 \U0001F600 é   x", "fr"),
]


@pytest.fixture(scope="session")
def llm(spark):
    return apply_settings(spark)


@pytest.fixture(scope="session")
def make(llm):
    def build(rows):
        return llm.createDataFrame([(i, t, g, "s", len(t or ""), "i", "f", "x", "d", "r") for i, t, g in rows], SCHEMA)

    return build


@pytest.fixture(scope="session")
def odd(make):
    return make(ODD)


@pytest.fixture(scope="session")
def none(make):
    return make([])
