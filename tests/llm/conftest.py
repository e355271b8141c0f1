import pytest
from pyspark.sql import functions as F

CLASH = ["key", "row", "spans", "n_words", "kept", "score", "shard", "bands", "_found", "label", "slot", "c"]


@pytest.fixture(scope="session", autouse=True)
def few_partitions(spark):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", old)


@pytest.fixture(scope="session")
def docs_of(spark):
    """A table of documents with extra columns whose names the operators use themselves."""

    def make(rows, lang="en"):
        df = spark.createDataFrame(list(rows), "doc_id long, text string").coalesce(2)
        return df.withColumns({"lang": F.lit(lang)} | {c: F.lit("other") for c in CLASH})

    return make


PROSE = (
    "the river ran past the old mill and down to the sea where small boats lay at anchor in the grey light of "
    "morning while gulls cried over the harbour wall and men mended nets beside the road to the village"
).split()


@pytest.fixture(scope="session")
def odd_rows():
    """Null, empty, blank and long texts, repeated rows, a null id and ties."""
    base = " ".join(PROSE)
    return [
        (1, base), (2, None), (3, ""), (4, " \t\n "), (None, base + " x"), (5, base), (5, base), (6, "one"), (7, "one"),
        (8, " ".join(PROSE[:4])), (9, "z" * 50_000), (10, " ".join(PROSE * 400)), (11, base.upper()), (12, "é ü 𝄞 ▁ \u0000 #*$"),
    ]
