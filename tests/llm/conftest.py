import pytest
from pyspark.sql import types as T

DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)

WORDS = "alpha bravo charlie delta echo foxtrot golf hotel india juliet kilo lima mike november oscar papa".split()


def prose(seed: int, words: int) -> str:
    """Words in an order that no other seed repeats."""
    state, out = seed * 7919 + 1, []
    for _ in range(words):
        state = (state * 6364136223846793005 + 1442695040888963407) % 2**64
        out.append(WORDS[state >> 60] + str((state >> 40) % 50))
    return " ".join(out)


#: Rows that every operator must take: nulls, empty and blank texts, a long one, repeated and equal rows.
ODD = [
    (1, None, None, None, None),
    (2, "", "en", "a", 0),
    (3, " \t\n \r\n", "en", "a", 6),
    (4, prose(4, 30_000), "en", "a", None),
    (5, prose(5, 80), "en", "a", 400),
    (5, prose(5, 80), "en", "a", 400),
    (6, prose(5, 80), "en", None, 400),
    (7, "日本語のテキスト。\u0000 ÉÀ ß 😀", "ja", "b", 12),
    (None, prose(8, 40), None, None, None),
    (None, None, None, None, None),
    (9, prose(5, 80), None, "b", 400),
    (9, prose(9, 60), None, "b", 300),
]


@pytest.fixture
def odd(spark):
    return spark.createDataFrame(ODD, DOCUMENTS)


@pytest.fixture
def none(spark):
    return spark.createDataFrame([], DOCUMENTS)


@pytest.fixture
def documents(spark, testdata):
    return spark.read.parquet(f"{testdata}/documents.parquet")


@pytest.fixture
def labels(spark, testdata):
    return spark.read.parquet(f"{testdata}/labels.parquet")


@pytest.fixture
def pages(spark, testdata):
    return spark.read.parquet(f"{testdata}/pages.parquet")


@pytest.fixture
def benchmark_items(spark, testdata):
    return spark.read.parquet(f"{testdata}/benchmark.parquet")


def clashing(df):
    """``df`` with columns named like those that operators add."""
    from pyspark.sql import functions as F

    names = ["score_", "text_hash", "dropped", "_set", "key", "n_dropped", "_place", "_join_hash", "set"]
    return df.select("*", *[F.lit(1).alias(n) for n in names])
