import duckdb
import pytest

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id long, row string, kept string, hash int, n_bytes int, size string, base int, t string, nth int, lane int"
CLASH = (1, "x", "y", 2, 3, "z", 4, "u", 5, 6)


def edge_rows():
    long = " ".join(f"w{k % 977}" for k in range(60_000))
    texts = [
        (1, "The quick brown fox of the house is in the garden and it was good for us", "a"),
        (2, "the quick\tbrown fox of the  house is in the garden and it was good for us", "a"),
        (3, "The quick\nbrown fox of the \r\n house is in the garden and it was good for us", None),
        (4, None, "b"), (5, "", "b"), (6, " \t\n", None), (7, long, "c"), (7, long, "c"), (8, long, "c"),
        (None, "no id here", "a"), (None, "no id here", None), (None, None, None), (None, long, "a"),
        (9, "  café   naïve \U0001f600", "\U0001f600"), (9, "same id, other text", "z"), (10, "no id here", "a"),
        (11, "one", "a"), (12, "one two", "a"), (13, "ONE TWO", "a"),
    ]
    return [(i, t, None, s, None, *CLASH) for i, t, s in texts]


@pytest.fixture(scope="session")
def edge_docs(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA).repartition(4).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


def table(name):
    return duckdb.sql(f"SELECT * FROM read_parquet('{SMALL}/{name}.parquet')").fetchall()


@pytest.fixture(scope="session")
def rows_of():
    return lambda name: table(name)
