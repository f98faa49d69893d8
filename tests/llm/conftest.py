import duckdb
import pytest

SMALL = "/root/testdata/sf0.001"

#: Columns that operators use inside, under their names.
CLASH = "row, unit, label, n, key, place, copy, shard, _row, _doc, _key, _of, _source, _id, _text, _stays, score, kept"
LONG = " ".join(f"word{i % 977} and thing{i}." for i in range(30_000))
ODD = [
    (1, None, None, None, None),
    (2, "", "en", "a", 0),
    (3, " \n\t ", "en", "a", 4),
    (4, "one two three", "en", None, 13),
    (5, "one two three", None, "a", 13),
    (5, "one two three", None, "a", 13),
    (None, "Ünïcode — text 😀 with ten words in it, and one more.", "de", "b", 50),
    (None, None, "de", "b", None),
    (6, LONG, "en", "a", len(LONG)),
    (7, LONG + " end", "en", "a", len(LONG) + 4),
    (8, "same line\n" * 300, "fr", "b", 3000),
    (9, "12345 67890 !!! ???", "fr", "b", 19),
    (10, "x" * 50_000, "fr", "c", 50_000),
]
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="session")
def texts(docs):
    return {r.doc_id: r.text for r in docs.collect()}


@pytest.fixture
def odd(spark):
    """Nulls, empty, blank, long and repeated texts, repeated and null ids."""
    return spark.createDataFrame(ODD, SCHEMA)


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture
def clashing(odd):
    """The odd rows with more columns, named like what operators use inside."""
    for name in CLASH.split(", "):
        odd = odd.selectExpr("*", f"'mine' as {name}")
    return odd


@pytest.fixture
def few(spark):
    """few((id, text), ...) -> documents"""
    return lambda *rows: spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], SCHEMA)


@pytest.fixture(scope="session")
def sql():
    """Rows of a DuckDB query over the smallest tables, as sorted tuples by column name."""

    def run(text):
        c = duckdb.connect()
        c.execute(f"create view documents as select * from '{SMALL}/documents.parquet'")
        found = c.sql(text)
        names = sorted(found.columns)
        at = [found.columns.index(n) for n in names]
        return names, sorted(tuple(r[i] for i in at) for r in found.fetchall())

    return run


def rows_of(df):
    names = sorted(df.columns)
    return names, sorted(tuple(r[n] for n in names) for r in df.collect())
