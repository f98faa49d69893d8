import sys
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(Path(__file__).resolve().parent)]

from corpus_health.params import Params  # noqa: E402
from corpus_health.session import configure  # noqa: E402

PARAMS = Params(migrated_at=datetime(2020, 1, 1), as_of=datetime(2021, 6, 30))

FILE = (
    "site string, site_url string, library string, folder string, file_name string, ext string,"
    " size_bytes bigint, modified_ts timestamp_ntz, modified_by string, path string"
)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        configure(SparkSession.builder)
        .master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "6g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def params():
    return PARAMS


@pytest.fixture
def frame(spark):
    """frame("a int, b string", (1, "x"), ...) -> DataFrame"""
    return lambda ddl, *rows: spark.createDataFrame(list(rows), ddl)


@pytest.fixture
def files(spark):
    """Enriched file rows from keyword dicts; whatever is not given has a plain value."""
    from corpus_health.operators import clean

    def make(*rows, params=PARAMS):
        plain = dict(
            site="A", site_url="https://t/sites/a", library="Documents", folder="Documents/X",
            file_name="f.pdf", size_bytes=1, modified_ts=datetime(2019, 5, 5), modified_by="u",
            path=None,
        )
        full = []
        for row in rows:
            r = {**plain, **row}
            name = r["file_name"] or ""
            r.setdefault("ext", name.rsplit(".", 1)[1].lower() if "." in name else "")
            r["path"] = r["path"] or f"{r['site_url'][9:]}/{r['folder']}/{name}"
            full.append(tuple(r[n.split()[0]] for n in FILE.split(", ")))
        return clean.enrich(spark.createDataFrame(full, FILE), params).withColumn(
            "checked_out", __import__("pyspark.sql.functions", fromlist=["lit"]).lit(False)
        )

    return make


def collect(df, *names):
    names = names or df.columns
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=str)
