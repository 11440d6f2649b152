"""Every registered query against its DuckDB twin on the sf0.001 tables
(the same three checks the driver makes: columns, rows, value hash)."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(__file__)), "tools"))

import __spark_entry__ as E  # noqa: E402
from oracle_check import digest  # noqa: E402
from recspark.plans.catalog import REGISTRY  # noqa: E402
from recspark.plans.oracle import SQL  # noqa: E402
from recspark.plans.standins import TABLES  # noqa: E402

SF = "/root/testdata/sf0.001"
NAMES = sorted(SQL)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


# signal processing has no SQL form; it is checked against its own fixtures
NO_SQL = {"signal_chunks"}


def test_every_query_has_sql():
    missing = set(REGISTRY) - set(SQL)
    assert missing == NO_SQL, missing


def test_signal_query_rows(spark, con):
    df = E.queries()["signal_chunks"](spark, SF)
    n_events = con.execute("SELECT count(*) FROM events").fetchall()[0][0]
    rows = df.select("n_values", "seizure_state", "data_type").collect()
    assert len(rows) == 3 * n_events
    assert {r["n_values"] for r in rows} == {256}
    assert {r["data_type"] for r in rows} == {0, 1, 3}


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(E.oracle_sql()[name])
    cols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(df.columns) == sorted(cols)
    assert len(rows) == len(drows)
    assert digest(df.columns, rows)[0] == digest(cols, drows)[0]


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["event_id", "patient_id", "chunk_start_ts", "seizure_state"]
