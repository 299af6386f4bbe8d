"""Every registered query against its SQL twin in DuckDB."""

import glob
import os

import duckdb
import pandas as pd
import pytest

from skyflux.plans import registry

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the driver's tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in glob.glob(f"{DATA}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


def plain(df: pd.DataFrame) -> list[tuple]:
    def value(v):
        if v is None or v is pd.NaT or v is pd.NA or v != v:
            return "null"
        return repr(float(v)) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)

    df = df.reindex(sorted(df.columns), axis=1).astype(object)
    return sorted(tuple(value(v) for v in row) for row in df.itertuples(index=False))


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, duck, name):
    ours = registry.queries()[name](spark, DATA).toPandas()
    theirs = duck.execute(registry.oracle_sql()[name]).fetchdf()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert plain(ours) == plain(theirs)


ODD = """SELECT row_number() OVER () AS event_id, d + INTERVAL 5 HOUR AS ts, u::BIGINT AS user_id, 'click' AS event_type, v AS value, '{}' AS props FROM (VALUES
(TIMESTAMP '2024-01-01', 0, 0.0::DOUBLE), (TIMESTAMP '2024-01-02', 0, 0.0), (TIMESTAMP '2024-01-02', 0, 20.0), (TIMESTAMP '2024-01-01', 1, NULL), (NULL, 2, 40.0), (NULL, 2, 50.0),
(TIMESTAMP '2024-01-01', NULL, 40.0), (TIMESTAMP '2024-01-01', NULL, 55.0), (TIMESTAMP '2024-01-01', 3, -5000.0), (TIMESTAMP '2024-01-01', 4, 'NaN'), (TIMESTAMP '2024-01-01', 5, '-Infinity'), (TIMESTAMP '2024-01-01', 5, 30.0)) t(d, u, v)"""


def test_odd_bins(spark, tmp_path):
    """Bins without strengths, without keys and with strengths of nothing, NaN and -Infinity; a null isn't a NaN."""
    con = duckdb.connect()
    con.execute(f"COPY ({ODD}) TO '{tmp_path}/events.parquet'")
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet'")
    ours = [tuple(row) for row in registry.queries()["s4_by_bin"](spark, str(tmp_path)).collect()]
    theirs = con.execute(registry.oracle_sql()["s4_by_bin"]).fetchall()
    assert sorted(map(repr, ours)) == sorted(map(repr, theirs))


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
