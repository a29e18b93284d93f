"""Driver contract: entry smoke + every registered query against its SQL oracle."""
import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from pulsehouse.plans.oracle_queries import ORACLE

TABLES = ["nation", "customer", "events"]


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows),
                  key=lambda t: tuple((x is None, str(x)) for x in t))


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 5
    assert df.columns == ["service", "total_requests", "total_errors", "error_rate_pct",
                          "avg_p95_latency_ms", "user_events"]


def test_oracle_keys_subset_of_queries():
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF_SMALL, t)}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, duck, name):
    sdf = E.queries()[name](spark, SF_SMALL)
    res = duck.execute(E.oracle_sql()[name])
    d_cols = [d[0] for d in res.description]
    assert sorted(sdf.columns) == sorted(d_cols)
    assert _canon(sdf.columns, [tuple(r) for r in sdf.collect()]) == _canon(d_cols, res.fetchall())


def test_session_time_zone_is_pinned_for_queries(spark):
    """A caller's session in another time zone gets UTC-derived dates/hours."""
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        rows = E.queries()["error_rate_trend"](spark, SF_SMALL).collect()
        assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
        assert rows[0].label == "2024-01-01 00:00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
