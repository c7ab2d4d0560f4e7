"""Every registered query against its DuckDB oracle (small scale factor)."""
import pytest

import __spark_entry__ as E
from hospiq.oracle.compare import compare, duckdb_views

from .conftest import SF_SMALL

QUERIES = E.queries()
ORACLE = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duckdb_views(SF_SMALL)


@pytest.mark.parametrize("qid", sorted(ORACLE))
def test_query_matches_oracle(spark, con, qid):
    ok, ns, no, msg = compare(QUERIES[qid](spark, SF_SMALL), con, ORACLE[qid])
    assert ok, f"{qid}: spark {ns} rows vs oracle {no}: {msg}"


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() >= 0
    assert "hospital_id" in df.columns


def test_queries_without_oracle_run(spark):
    for qid in sorted(set(QUERIES) - set(ORACLE)):
        assert QUERIES[qid](spark, SF_SMALL).count() >= 0, qid
