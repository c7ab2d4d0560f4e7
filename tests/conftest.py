import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from hospiq.session import build_session
    ckpt = tempfile.mkdtemp(prefix="hospiq-test-ckpt-")
    s = build_session("local[4]", shuffle_partitions=8,
                      extra={"spark.checkpoint.dir": ckpt, "spark.driver.memory": "4g"})
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="hospiq-test-")


def rows(df, *cols):
    """Collect as a list of tuples (selected columns, sorted)."""
    sel = df.select(*cols) if cols else df
    return sorted(tuple(r) for r in sel.collect())
