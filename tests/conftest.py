import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from tapehouse.session import build_session

    s = build_session(
        app_name="tapehouse-tests",
        master="local[4]",
        conf={
            "spark.sql.shuffle.partitions": "4",
            "spark.default.parallelism": "4",
            "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="tapehouse-wh-", dir="/tmp"),
        },
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="tapehouse-test-", dir="/tmp")


def rows(df, *cols):
    """Collect as sorted tuples of the given columns (all when none given)."""
    cols = cols or tuple(df.columns)
    return sorted(tuple(r[c] for c in cols) for r in df.select(*cols).collect())
