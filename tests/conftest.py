import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from demand.session import local_session
    s = local_session("*", shuffle_partitions=8, app="demand-tests")
    yield s
    s.stop()


def cells_df(spark, rows):
    """Cells from (debtorcode, category, projno, y, month_year) tuples."""
    return spark.createDataFrame(rows, "debtorcode string, category string, projno string, y double, month_year string")


def months(start_year, start_month, n):
    out = []
    y, m = start_year, start_month
    for _ in range(n):
        out.append(f"{y:04d}-{m:02d}")
        m += 1
        if m > 12:
            y, m = y + 1, 1
    return out
