import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from ledgermatch.session import build_session
    s = build_session("local[4]", 8, extra={"spark.driver.memory": "4g"})
    yield s


def rows(df, *cols):
    """Sorted list of tuples (selected columns) for order-free assertions."""
    d = df.select(*cols) if cols else df
    return sorted([tuple(r) for r in d.collect()], key=lambda t: tuple(str(x) for x in t))
