import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from strata.session import local_session
    s = local_session("strata-tests", "*", extra={"spark.sql.shuffle.partitions": "8"})
    yield s
    s.stop()


def rows(df, *cols):
    """Sorted list of tuples (selected columns or all)."""
    if cols:
        df = df.select(*cols)
    return sorted((tuple(r) for r in df.collect()),
                  key=lambda t: tuple((x is not None, x if x is not None else 0) for x in t))
