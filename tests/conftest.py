import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from keyfold.session import get_spark
    s = get_spark("local[4]", app="keyfold-tests", shuffle_partitions=4)
    yield s


def rows(df, *cols):
    """Sorted list of tuples of the given columns."""
    cols = cols or tuple(df.columns)
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=lambda t: tuple(str(x) for x in t))
