import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from opsflow.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = local_session(cores=4, shuffle_partitions=4, app="opsflow-tests", driver_memory="4g")
    s.sparkContext.setLogLevel("ERROR")
    yield s


def rows(df, *cols):
    """Sorted list of tuples (None-safe)."""
    sel = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in sel.collect()), key=lambda t: tuple((x is None, str(x)) for x in t))
