import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pagemill.session import local_session
    s = local_session(cores=4, shuffle_partitions=4, app="pagemill-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    from tools.oracle_check import duck as connect
    return connect(SF001)


def rows(df, *cols):
    return [tuple(r[c] for c in cols) for r in df.collect()]
