import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from ledgerwatch.session import get_session
    s = get_session("local[4]", shuffle_partitions=4, app_name="ledgerwatch-tests")
    yield s
    s.stop()


def ts(s: str):
    import datetime as dt
    return dt.datetime.strptime(s, "%Y-%m-%d %H:%M:%S") if len(s) > 10 else dt.datetime.strptime(s, "%Y-%m-%d")
