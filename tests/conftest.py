import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session", autouse=True)
def few_trees():
    """The tests check what holds for any number of trees; the registered queries fit 300."""
    from tablewise.plans import q_model, q_monitor
    q_model.QUERY_TREES = 15
    q_monitor.MONITOR_TREES = 5


@pytest.fixture(scope="session")
def spark():
    from tablewise.session import get_session
    s = get_session("local[4]", "tablewise-tests", shuffle_partitions=4)
    yield s
    s.stop()


@pytest.fixture()
def tmp_out(tmp_path):
    return str(tmp_path)
