import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from tidemark.session import build_session, checkpoint_dir

    s = build_session(master="local[8]", shuffle_partitions=8, app_name="tidemark-tests")
    s.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(s)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def fixture_wh(spark):
    from tidemark.sources.fixture import fixture_warehouse

    return fixture_warehouse(spark)
