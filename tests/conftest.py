import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from tidemark.session import build_session

    s = build_session("local[4]", app="tidemark-tests", shuffle_partitions=8)
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def tmp(spark):
    """Fresh folder for one test (never reused, never removed mid-run)."""
    from tidemark.session import work_dir

    return work_dir(spark, "test")


@pytest.fixture()
def local_tmp():
    return tempfile.mkdtemp(prefix="tidemark-test-")
