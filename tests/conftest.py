import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from basketrec.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = local_session(4, shuffle_partitions=4, app="basketrec-tests")
    yield s
    s.stop()


@pytest.fixture
def scratch(spark):
    from basketrec.session import scratch_path

    counter = iter(range(10**6))
    return lambda name="t": scratch_path(spark, f"{name}{next(counter)}")
