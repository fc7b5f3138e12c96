import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from forecastry.session import get_session  # noqa: E402

SMOKE = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = get_session(app="forecastry-tests", master="local[*]", shuffle_partitions=8)
    yield s
    s.stop()


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
