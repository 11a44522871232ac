import os
import sys
import time

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from millrace.session import local_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, **{"spark.driver.memory": "8g", "spark.sql.shuffle.partitions": "4", "spark.default.parallelism": "4"})
    yield session
    session.stop()


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def wait_until(done, seconds: float = 90) -> None:
    """Wait for a running query to get somewhere; a rate source starts empty."""
    deadline = time.monotonic() + seconds
    while not done() and time.monotonic() < deadline:
        time.sleep(0.3)
