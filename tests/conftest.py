import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from brook.session import local_session  # noqa: E402
from feeds import READINGS, SF, sensor_frame  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, 4, **{"spark.sql.streaming.noDataMicroBatches.enabled": "true"})
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF


@pytest.fixture(scope="session")
def readings(spark):
    # Arrival is the position, so the order is that of the file.
    return sensor_frame(spark, [(*r, 10 + i) for i, r in enumerate(READINGS)]).cache()
