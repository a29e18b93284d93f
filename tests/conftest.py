import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from pulsehouse.schemas import BRONZE  # noqa: E402
from pulsehouse.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", app="pulsehouse-tests", shuffle_partitions=4,
                      extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="pulsehouse-tests-")})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


def ev(event_id="e1", ts="2026-06-17T12:00:01.500000+00:00", service="auth-api",
       endpoint="/login", method="GET", status=200, latency=10, user="user_1",
       region="us-east-1", ip="10.0.0.1", err=None):
    return (event_id, ts, service, endpoint, method, status, latency, user, region, ip, err)


@pytest.fixture
def bronze_df(spark):
    def make(rows):
        return spark.createDataFrame(rows, BRONZE)
    return make
