import os
import sys
import tempfile

import pytest

from golden import GOLDEN

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from wearcast.session import local_session

    s = local_session("4", app="wearcast-tests", **{"spark.sql.shuffle.partitions": "8",
                                                      "spark.checkpoint.dir": tempfile.mkdtemp(prefix="wc-ckpt-")})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def golden(spark):
    rows = [(f"r{i + 1}", *g) for i, g in enumerate(GOLDEN)]
    return spark.createDataFrame(
        rows,
        "reading_id string, air_temperature double, process_temperature double, rotational_speed double, "
        "torque double, tool_wear double, prob_class_0 double, prob_class_1 double",
    )
