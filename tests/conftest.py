import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tillstream import session


@pytest.fixture(scope="session")
def spark():
    built = session.build(
        "tests", master="local[8]", shuffle_partitions=3,
        conf={"spark.ui.enabled": "false", "spark.driver.memory": "8g"},
    )
    built.sparkContext.setLogLevel("ERROR")
    yield built
    built.stop()


@pytest.fixture(scope="session")
def sf():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
