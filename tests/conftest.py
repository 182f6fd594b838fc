import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemill.session import build_session  # noqa: E402
from tidemill.tables import Tables  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    scratch = tmp_path_factory.mktemp("shared")
    session = build_session(
        "tests",
        "local[8]",
        {
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "12g",
            "spark.checkpoint.dir": str(scratch),
            "spark.sql.warehouse.dir": str(scratch / "warehouse"),
            "spark.driver.extraJavaOptions": f"-Dderby.system.home={scratch}",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small(spark):
    return Tables(spark, SMALL)
