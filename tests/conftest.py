import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from affinity.session import build_session

    s = build_session(
        "affinity-tests",
        master="local[4]",
        conf={
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "4g",
            "spark.sql.execution.arrow.pyspark.enabled": "true",
        },
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
