import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master(f"local[{os.environ.get('TEST_CPUS', '8')}]")
        .appName("courtlens-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints")))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.unix.domain.socket.enabled", "true")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def micro_logs(spark):
    """Seven matches of four players, small enough to check by hand."""
    rows = [
        ("p1", "m1", 20.0, 10, 9, 2, 12, 6, 1, 0, True),
        ("p1", "m2", 30.0, 12, 12, 0, 20, 8, 2, 1, False),
        ("p2", "m3", 0.5, 0, 0, 5, 1, 0, 3, 1, False),
        ("p2", "m4", 25.0, 8, 3, 8, 4, 1, 9, 4, True),
        ("p3", "m5", 15.0, 6, 2, 4, 0, 0, 0, 2, False),
        ("p4", "m6", 18.0, 0, 0, 0, 5, 0, 5, 0, False),
        ("p4", "m7", None, 4, 1, 4, 2, 2, 2, 1, True),
    ]
    from courtlens.schema import MATCH_LOG_SCHEMA

    return spark.createDataFrame(rows, MATCH_LOG_SCHEMA)
