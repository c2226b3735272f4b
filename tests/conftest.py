import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.dirname(os.path.abspath(__file__))]


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from marlstone import build_session

    scratch = tmp_path_factory.mktemp("spark")
    session = build_session(
        "marlstone-tests",
        master="local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.default.parallelism": "2",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
            "spark.checkpoint.dir": str(scratch / "checkpoints"),
            "spark.sql.warehouse.dir": str(scratch / "warehouse"),
            "spark.driver.extraJavaOptions": f"-Dderby.system.home={scratch}",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
