import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = ROOT + os.pathsep + os.environ.get("PYTHONPATH", "")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from larkspan.session import session

    shared = tmp_path_factory.mktemp("shared")
    settings = {"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "4g", "spark.checkpoint.dir": f"file://{shared}", "spark.sql.warehouse.dir": f"{shared}/warehouse"}
    own = session("tests", "local[4]", **settings)
    own.sparkContext.setLogLevel("ERROR")
    yield own
    own.stop()
