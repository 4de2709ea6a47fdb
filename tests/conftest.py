import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from linkwright.session import local_session

    folder = tmp_path_factory.mktemp("checkpoints")
    session = local_session("4", 4, **{"spark.checkpoint.dir": f"file://{folder}", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "3g"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
