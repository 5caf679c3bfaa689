import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from chronolith.session import get_session

    s = get_session("local[4]", 4, **{"spark.ui.enabled": "false", "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")), "spark.driver.memory": "3g", "spark.ui.showConsoleProgress": "false"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
