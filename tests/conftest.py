import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from siltstone.session import session

    return session("local[4]", partitions=4, **{"spark.driver.memory": "4g", "spark.ui.showConsoleProgress": "false"})
