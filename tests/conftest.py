import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from caseflux.session import local_session

    s = local_session(4, partitions=4, memory="3g")
    s.sparkContext.setLogLevel("OFF")
    return s


@pytest.fixture()
def work(spark):
    from caseflux.session import Workspace

    return Workspace(spark, "test")
