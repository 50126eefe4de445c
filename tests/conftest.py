import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from docmart.session import local_session

    s = local_session(4, shuffle_partitions=4, app="docmart-tests")
    # tests own their scratch folder; jobs read it back from the session
    s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="docmart-test-"))
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="docmart-case-")
