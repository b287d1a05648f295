import os
import sys
import tempfile

import pytest

# These compare with the published figures of one real lake, and need its folder.
collect_ignore = [] if os.environ.get("RETAIL_LAKE_DIR") else ["test_golden.py"]

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from storeledger.session import local_session

    folder = tempfile.mkdtemp(prefix="storeledger-")
    session = local_session("storeledger-tests", 8, {"spark.checkpoint.dir": folder, "spark.ui.showConsoleProgress": "false"})
    session.conf.set("spark.sql.shuffle.partitions", "4")
    yield session


@pytest.fixture()
def folder():
    return tempfile.mkdtemp(prefix="storeledger-")
