import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from strata.session import get_session
    warehouse = tempfile.mkdtemp(prefix="strata-wh-")
    s = get_session("local[*]", app="strata-tests", shuffle_partitions=8,
                    extra_conf={"spark.sql.warehouse.dir": warehouse})
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="strata-test-")
