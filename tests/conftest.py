import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMOKE = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    import tempfile
    from vitrine.session import build_session
    warehouse = tempfile.mkdtemp(prefix="vitrine-wh-")
    s = build_session(master="local[4]", shuffle_partitions=4,
                      extra_conf={"spark.sql.warehouse.dir": warehouse})
    yield s
    s.stop()
