import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from callstar.session import build_session
    ckpt = tempfile.mkdtemp(prefix="callstar-test-ckpt-")
    s = build_session("local[4]", app="callstar-tests", shuffle_partitions=4,
                      extra={"spark.checkpoint.dir": ckpt, "callstar.warehouse": os.path.join(ckpt, "wh"),
                             "spark.sql.warehouse.dir": os.path.join(ckpt, "catalog")})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_small():
    return "/root/testdata/sf0.001"
