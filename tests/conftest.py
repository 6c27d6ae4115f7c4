import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from civicledger.session import get_session
    ckpt = tempfile.mkdtemp(prefix="civicledger-ckpt-", dir="/tmp")
    s = get_session(app="civicledger-tests", master="local[4]", shuffle_partitions=4,
                    fallback_checkpoint_dir=ckpt)
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture()
def tmpdir_():
    return tempfile.mkdtemp(prefix="civicledger-test-", dir="/tmp")
