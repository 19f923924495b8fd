import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from assetlens.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    ckpt = tempfile.mkdtemp(prefix="assetlens-test-ckpt-")
    s = get_session("local[4]", **{"spark.sql.shuffle.partitions": "4", "spark.checkpoint.dir": ckpt})
    yield s


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="assetlens-test-")
