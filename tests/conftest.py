import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from wordtide.session import ensure_checkpoint_dir, get_spark

    s = get_spark("local[4]", app="wordtide-tests", shuffle_partitions=4)
    ensure_checkpoint_dir(s, tempfile.mkdtemp(prefix="wordtide-test-ckpt-"))
    yield s


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="wordtide-test-")
