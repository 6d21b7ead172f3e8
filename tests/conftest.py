import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF0001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from retailcast.session import checkpoint_dir, get_spark
    s = get_spark("local[*]", shuffle_partitions=8)
    checkpoint_dir(s)  # tests only: a private folder when the cluster names none
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir(tmp_path):
    return str(tmp_path)
