import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from clusterlens.session import checkpoint_root, get_spark
    s = get_spark("local[4]", app="clusterlens-tests", shuffle_partitions=8)
    checkpoint_root(s)  # tests get their own folder (the setting is unset here)
    yield s
    s.stop()
