import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tessera.session import get_spark
    s = get_spark("local[4]", shuffle_partitions=8, app="tessera-tests")
    yield s
    s.stop()
