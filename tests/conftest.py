import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from costlake.session import ensure_checkpoint_dir, get_session

    s = get_session(master="local[4]", shuffle_partitions=2)
    ensure_checkpoint_dir(s)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def models(spark):
    from costlake.plans.registry import CostModels

    return CostModels.from_driver_tables(spark, SF_SMALL)
