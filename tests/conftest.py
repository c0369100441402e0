import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from voltwatch.session import get_spark
    s = get_spark("voltwatch-tests", cores="*", shuffle_partitions=8, driver_memory="4g")
    yield s
