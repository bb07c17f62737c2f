import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from cohortforge.session import get_spark
    return get_spark("local[4]", 8, app_name="cohortforge-tests")


@pytest.fixture(autouse=True)
def _kept():
    from cohortforge.operators.join import kept_tables
    with kept_tables():
        yield
