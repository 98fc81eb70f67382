import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from cadastre.session import get_spark, shared_dir

    s = get_spark("local[4]", 4, app="cadastre-tests")
    shared_dir(s)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def fx(spark):
    from cadastre.fixtures import Fixtures

    return Fixtures(spark, SF_SMALL)
