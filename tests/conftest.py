import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from duetlog.session import get_session
    s = get_session("local[4]", shuffle_partitions=4)
    yield s


@pytest.fixture(scope="session")
def tables01(spark):
    from duetlog.plans.fixtures import Tables
    return Tables(spark, SF01)


@pytest.fixture(scope="session")
def tables001(spark):
    from duetlog.plans.fixtures import Tables
    return Tables(spark, SF001)
