import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from larder.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "larder-tests", shuffle_partitions=4)
    # Hundreds of tiny plans: compiling each one takes longer than interpreting it.
    session.conf.set("spark.sql.codegen.wholeStage", "false")
    session.conf.set("spark.sql.codegen.factoryMode", "NO_CODEGEN")
    return session


@pytest.fixture(scope="session")
def small():
    if not os.path.isdir(SMALL):
        pytest.skip("test tables are not there")
    return SMALL


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]
