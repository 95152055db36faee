import datetime as dt
import glob
import os

import pytest

from archivolt.session import local_session

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = local_session("4", 4)
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def sf():
    if not glob.glob(f"{SF}/*.parquet"):
        pytest.skip("no test tables")
    return SF


@pytest.fixture(scope="session")
def day():
    return lambda n: dt.datetime(2024, 1, 1) + dt.timedelta(days=n)
