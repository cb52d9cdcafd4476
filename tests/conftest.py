import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from skyledger.session import local_session
from skyledger.staging import StagingArea


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "skyledger-tests", "4g")
    session.sparkContext.setLogLevel("ERROR")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    return session


@pytest.fixture
def area(spark):
    return StagingArea(spark)
