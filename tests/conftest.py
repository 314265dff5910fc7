import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))

from setforge.session import local_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session("8", shuffle_partitions=8, name="tests")
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def oracle():
    from compare import oracle_connection

    return oracle_connection(SF)
