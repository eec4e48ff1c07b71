import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from plumbline.session import local_session  # noqa: E402

DATA = Path("/root/testdata")


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, shuffle_partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def sf_dir():
    return str(DATA / "sf0.001")
