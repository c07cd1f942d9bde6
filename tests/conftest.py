import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from lakejobs.session import build_session, ensure_checkpoint_dir  # noqa: E402

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    session = build_session("4", "tests")
    ensure_checkpoint_dir(session)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def tables(spark):
    from lakejobs.tables import Tables

    return Tables(spark, SMALL)
