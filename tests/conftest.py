"""One local session for all tests."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tessera.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = f"file://{tmp_path_factory.mktemp('shared')}"
    session = get_session("local[4]", 4, **{"spark.sql.maxMetadataStringLength": "2000", "spark.checkpoint.dir": shared})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
