from __future__ import annotations

import datetime as dt
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from firstseen.session import local_session  # noqa: E402

DAY = dt.date(2026, 3, 11)


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "tests", shuffle_partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def write(tmp_path):
    """write(relative path, text or bytes) below a new folder; returns its root."""

    def put(path: str, content: str | bytes) -> Path:
        target = tmp_path / path
        target.parent.mkdir(parents=True, exist_ok=True)
        target.write_bytes(content if isinstance(content, bytes) else content.encode())
        return target

    put.root = tmp_path
    return put
