from __future__ import annotations

import sys
import uuid
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent.parent))

from moorage.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session("moorage-tests", cpus=8)
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def lake(tmp_path):
    """Writes files below a fresh root."""

    class Lake:
        root = str(tmp_path / "bucket")

        def write(self, path: str, content: str | bytes) -> None:
            target = Path(self.root) / path
            target.parent.mkdir(parents=True, exist_ok=True)
            target.write_bytes(content.encode() if isinstance(content, str) else content)

    return Lake()


@pytest.fixture
def table():
    """A table name not used before."""
    return f"t_{uuid.uuid4().hex}"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def rows_of(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=repr)
