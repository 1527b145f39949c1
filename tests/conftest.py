from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from sunledger.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    session = build_session(
        "tests",
        "local[8]",
        8,
        {
            "spark.driver.memory": "6g",
            "spark.checkpoint.dir": str(shared),
            "spark.log.level": "ERROR",
            "spark.sql.warehouse.dir": str(shared / "warehouse"),
        },
    )
    yield session
    session.stop()


@pytest.fixture
def small_chunks(monkeypatch):
    """Chunks of four rows, so that small inputs cross many borders."""
    from sunledger.operators import ordering

    monkeypatch.setattr(ordering, "CHUNK_BITS", 2)
