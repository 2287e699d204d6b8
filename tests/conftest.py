from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.dirname(os.path.abspath(__file__))]

from footfall.session import build_session  # noqa: E402

TESTDATA = os.environ.get("FOOTFALL_TESTDATA", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    conf = {
        "spark.sql.shuffle.partitions": "4",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoints")),
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "4g",
    }
    session = build_session("footfall-tests", "local[4,3]", conf)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def tree(tmp_path):
    """Writes CSV texts: tree({"gate/2024-03-01.csv": text}) returns the root."""

    def write(files: dict[str, str], root: str = "in") -> str:
        for name, text in files.items():
            path = tmp_path / root / name
            path.parent.mkdir(parents=True, exist_ok=True)
            path.write_bytes(text.encode())
        return str(tmp_path / root)

    return write
