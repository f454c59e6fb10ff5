import os
import sys
import tempfile
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tests"))

from labelweave.session import build_session  # noqa: E402


def make_session(cores: int = 8):
    conf = {
        "spark.sql.shuffle.partitions": "8",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "8g",
        "spark.ui.showConsoleProgress": "false",
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="run-"),
    }
    session = build_session("labelweave-tests", f"local[{cores}]", **conf)
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def spark():
    os.environ.setdefault("PYTHONPATH", str(ROOT))
    session = make_session()
    yield session
    session.stop()
