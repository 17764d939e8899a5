import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = os.pathsep.join(x for x in (str(ROOT), os.environ.get("PYTHONPATH", "")) if x)

from tessera.session import build  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("spark")
    session = build("tests", 8, **{
        "spark__sql__warehouse__dir": str(base / "warehouse"),
        "spark__checkpoint__dir": str(base / "checkpoints"),
        "spark__driver__memory": "6g",
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
