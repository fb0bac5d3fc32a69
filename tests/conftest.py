from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = os.pathsep.join([str(ROOT), os.environ.get("PYTHONPATH", "")])

from skylattice.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = local_session(4)
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
