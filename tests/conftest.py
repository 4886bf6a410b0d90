from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).parent.parent), str(Path(__file__).parent)]

from creditflow.session import local_session  # noqa: E402

DATA = os.environ.get("CREDITFLOW_TESTDATA", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = local_session("creditflow-tests", cores=4)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def data() -> str:
    if not Path(DATA).is_dir():
        pytest.skip(f"no test data in {DATA}")
    return DATA
