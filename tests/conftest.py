from __future__ import annotations

import sys
from pathlib import Path

import pytest

TESTS = Path(__file__).resolve().parent
sys.path[:0] = [str(TESTS.parent), str(TESTS)]

from paths import MEDIUM, SMALL  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    from surveylake.session import local_session

    session = local_session("tests", cpus=8)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small():
    return SMALL


@pytest.fixture(scope="session")
def medium():
    return MEDIUM
