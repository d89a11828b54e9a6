import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))
sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import parity  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return parity.session()


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"
