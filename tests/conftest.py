import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.01"
SF_TINY = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from ontime.session import build_session

    s = build_session(master="local[*]", shuffle_partitions=8, app_name="ontime-tests")
    yield s
    s.stop()


@pytest.fixture()
def workdir():
    """A fresh scratch folder per test (never reused, never removed by the tests)."""
    return tempfile.mkdtemp(prefix="ontime-test-")


def write_text(folder: str, rel: str, text: str) -> str:
    path = os.path.join(folder, rel)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)
    return path
