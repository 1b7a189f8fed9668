from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
for p in (ROOT, os.path.join(ROOT, "tests")):
    if p not in sys.path:
        sys.path.insert(0, p)

SMALL_SF = os.environ.get("TOUCHLINE_TEST_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from touchline.session import build_session

    session = build_session("local[4]", app_name="touchline-tests", shuffle_partitions=8)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    if not os.path.exists(os.path.join(SMALL_SF, "events.parquet")):
        pytest.skip(f"test data missing at {SMALL_SF}")
    return SMALL_SF
