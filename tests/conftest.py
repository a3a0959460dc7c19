from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tests"))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tripspark.session import build_session

    s = build_session("local[*]", app_name="tripspark-tests", shuffle_partitions=8)
    yield s


@pytest.fixture
def scratch(spark):
    from tripspark.session import scratch_path

    return lambda name="t": scratch_path(spark, name)
