from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tryline.session import build_session
    s = build_session("local[*]", shuffle_partitions=8, app_name="tryline-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def marts(spark):
    from tryline.plans.marts import MartBuild
    from tryline.sources.fixtures import RawTables
    return MartBuild(RawTables(spark, SF_SMALL))
