from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]


@pytest.fixture(scope="session")
def spark():
    from lendlens.sources.session import local_session

    # Short jobs: skip the optimising compiler, keep few shuffle partitions.
    session = local_session(8, 4, spark__driver__extraJavaOptions="-XX:TieredStopAtLevel=1")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def loans(spark):
    """100 loans of the smallest test data, with all features, written once."""
    from lendlens.plans import tables
    from lendlens.sources.session import stage

    return stage(tables.full_features((spark, "/root/testdata/sf0.001")).orderBy("SK_ID_CURR").limit(100), "loans")
