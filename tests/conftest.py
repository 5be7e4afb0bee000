"""Shared Spark session (local, no UI) and paths to the driver's test tables."""

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from lakeloom.session import build_session

    s = build_session(master="local[4]", shuffle_partitions=8,
                      extra_conf={"spark.driver.memory": "4g"})
    s.sparkContext.setLogLevel("FATAL")
    # Use the configured spark.checkpoint.dir; only when none is set do the
    # tests create their own.
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="lakeloom-test-ckpt-"))
    yield s


@pytest.fixture()
def tmp(tmp_path):
    return str(tmp_path)
