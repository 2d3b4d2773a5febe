from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    builder = (SparkSession.builder.master("local[*]")
               .appName("candlegap-tests")
               .config("spark.ui.enabled", "false")
               .config("spark.sql.shuffle.partitions", "8")
               .config("spark.sql.session.timeZone", "UTC")
               .config("spark.sql.maxMetadataStringLength", "10000"))
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    # tests name their own shared folder only where the cluster gives none
    if not session.conf.get("spark.checkpoint.dir", None) and \
            not session.sparkContext.getCheckpointDir():
        session.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="candlegap-test-"))
    yield session
    session.stop()


@pytest.fixture
def tmp_root(tmp_path):
    return str(tmp_path)
