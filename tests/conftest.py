import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from portstar.session import DEFAULT_CONF

    builder = (SparkSession.builder.master("local[*]").appName("portstar-tests")
               .config("spark.sql.shuffle.partitions", "8"))
    for key, value in DEFAULT_CONF.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    if not session.sparkContext.getCheckpointDir():
        session.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="portstar-test-ckpt-"))
    yield session


@pytest.fixture(scope="session")
def sf_small():
    return SF_SMALL
