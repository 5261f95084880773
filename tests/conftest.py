import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from critloom.session import JOB_CONF

    b = (SparkSession.builder.master("local[*]").appName("critloom-tests")
         .config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false"))
    for k, v in JOB_CONF.items():
        b = b.config(k, v)
    s = b.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    from critloom.session import checkpoint_dir

    checkpoint_dir(s)  # the session's own setting if it has one, else a temp folder
    yield s


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="critloom-test-")


SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"
