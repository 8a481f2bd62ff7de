import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from panelcast.session import LOCAL_DEFAULTS, ensure_checkpoint_dir
    b = SparkSession.builder.master("local[4]").appName("panelcast-tests")
    for k, v in LOCAL_DEFAULTS.items():
        b = b.config(k, v)
    s = b.config("spark.sql.shuffle.partitions", "8").getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(s)
    yield s


SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


def pytest_configure(config):
    config.addinivalue_line("markers", "slow: end-to-end runs (a minute or more)")
