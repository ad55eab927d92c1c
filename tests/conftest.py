import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from helpers import ORDER_SCHEMA  # noqa: E402
from rekindle.session import build_session  # noqa: E402


def pytest_configure(config):
    config.addinivalue_line("markers", "slow: model training tests")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = build_session(master="local[4]", shuffle_partitions=4, extra={
        "spark.driver.memory": "4g", "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoint")),
        "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse"))})
    yield s
    s.stop()


@pytest.fixture
def orders_df(spark):
    def make(rows):
        return spark.createDataFrame(rows, ORDER_SCHEMA)
    return make
