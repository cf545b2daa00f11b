import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from checks.compare import session  # noqa: E402

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("checkpoint"))
    spark = session("8", "patronlens-tests", spark__checkpoint__dir=folder)
    yield spark
    spark.stop()


@pytest.fixture
def conf(spark):
    """Set session options for one test."""
    before = {}

    def set_all(options):
        for key, value in options.items():
            before.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, value)

    yield set_all
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


LOG_COLUMNS = "user_id long, seller_id long, item_id long, cat_id long, brand_id long, time_stamp string, action_type int"


@pytest.fixture
def make(spark):
    """Build the three inputs from short tuples."""

    def build(log, labels, info=()):
        return (
            spark.createDataFrame(log, LOG_COLUMNS),
            spark.createDataFrame(labels, "user_id long, seller_id long, label int"),
            spark.createDataFrame(list(info), "user_id long, age_range string, gender string"),
        )

    return build
