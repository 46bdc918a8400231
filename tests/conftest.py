import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from seqlog.plans.session import configure  # noqa: E402
from seqlog.plans.staging import remove_scratch, scratch_path  # noqa: E402
from seqlog.sources.basin import create_basin  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("seqlog-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield configure(session)
    remove_scratch(session)
    session.stop()


@pytest.fixture
def basin(spark):
    return create_basin(spark, scratch_path(spark, "test-basin"))


@pytest.fixture
def checkpoint(spark):
    return scratch_path(spark, "test-checkpoint")
