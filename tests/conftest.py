from __future__ import annotations

import pytest
from pyspark.sql import SparkSession

from opticlake.session import configure


def make_session() -> SparkSession:
    spark = (
        SparkSession.builder.master("local[8]")
        .appName("opticlake-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


@pytest.fixture(scope="session")
def spark():
    return make_session()
