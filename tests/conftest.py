from __future__ import annotations

import sys
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

SF_DIR = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tallyworks-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"create view {table} as select * from '{SF_DIR}/{table}.parquet'")
    return connection


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture
def make_ads(spark):
    """Ad events from (event_id, ad_id, time, event, platform) with fixed other columns."""

    def make(rows):
        frame = spark.createDataFrame(
            [tuple(row) for row in rows],
            "event_id long, ad_id long, time timestamp_ntz, event string, platform string",
        )
        return frame.selectExpr(
            "*",
            "cast(time as date) as date",
            "ad_id % 5 as client_union_id",
            "ad_id % 2 as campaign_union_id",
            "if(ad_id % 2 = 0, 'CPM', 'CPC') as ad_cost_type",
            "cast(100 as double) as ad_cost",
            "ad_id % 3 = 0 as has_video",
            "ad_id * 37 as target_audience_count",
        )

    return make
