import os
import sys
from datetime import datetime, timezone

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]").appName("keelson-tests")
        .config("spark.sql.shuffle.partitions", "4").config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false").config("spark.driver.memory", "6g")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoint")))
    yield session
    session.stop()


def utc(*args):
    return datetime(*args, tzinfo=timezone.utc)


@pytest.fixture(scope="session")
def sf(request):
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def raw_schema():
    return ("record_id double, retrieved_datetime string, age double, weight double, height double, gender string, region string, "
            "howlong string, eat string, background string, experience string, schedule string, "
            "deadlift double, candj double, snatch double, backsq double, pos long")


COLUMNS = ["record_id", "retrieved_datetime", "age", "weight", "height", "gender", "region", "howlong", "eat", "background",
           "experience", "schedule", "deadlift", "candj", "snatch", "backsq", "pos"]


@pytest.fixture(scope="session")
def raw_rows():
    return [
        (11.0, "2023-05-04T08:30:00Z", 41.0, 152.0, 64.0, "Female", "Coast", "under a year", "vegan", "rowing", "club", "evenings", 210.0, 140.0, 95.0, 160.0, 0),
        (12.0, "2023-06-10T21:15:00Z", 22.0, 201.0, 75.0, "Male", "Hills", "NA", "mixed", "Decline to answer", "books", "weekends", 455.0, 260.0, 215.0, 390.0, 1),
        (13.0, "2023-07-01T05:00:00Z", 19.0, 148.0, 62.0, "Female", "Valley", "a decade", "all", "swimming", "friend", "mornings", 160.0, 105.0, 900.0, 145.0, 2),
    ]


@pytest.fixture
def raw(spark, raw_schema, raw_rows):
    """Builds the raw table; ``edits`` maps (row, column) to a value."""
    def make(edits=None, rows=None):
        data = [list(r) for r in rows or raw_rows]
        for (i, c), v in (edits or {}).items():
            data[i][COLUMNS.index(c)] = v
        return spark.createDataFrame([tuple(r) for r in data], raw_schema)

    return make
