import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from flowsift.schema import FLOW_COLUMNS, RAW_FLOW_SCHEMA  # noqa: E402
from flowsift.session import tune  # noqa: E402

SF = "/root/testdata/sf0.001"

DEFAULTS = dict(
    flow_id="F-1",
    timestamp="2026-09-20T08:00:00",
    src_ip="10.0.0.1",
    dst_ip="10.0.0.2",
    src_port=50000.0,
    dst_port=443.0,
    protocol="TCP",
    flow_duration=1.0,
    packet_count=10.0,
    byte_count=1000.0,
    tcp_flags="SYN,ACK",
    tos=0,
    label="benign",
    is_anomaly=0,
)


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield tune(session)


@pytest.fixture(scope="session")
def make_flows(spark):
    """Flow table from partial rows; missing fields get defaults."""

    def make(*rows):
        full = [DEFAULTS | {"flow_id": f"F-{i}"} | row for i, row in enumerate(rows)]
        return spark.createDataFrame([tuple(r[c] for c in FLOW_COLUMNS) for r in full], RAW_FLOW_SCHEMA)

    return make
