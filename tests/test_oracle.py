"""A selection of the registered queries next to their SQL in DuckDB."""

import glob
import os

import duckdb
import pytest
from conftest import SF

from check_oracle import compare
from flowsift.plans.catalog import QUERIES
from flowsift.plans.oracle import SQL

CHECKED = [
    "val5_clean",
    "val6_rejections",
    "cnv6_convert_cidds",
    "cnv12_convert_cic",
    "cnv13_flow_ids",
    "fea_all_features",
    "scl3_transform",
    "mdl1_tree_samples",
    "mdl6_anomaly_score",
    "xai2_attributions",
    "xai7_narrative",
    "evl8_tradeoff",
    "evl12_metrics",
    "tri5_alerts",
    "qry16_box_statistics",
]


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_sql(spark, con, name):
    result = compare(name, spark, con, SF, QUERIES[name], SQL[name])
    assert result.startswith("ok") and "TYPES" not in result, result


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)
