"""Stored tables with awkward rows for the corpus operators."""

import glob
import os
import uuid

import duckdb
import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string"


@pytest.fixture
def stored(spark, tmp_path):
    """Write rows as a table with extra columns whose names operators use inside."""

    def make(rows, schema=SCHEMA, parts=3):
        path = f"{tmp_path}/{uuid.uuid4().hex}"
        df = spark.createDataFrame(rows, schema)
        for name in ("row_no", "_row", "word", "n", "node", "key", "hub"):
            df = df.withColumn(name, F.lit("clash"))
        df.repartition(parts).write.parquet(path)
        return spark.read.parquet(path)

    return make


@pytest.fixture(scope="session")
def con():
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(path).removesuffix('.parquet')} AS SELECT * FROM read_parquet('{path}')")
    return con
