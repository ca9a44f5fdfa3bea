"""Scoring of flow files as they arrive: the batch operators on a stream.

Every step up to the alert is a projection, a filter or a join with the five-row
threat dimension, so the query keeps no state and needs no watermark.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from flowsift.plans.pipeline import alerts_for, score_flows
from flowsift.operators.validate import validate_and_clean
from flowsift.schema import RAW_FLOW_SCHEMA
from flowsift.sources.models import FlowModel


def read_flow_stream(spark: SparkSession, path: str, fmt: str = "parquet", files_per_batch: int = 1000) -> DataFrame:
    """Cleaned flows from a folder that receives files; a CSV file with another header fails the batch."""
    reader = spark.readStream.schema(RAW_FLOW_SCHEMA).option("maxFilesPerTrigger", files_per_batch)
    if fmt == "csv":
        reader = reader.option("header", True).option("enforceSchema", False)
    return validate_and_clean(reader.format(fmt).load(path))


def alert_stream(model: FlowModel, flows: DataFrame, run_date: dt.date | None = None) -> DataFrame:
    """Enriched alerts of the flagged flows of a stream.

    Alert ids derive from ``flow_id``, which a stream does not check for copies.
    """
    return alerts_for(model, score_flows(model, flows), run_date, key="flow_id")


def write_alert_stream(alerts: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append alerts as JSON Lines, process what is there, stop."""
    return (
        alerts.writeStream.format("json")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
