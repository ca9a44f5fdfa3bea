"""Alerts per source address and event-time window, on a stream or on a table.

The state holds one row per address and open window. A watermark trails the latest event
time by ``delay``: a window that ends before it is dropped from the state, and rows that
arrive later than that are not counted; ``late_rows`` tells how many. Flows whose time
cannot be read belong to no window, as with a table.

A micro-batch writes the windows that it changed under its number, so a batch that is
repeated after a failure replaces what it wrote; readers take the latest row of a window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

KEYS = ["window_start", "window_end", "src_ip"]


def windowed_alerts(scored: DataFrame, size: str = "5 minutes", slide: str | None = None, delay: str = "10 minutes") -> DataFrame:
    """``window_start, window_end, src_ip, alerts, targets, top_score`` of flagged flows.

    ``targets`` is the number of destinations, from a set per window and address. With a
    ``slide`` windows overlap. A table gives all its windows; ``delay`` is for streams.
    """
    timed = scored.where(F.col("is_alert") == 1).withColumn("event_ts", F.try_to_timestamp("timestamp"))
    timed = timed.withWatermark("event_ts", delay).where(F.col("event_ts").isNotNull())
    window = F.window("event_ts", size, slide or size)
    counted = timed.groupBy(window.alias("w"), "src_ip").agg(
        F.count(F.lit(1)).alias("alerts"),
        F.size(F.collect_set("dst_ip")).cast("bigint").alias("targets"),
        F.max("anomaly_score").alias("top_score"),
    )
    return counted.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "src_ip", "alerts", "targets", "top_score")


def write_window_counts(counts: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Keep the windows that each micro-batch changes; process what is there, stop."""

    def keep(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return (
        counts.writeStream.foreachBatch(keep)
        .option("checkpointLocation", checkpoint)
        .outputMode("update")
        .trigger(availableNow=True)
        .start()
    )


def read_window_counts(spark: SparkSession, path: str) -> DataFrame:
    """The latest state of every window that was written."""
    rows = spark.read.parquet(path)
    values = [c for c in rows.columns if c not in (*KEYS, "batch")]
    latest = rows.groupBy(*KEYS).agg(F.max_by(F.struct(*values), "batch").alias("v"))
    return latest.select(*KEYS, "v.*")


def late_rows(query: StreamingQuery) -> int:
    """Rows that came after the watermark had passed their window, over the batches that the query remembers."""
    return sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"])
