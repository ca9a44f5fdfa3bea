"""Windowed alert counts: stream against table, late rows, restart."""

from collections import Counter

import pytest
from conftest import SF
from pyspark.sql import functions as F
from test_oracle import con  # noqa: F401

from check_oracle import compare
from flowsift.plans.catalog import QUERIES
from flowsift.plans.oracle import SQL
from flowsift.storage import new_path
from flowsift.streaming.windows import late_rows, read_window_counts, windowed_alerts, write_window_counts

SCHEMA = "timestamp string, src_ip string, dst_ip string, anomaly_score double, is_alert int"


def row(minute, src="10.0.0.1", dst="d", score=0.5, alert=1):
    stamp = None if minute is None else f"2026-09-20T{8 + minute // 60:02d}:{minute % 60:02d}:00"
    return (stamp, src, dst, score, alert)


@pytest.fixture
def feed(spark):
    """A folder of flow files, a function that adds one, and one that processes what is new."""
    folder, out, state = (new_path(spark, n) for n in ("in", "out", "state"))

    def add(*rows):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)

    def run(**options):
        stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder)
        query = write_window_counts(windowed_alerts(stream, **options), out, state)
        query.awaitTermination()
        return query

    return folder, out, add, run


def got(df):
    return {(r.window_start.strftime("%H:%M"), r.src_ip): (r.alerts, r.targets, r.top_score) for r in df.collect()}


def test_stream_equals_table_and_goes_on_after_a_restart(spark, feed):
    folder, out, add, run = feed
    add(row(0, dst="a"), row(3, dst="b", score=0.9), row(4, alert=0), row(None), row(7, src="10.0.0.2"))
    add(row(1, dst="a", score=0.7), row(9))
    run(delay="1 hour")
    assert got(read_window_counts(spark, out)) == got(windowed_alerts(spark.read.parquet(folder)))
    # The state comes back from the checkpoint: counts of open windows go on.
    add(row(2, dst="c"), row(8, src="10.0.0.2"), row(31))
    run(delay="1 hour")
    counts = got(read_window_counts(spark, out))
    assert counts == got(windowed_alerts(spark.read.parquet(folder)))
    assert counts["08:00", "10.0.0.1"] == (4, 3, 0.9) and counts["08:05", "10.0.0.2"] == (2, 1, 0.5)
    before = Counter(counts)
    run(delay="1 hour")
    assert Counter(got(read_window_counts(spark, out))) == before


def test_rows_behind_the_watermark_are_not_counted(spark, feed):
    _, out, add, run = feed
    add(row(0), row(40))
    run(delay="10 minutes")
    # The watermark is now at minute 30: the window of minute 1 is closed, that of minute 33 is open.
    add(row(1), row(33))
    query = run(delay="10 minutes")
    counts = got(read_window_counts(spark, out))
    assert counts["08:00", "10.0.0.1"][0] == 1 and counts["08:30", "10.0.0.1"][0] == 1
    assert late_rows(query) == 1


def test_sliding_windows_count_a_flow_in_each(spark):
    table = spark.createDataFrame([row(7)], SCHEMA)
    assert set(got(windowed_alerts(table, size="10 minutes", slide="5 minutes"))) == {("08:00", "10.0.0.1"), ("08:05", "10.0.0.1")}
    assert windowed_alerts(table.where(F.lit(False))).count() == 0


def test_query_equals_sql(spark, con):  # noqa: F811
    result = compare("ext2", spark, con, SF, QUERIES["ext2_windowed_alerts"], SQL["ext2_windowed_alerts"])
    assert result.startswith("ok") and "TYPES" not in result, result
