import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from flowsift.sources.tables import read_flows_csv_checked, read_raw_csv, write_flows_csv, write_rejected
from flowsift.storage import new_path
from flowsift.streaming.scoring import read_flow_stream


def test_unreadable_lines_are_kept_with_a_reason_of_their_own(spark, make_flows):
    odd = make_flows({}, {"flow_id": "odd-1"}, {"src_port": -99.0}, {"dst_ip": None}, {"tcp_flags": None})
    port = F.when(F.col("flow_id") == "odd-1", "abc").otherwise(F.col("src_port").cast("string"))
    path = write_flows_csv(odd.withColumn("src_port", port), new_path(spark, "csv"))
    flows, rejected = read_flows_csv_checked(spark, path)
    assert {r.flow_id for r in flows.collect()} == {"F-0", "F-4"} and "_line" not in flows.columns
    back = spark.read.parquet(write_rejected(rejected, new_path(spark, "rejected")))
    got = {r.reason: r for r in back.collect()}
    assert set(got) == {"unreadable", "port_out_of_range", "missing_ip"} and back.count() == 3
    assert got["unreadable"].line.startswith("odd-1,") and ",abc," in got["unreadable"].line
    assert "F-2" in got["port_out_of_range"].line and got["missing_ip"].file.endswith(".csv")
    # The same lines are rejected whatever columns are asked for.
    assert flows.select("flow_id").count() == 2 and rejected.select("file").count() == 3


def test_lines_with_too_few_cells_and_empty_folders(spark, make_flows):
    path = write_flows_csv(make_flows({}).coalesce(1), new_path(spark, "csv"))
    spark.createDataFrame([(",".join(make_flows({}).columns),), ("F-7,only",)], "value string").coalesce(1).write.mode("append").text(path)
    flows, rejected = read_flows_csv_checked(spark, path)
    assert [r.flow_id for r in flows.collect()] == ["F-0"]
    assert [(r.reason, r.line) for r in rejected.collect()] == [("unreadable", "F-7,only")]
    nothing = write_flows_csv(make_flows({}).where("false"), new_path(spark, "csv"))
    flows, rejected = read_flows_csv_checked(spark, nothing)
    assert flows.count() == 0 and rejected.count() == 0


def test_raw_files_with_another_column_order_are_refused(spark):
    path = new_path(spark, "raw")
    rows = spark.createDataFrame([("1", "2")], "`Src Pt` string, `Dst Pt` string")
    rows.write.option("header", True).csv(path)
    assert read_raw_csv(spark, path).first().asDict() == {"Src Pt": "1", "Dst Pt": "2"}
    rows.select("Dst Pt", "Src Pt").write.mode("append").option("header", True).csv(path)
    with pytest.raises(Exception, match="(?i)header"):
        read_raw_csv(spark, path).collect()


def test_streamed_files_with_another_column_order_are_refused(spark, make_flows):
    path = new_path(spark, "feed")
    write_flows_csv(make_flows({}).select(*reversed(make_flows({}).columns)), path)
    query = (
        read_flow_stream(spark, path, "csv").writeStream.format("noop")
        .option("checkpointLocation", new_path(spark, "log")).trigger(availableNow=True).start()
    )
    with pytest.raises(StreamingQueryException):
        query.awaitTermination()
