"""Pairing of flows with flagged explanations moves rows of flagged keys only."""

import pytest
from pyspark.sql import functions as F

from flowsift.operators import rowkeys
from flowsift.operators.rowkeys import _reads_files, may_be_among
from flowsift.operators.triage import generate_alerts_batch
from flowsift.operators.validate import validate_and_clean
from flowsift.storage import materialize


def test_keys_that_are_there_always_pass(spark):
    keys = spark.range(0, 3000, 30).select(F.when(F.col("id") > 0, F.concat(F.lit("k"), "id")).alias("k"))
    wanted = may_be_among(keys, "k", 3000)
    rows = spark.range(3000).select("id", F.when(F.col("id") > 0, F.concat(F.lit("k"), "id")).alias("k"))
    kept = {r["id"] for r in rows.where(wanted(F.col("k"))).collect()}
    assert kept >= set(range(0, 3000, 30)) and len(kept) < 200
    assert may_be_among(keys.where("false"), "k", 0) is not None
    assert rows.where(may_be_among(keys.where("false"), "k", 0)(F.col("k"))).isEmpty()


def test_a_full_filter_is_left_out(spark, monkeypatch):
    monkeypatch.setattr(rowkeys, "KEY_BITS", (64, 64))
    assert may_be_among(spark.range(2000).select(F.col("id").cast("string").alias("k")), "k", 2000) is None


@pytest.mark.parametrize("bits", [(1 << 16, 1 << 27), (64, 64), (4096, 4096)])
def test_pairs_do_not_depend_on_the_filter(spark, make_flows, monkeypatch, bits):
    monkeypatch.setattr(rowkeys, "KEY_BITS", bits)
    names = [None if i % 50 == 0 else f"F-{i % 300}" for i in range(600)]
    flows = materialize(validate_and_clean(make_flows(*[{"flow_id": k, "tos": i} for i, k in enumerate(names)])), "flows")
    drivers = F.array(F.struct(F.lit("tos").alias("feature")))
    told = flows.select("flow_id", "tos", F.lit(0.7).alias("anomaly_score"), (F.col("tos") % 10 == 0).cast("int").alias("is_alert"), drivers.alias("top_drivers"), F.col("tos").cast("string").alias("narrative"))
    alerts = generate_alerts_batch(flows, told)
    found = alerts.select("flow_id", F.col("anomaly_analysis.soc_justification").alias("n")).collect()
    assert sorted(int(r["n"]) for r in found) == list(range(0, 600, 10))
    assert all(r["flow_id"] == names[int(r["n"])] or names[int(r["n"])] is None for r in found)


def test_flows_of_other_keys_are_not_moved(spark, make_flows, monkeypatch):
    flows = materialize(validate_and_clean(make_flows(*[{"tos": i} for i in range(500)])), "flows")
    drivers = F.array(F.struct(F.lit("tos").alias("feature")))
    told = flows.select("flow_id", F.lit(0.7).alias("anomaly_score"), (F.col("tos") < 5).cast("int").alias("is_alert"), drivers.alias("top_drivers"), F.lit("n").alias("narrative"))
    counted, occurrence = [], rowkeys.with_occurrence

    def watched(df, *args):
        assert _reads_files(df)
        counted.append(df.count())
        return occurrence(df, *args)

    monkeypatch.setattr("flowsift.operators.triage.with_occurrence", watched)
    assert generate_alerts_batch(flows, told).count() == 5
    assert len(counted) == 2 and max(counted) < 50
