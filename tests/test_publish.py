"""Results that appear together: versions, readers, and runs that die half-way."""

import datetime as dt
import os

import pytest
from conftest import SF
from pyspark.sql import functions as F

from flowsift.plans.benchmark import run_benchmark
from flowsift.plans.catalog import _split
from flowsift.plans.frozen import frozen_model
from flowsift.plans.pipeline import run_pipeline, score_feed
from flowsift.sources import models
from flowsift.sources.derived import stored_view
from flowsift.sources.models import load_model, save_model
from flowsift.sources.publish import current, parquet, publish
from flowsift.storage import new_path


def test_a_run_that_dies_between_the_writes_leaves_the_old_model(spark, monkeypatch):
    path = new_path(spark, "model")
    old = frozen_model()
    save_model(spark, old, path)
    new = frozen_model()
    new.forest.threshold = 0.123
    new.forest.nodes = new.forest.nodes.assign(value=0.0)

    def dying(df):
        if "threshold" in df.columns and "psi" in df.columns:
            raise OSError("disk is gone")
        return parquet(df)

    with monkeypatch.context() as m:
        m.setattr(models, "parquet", dying)
        with pytest.raises(OSError):
            save_model(spark, new, path)
    loaded = load_model(spark, path)
    assert loaded.forest.threshold == old.forest.threshold and loaded.forest.nodes.value.max() > 0
    # The tables written before the failure do not get in the way of the next run.
    save_model(spark, new, path)
    assert load_model(spark, path).forest.threshold == 0.123


def test_versions_are_switched_whole_and_old_ones_go(spark):
    root = new_path(spark, "published")
    with pytest.raises(FileNotFoundError):
        current(spark, root)
    versions = []
    for k in range(4):
        tables = {name: parquet(spark.range(1).select(F.lit(k).alias("k"))) for name in ("a", "b")}
        versions.append(publish(spark, root, tables))
        paths = current(spark, root)
        assert [spark.read.parquet(paths[n]).first()["k"] for n in ("a", "b")] == [k, k]
    folders = {d for d in os.listdir(root) if d.startswith("v-")}
    assert folders == set(versions[-2:])


def test_all_results_of_a_pipeline_and_a_feed(spark):
    base, evaluation = _split(spark, SF)
    out = new_path(spark, "results")
    ready = frozen_model()
    run_pipeline(base, evaluation, model=ready, max_alerts=5, publish_dir=out, run_date=dt.date(2026, 9, 20), daily_flows=1000)
    paths = current(spark, out)
    assert set(paths) == {"model", "scored", "evaluation_summary", "alerts", "top_explanation", "importance", "tradeoff", "baseline_statistics"}
    assert spark.read.parquet(paths["importance"]).count() == 24 and spark.read.parquet(paths["tradeoff"]).count() == 50
    assert spark.read.parquet(paths["baseline_statistics"]).count() == 24 and spark.read.json(paths["top_explanation"]).count() == 1
    assert spark.read.json(paths["alerts"]).count() == 5

    feed = score_feed(spark, paths["model"], evaluation, threshold=0.6, publish_dir=new_path(spark, "feed"), run_date=dt.date(2026, 9, 20))
    flagged = feed.scored.where("anomaly_score >= 0.6").count()
    row = feed.kpis.first()
    assert row["flagged_flows"] == flagged == feed.alerts.count() and row["threshold"] == 0.6
    assert feed.scored.where("is_alert = 1").count() == flagged
    more = score_feed(spark, paths["model"], evaluation, preset="balanced")
    assert more.kpis.first()["threshold"] == 0.55


def test_benchmark_job_keeps_flows_and_metrics(spark):
    model, out = new_path(spark, "model"), new_path(spark, "bench")
    save_model(spark, frozen_model(), model)
    doc = run_benchmark(spark, model, stored_view(spark, SF, "raw_cidds"), "cidds-001", out).first()
    flows = spark.read.parquet(current(spark, out)["flows"])
    assert flows.count() == sum(doc["confusion_matrix"].asDict().values()) == spark.read.parquet(current(spark, out)["scored"]).count()
    assert flows.select("flow_id").distinct().count() == flows.count()
