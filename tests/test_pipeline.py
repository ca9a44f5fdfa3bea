import datetime as dt

import pytest
from conftest import SF
from pyspark.sql import functions as F

from flowsift import storage
from flowsift.operators import reports
from flowsift.operators.attribution import FlowExplainer, feature_importance
from flowsift.plans.benchmark import evaluate_benchmark, normalise_benchmark
from flowsift.plans.catalog import QUERIES, _split, trained_model
from flowsift.plans.pipeline import run_pipeline
from flowsift.schema import ForestConfig
from flowsift.sources.derived import stored_view
from flowsift.sources.models import load_model
from flowsift.sources.tables import read_flows_csv, read_metrics, write_flows_csv
from flowsift.storage import new_path


def test_full_pipeline(spark):
    base, evaluation = _split(spark, SF)
    out = new_path(spark, "pipeline")
    result = run_pipeline(base, evaluation, ForestConfig(n_trees=60), target_fpr=0.08, run_date=dt.date(2026, 9, 20), output_dir=out)
    doc = result.metrics.first()
    assert doc["auroc"] > 0.85 and doc["recall"] >= 0.50
    assert result.scored.count() == evaluation.count() == 3039
    top = result.top_explanation.first()
    assert top["anomaly_score"] >= result.model.forest.threshold and 0 < len(top["top_drivers"]) <= 4
    alerts = result.alerts.collect()
    assert len(alerts) == 50 and len({a["alert_id"] for a in alerts}) == 50
    assert result.importance.count() == 24 and result.tradeoff.count() == 50
    assert load_model(spark, f"{out}/model").forest.threshold == result.model.forest.threshold
    assert read_metrics(spark, f"{out}/evaluation_summary").first()["auroc"] == doc["auroc"]
    assert spark.read.parquet(f"{out}/scored").count() == 3039
    assert spark.read.json(f"{out}/alerts").count() == 50


def test_repeated_flow_ids_lose_no_rows(spark):
    base, evaluation = _split(spark, SF)
    third = evaluation.where(F.xxhash64("flow_id") % 3 == 0).withColumn("flow_id", F.lit("SAME"))
    mixed = evaluation.unionByName(third)
    result = run_pipeline(base, mixed, ForestConfig(n_trees=10), max_alerts=None)
    assert result.scored.count() == mixed.count()
    assert result.scored.select("row_key").distinct().count() == mixed.count()
    flagged = result.scored.where("is_alert = 1").count()
    assert result.alerts.select("alert_id").distinct().count() == flagged


def test_csv_round_trip_and_missing_file(spark, make_flows):
    flows = make_flows({}, {"tcp_flags": "NONE", "label": "port_scan"}, {"src_port": -99.0})
    back = read_flows_csv(spark, write_flows_csv(flows, new_path(spark, "csv")))
    assert {r["flow_id"] for r in back.collect()} == {"F-0", "F-1"}
    with pytest.raises(FileNotFoundError):
        read_flows_csv(spark, new_path(spark, "none"))


def test_csv_files_must_agree_in_their_columns(spark, make_flows):
    path = new_path(spark, "csv")
    names = make_flows({}).columns
    write_flows_csv(make_flows({}), path)
    swapped = make_flows({"flow_id": "F-9"}).select(*reversed(names))
    write_flows_csv(swapped, path, mode="append")
    with pytest.raises(Exception, match="(?i)header"):
        read_flows_csv(spark, path).collect()


def test_csv_whole_numbers_may_have_a_fraction(spark, make_flows):
    path = new_path(spark, "csv")
    odd = make_flows({"is_anomaly": 1, "tos": 4}, {"is_anomaly": None}).withColumns(
        {c: F.col(c).cast("double") for c in ("tos", "is_anomaly")}
    )
    back = {r["flow_id"]: r for r in read_flows_csv(spark, write_flows_csv(odd, path)).collect()}
    assert (back["F-0"]["is_anomaly"], back["F-0"]["tos"]) == (1, 4) and back["F-1"]["is_anomaly"] is None


def test_box_statistics_keep_rows_without_group(spark):
    rows = [("a", float(k)) for k in range(9)] + [(None, float(k)) for k in range(5)]
    got = {r["label"]: r for r in reports.box_statistics(spark.createDataFrame(rows, "label string, x double"), ["x"]).collect()}
    assert set(got) == {"a", None} and got[None]["n"] == 5 and got[None]["q50"] == 2.0


def test_unknown_preset_is_refused():
    with pytest.raises(ValueError, match="presets are"):
        reports.preset_threshold("balance", 0.7)


def test_csv_columns_may_be_reordered_and_extended(spark, make_flows):
    shuffled = make_flows({}).select(F.lit("x").alias("note"), *reversed(make_flows({}).columns))
    back = read_flows_csv(spark, write_flows_csv(shuffled, new_path(spark, "csv")))
    assert back.first()["note"] == "x" and back.first()["dst_port"] == 443


@pytest.mark.parametrize("layout, view", [("cidds-001", "raw_cidds"), ("cic-ids2017", "raw_cic")])
def test_other_layouts(spark, layout, view):
    doc = evaluate_benchmark(trained_model(spark, SF), stored_view(spark, SF, view), layout).first()
    matrix = doc["confusion_matrix"].asDict()
    assert sum(matrix.values()) == 6000
    assert doc["auroc"] > 0.6
    with pytest.raises(ValueError, match="unknown layout"):
        normalise_benchmark(stored_view(spark, SF, view), "other")


def test_stream_gives_the_alerts_of_the_batch(spark):
    stream = QUERIES["ext1_stream_alerts"](spark, SF)
    batch = QUERIES["tri5_alerts"](spark, SF).select(*stream.columns)
    assert stream.count() > 0
    assert stream.exceptAll(batch).isEmpty() and batch.exceptAll(stream).isEmpty()


def test_presets_and_queue(spark):
    scored = stored_view(spark, SF, "scored_surrogate")
    assert reports.preset_threshold("balanced", 0.7) == 0.55
    assert reports.preset_threshold("calibrated", 0.6847) == 0.68
    assert reports.preset_threshold("calibrated", 0.1) == 0.20
    queue = reports.incident_queue(scored, 0.5).collect()
    scores = [r["anomaly_score"] for r in queue]
    assert scores == sorted(scores, reverse=True) and {r["status"] for r in queue} == {"FLAGGED"}
    page = reports.queue_page(scored, 0.5).collect()
    assert [r["flow_id"] for r in page] == [r["flow_id"] for r in queue[:30]]
    row = reports.kpis(scored, 0.5, with_labels=False).first()
    assert row["fpr_pct"] == 0.0 and row["flagged_flows"] == len(queue)


def test_bounded_sample_is_repeatable(spark):
    flows = stored_view(spark, SF, "flows")
    one, two = (reports.bounded_sample(d).select("flow_id").collect() for d in (flows, flows.repartition(3)))
    assert len(one) == 500 and sorted(one) == sorted(two)


def test_cluster_needs_a_shared_folder(spark, monkeypatch):
    class Session:
        class conf:
            @staticmethod
            def get(key, default=None):
                return default

        class sparkContext:
            master = "spark://host:7077"

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        storage.shared_dir(Session)


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_plans_stay_narrow(spark):
    flows = stored_view(spark, SF, "flows")
    model = trained_model(spark, SF)
    from flowsift.plans.pipeline import prepare, score_flows

    scored = _plan(score_flows(model, prepare(flows, unique_ids=True)))
    assert "Exchange" not in scored and scored.count("ArrowEvalPython") == 1
    assert "PushedFilters: [IsNotNull" in scored
    narrow = _plan(reports.flagged_share(stored_view(spark, SF, "scored_surrogate"), 0.5))
    assert "ReadSchema: struct<anomaly_score:double>" in narrow


def test_importance_covers_every_flagged_flow(spark):
    base, evaluation = _split(spark, SF)
    result = run_pipeline(base, evaluation, ForestConfig(n_trees=5), target_fpr=0.3)
    flagged = result.scored.where("is_alert = 1")
    assert flagged.count() > 500
    want = feature_importance(FlowExplainer(result.model.forest).compute_anomaly_shap(result.model.scaler.with_scaled(flagged)))
    got = {r.feature: r.mean_abs_shap for r in result.importance.collect()}
    assert got == pytest.approx({r.feature: r.mean_abs_shap for r in want.collect()})
