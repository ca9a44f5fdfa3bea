"""Training, scoring, explanation, evaluation and alerts, end to end."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowsift.operators.attribution import FlowExplainer, feature_importance
from flowsift.operators.evaluate import evaluate_detection, tradeoff_curve
from flowsift.operators.explain import baseline_statistics, explain_flows
from flowsift.operators.forest import IsolationForest, flag_alerts
from flowsift.operators.reports import bounded_sample, flagged_share, kpis, most_anomalous, preset_threshold, top_flagged
from flowsift.operators.rowkeys import with_row_key
from flowsift.operators.scaling import FlowScaler
from flowsift.operators.triage import create_alerts
from flowsift.operators.validate import validate_and_clean
from flowsift.schema import DAILY_FLOWS, FEATURES, TARGET_FPR, TOP_K, ForestConfig
from flowsift.sources.models import FlowModel, load_model, save_model
from flowsift.sources.publish import parquet, publish
from flowsift.sources.tables import write_flows_parquet, write_json
from flowsift.storage import materialize

KEY = "row_key"


def train_model(
    baseline: DataFrame, config: ForestConfig | None = None, target_fpr: float = TARGET_FPR, scaler_type: str = "robust"
) -> FlowModel:
    """Scaler, forest and calibrated threshold from benign flows.

    ``baseline`` is cleaned and has a unique ``row_key``.
    """
    scaler = FlowScaler(scaler_type).fit(baseline)
    features = scaler.transform(baseline, keep=[KEY])
    return FlowModel(scaler, IsolationForest(config).fit(features, key=KEY, quantile=1.0 - target_fpr))


def score_flows(model: FlowModel, flows: DataFrame, threshold: float | None = None) -> DataFrame:
    """Flow columns with ``raw_score``, ``anomaly_score`` and ``is_alert``: one pass, no shuffle."""
    scored = model.forest.compute_anomaly_scores(model.scaler.with_scaled(flows)).drop(*FEATURES)
    return flag_alerts(scored, model.forest.threshold if threshold is None else threshold)


def explain_scored(
    model: FlowModel, scored: DataFrame, k: int = TOP_K, threshold: float | None = None, key: str = KEY
) -> DataFrame:
    """Explanations of scored flows. Filter first: attribution costs far more than scoring."""
    explainer = FlowExplainer(model.forest)
    attributed = explainer.compute_anomaly_shap(model.scaler.with_scaled(scored))
    limit = model.forest.threshold if threshold is None else threshold
    return explain_flows(attributed.drop("raw_score"), limit, k, key=key)


def alerts_for(
    model: FlowModel,
    scored: DataFrame,
    run_date: dt.date | None = None,
    use_label: bool = True,
    key: str = KEY,
    threshold: float | None = None,
) -> DataFrame:
    """Explained and enriched alerts of every flagged flow; a ``threshold`` of its own flags anew."""
    flagged = scored.where(F.col("is_alert") == 1) if threshold is None else scored.where(F.col("anomaly_score") >= threshold)
    explained = explain_scored(model, flagged, threshold=threshold, key=key)
    return create_alerts(explained, run_date, use_label=use_label, key=key)


def prepare(flows: DataFrame, unique_ids: bool = False) -> DataFrame:
    """Cleaned flows with a unique key.

    ``unique_ids=True`` states that ``flow_id`` is unique (as ids from the
    converters are) and saves the shuffle of all ids that checks it.
    """
    clean = validate_and_clean(flows)
    return clean.withColumn(KEY, F.col("flow_id")) if unique_ids else with_row_key(clean, name=KEY)


@dataclass
class FeedResult:
    scored: DataFrame
    kpis: DataFrame
    alerts: DataFrame


def score_feed(
    spark: SparkSession,
    model_path: str,
    feed: DataFrame,
    threshold: float | None = None,
    preset: str | None = None,
    run_date: dt.date | None = None,
    publish_dir: str | None = None,
    with_labels: bool = False,
    daily_flows: int = DAILY_FLOWS,
) -> FeedResult:
    """Clean, score and explain a new feed with a stored model: a threshold, a named preset, or the model's own.

    Every flagged flow gets an alert. With ``publish_dir`` scored flows, alerts and the
    feed's figures are published together.
    """
    model = load_model(spark, model_path)
    if preset is not None:
        threshold = preset_threshold(preset, model.forest.threshold)
    limit = model.forest.threshold if threshold is None else float(threshold)
    scored = materialize(score_flows(model, prepare(feed), limit), "scored-feed")
    figures = kpis(scored, limit, with_labels).withColumns(
        {
            "threshold": F.lit(limit),
            "projected_daily_alerts": (F.col("flagged_pct") / 100.0 * daily_flows).cast("bigint"),
        }
    )
    result = FeedResult(scored, figures, alerts_for(model, scored, run_date, use_label=with_labels, threshold=limit))
    if publish_dir:
        publish(
            spark,
            publish_dir,
            {
                "scored": lambda path: write_flows_parquet(scored, path, partition_by_date=True),
                "alerts": lambda path: write_json(result.alerts, path),
                "kpis": lambda path: write_json(figures, path),
            },
        )
    return result


@dataclass
class PipelineResult:
    model: FlowModel
    scored: DataFrame
    flagged: DataFrame
    importance: DataFrame
    top_explanation: DataFrame
    metrics: DataFrame
    tradeoff: DataFrame
    alerts: DataFrame
    baseline: DataFrame | None  # statistics of the scaled baseline, where results are published


def run_pipeline(
    baseline: DataFrame,
    evaluation: DataFrame,
    config: ForestConfig | None = None,
    target_fpr: float = TARGET_FPR,
    max_alerts: int | None = 50,
    run_date: dt.date | None = None,
    output_dir: str | None = None,
    unique_ids: bool = False,
    importance_rows: int | None = None,
    scaler_type: str = "robust",
    daily_flows: int = DAILY_FLOWS,
    model: FlowModel | None = None,
    publish_dir: str | None = None,
) -> PipelineResult:
    """All stages. ``max_alerts=None`` makes an alert of every flagged flow.

    A ready ``model`` is used as it is. ``output_dir`` gets plain folders of the main
    results; ``publish_dir`` gets all results, also importance, trade-off, top explanation
    and baseline statistics, as one version that readers find by ``publish.current``.

    Importance covers every flagged flow; ``importance_rows`` takes a sample of that many
    scored flows by hash of the key instead.

    The scored evaluation table is written once; every later stage reads it.
    """
    base = prepare(baseline, unique_ids)
    model = model or train_model(base, config, target_fpr, scaler_type)
    scored = materialize(score_flows(model, prepare(evaluation, unique_ids)), "scored-flows")
    threshold = model.forest.threshold

    explainer = FlowExplainer(model.forest)
    weighed = scored.where(F.col("is_alert") == 1) if importance_rows is None else bounded_sample(scored, importance_rows, KEY)
    top = most_anomalous(scored)
    chosen = scored if max_alerts is None else top_flagged(scored, threshold, max_alerts)
    result = PipelineResult(
        model=model,
        scored=scored,
        flagged=flagged_share(scored, threshold),
        importance=feature_importance(explainer.compute_anomaly_shap(model.scaler.with_scaled(weighed))),
        top_explanation=explain_scored(model, top),
        metrics=evaluate_detection(scored, threshold, daily_flows),
        tradeoff=tradeoff_curve(scored, daily_flows=daily_flows),
        alerts=alerts_for(model, chosen, run_date),
        baseline=baseline_statistics(model.scaler.transform(base)) if publish_dir else None,
    )
    if output_dir:
        spark = scored.sparkSession
        save_model(spark, model, f"{output_dir}/model")
        write_flows_parquet(scored, f"{output_dir}/scored", partition_by_date=True)
        write_json(result.metrics, f"{output_dir}/evaluation_summary")
        write_json(result.alerts, f"{output_dir}/alerts")
    if publish_dir:
        spark = scored.sparkSession
        stored = {"importance": result.importance, "tradeoff": result.tradeoff, "baseline_statistics": result.baseline}
        publish(
            spark,
            publish_dir,
            {
                "model": lambda path: save_model(spark, model, path),
                "scored": lambda path: write_flows_parquet(scored, path, partition_by_date=True),
                "evaluation_summary": lambda path: write_json(result.metrics, path),
                "alerts": lambda path: write_json(result.alerts, path),
                "top_explanation": lambda path: write_json(result.top_explanation, path),
                **{name: parquet(table) for name, table in stored.items()},
            },
        )
    return result


def run_whole_pipeline(baseline: DataFrame, evaluation: DataFrame, **options) -> PipelineResult:
    """:func:`run_pipeline` with an alert of every flagged flow, whatever their number."""
    return run_pipeline(baseline, evaluation, **{"max_alerts": None, **options})
