"""Evaluation of a trained model on another dataset layout."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from flowsift.operators.convert import convert_cic, convert_cidds
from flowsift.operators.evaluate import evaluate_detection
from flowsift.operators.validate import validate_and_clean
from flowsift.plans.pipeline import score_flows
from flowsift.sources.models import FlowModel, load_model
from flowsift.sources.publish import current, parquet, publish
from flowsift.sources.tables import read_metrics, write_flows_parquet, write_json
from flowsift.storage import materialize

CONVERTERS = {"cidds-001": convert_cidds, "cic-ids2017": convert_cic}


def normalise_benchmark(raw: DataFrame, layout: str, ids: str = "content") -> DataFrame:
    """Raw layout -> cleaned flows."""
    if layout not in CONVERTERS:
        raise ValueError(f"unknown layout {layout}; known: {sorted(CONVERTERS)}")
    return validate_and_clean(CONVERTERS[layout](raw, ids=ids))


def evaluate_benchmark(model: FlowModel, raw: DataFrame, layout: str) -> DataFrame:
    """Convert, clean, scale with the stored baseline statistics, score, measure.

    The metrics need no ids that outlive the run, so nothing is shuffled before
    the scores are counted.
    """
    scored = score_flows(model, normalise_benchmark(raw, layout, ids="position"))
    stored = materialize(scored.select("anomaly_score", "is_anomaly", "label"), "benchmark-scores")
    return evaluate_detection(stored, model.forest.threshold)


def run_benchmark(spark: SparkSession, model_path: str, raw: DataFrame, layout: str, publish_dir: str) -> DataFrame:
    """The evaluation as a job: converted flows, their scores and the metrics, published together.

    Returns the published metrics.
    """
    model = load_model(spark, model_path)
    flows = materialize(normalise_benchmark(raw, layout), "benchmark-flows")
    scored = materialize(score_flows(model, flows), "benchmark-scored")
    publish(
        spark,
        publish_dir,
        {
            "flows": lambda path: write_flows_parquet(flows, path, partition_by_date=True),
            "scored": parquet(scored.select("flow_id", "label", "is_anomaly", "raw_score", "anomaly_score", "is_alert")),
            "metrics": lambda path: write_json(evaluate_detection(scored, model.forest.threshold), path),
        },
    )
    return read_metrics(spark, current(spark, publish_dir)["metrics"])
