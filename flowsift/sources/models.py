"""Fitted models as Parquet tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession

from flowsift.operators.forest import IsolationForest, forest_table
from flowsift.operators.scaling import FlowScaler
from flowsift.schema import ForestConfig
from flowsift.sources.publish import current, parquet, publish

_META = (
    "n_trees int, sample_size int, seed bigint, contamination double, psi int, "
    "score_min double, score_max double, threshold double, scaler_type string"
)


@dataclass
class FlowModel:
    """Scaler and forest belong together and are stored together."""

    scaler: FlowScaler
    forest: IsolationForest


def save_model(spark: SparkSession, model: FlowModel, path: str) -> str:
    """Publish ``forest_nodes``, ``scaler`` and ``model_meta`` below ``path``, all or nothing."""
    forest, config = model.forest, model.forest.config
    meta = (
        config.n_trees,
        config.sample_size,
        config.seed,
        config.contamination,
        forest.psi,
        forest.score_min,
        forest.score_max,
        forest.threshold,
        model.scaler.scaler_type,
    )
    # Small bounded tables: one file each.
    tables = {
        "forest_nodes": forest_table(spark, forest),
        "scaler": model.scaler.table(spark),
        "model_meta": spark.createDataFrame([meta], _META),
    }
    publish(spark, path, {name: parquet(table.coalesce(1)) for name, table in tables.items()})
    return path


def load_model(spark: SparkSession, path: str) -> FlowModel:
    """Read a stored model; a missing one raises ``FileNotFoundError``."""
    paths = current(spark, path)
    meta = spark.read.parquet(paths["model_meta"]).first()
    # Bounded: at most n_trees * (2 * sample_size - 1) nodes.
    nodes = spark.read.parquet(paths["forest_nodes"]).toPandas()
    config = ForestConfig(meta["n_trees"], meta["sample_size"], meta["seed"], meta["contamination"])
    forest = IsolationForest.from_nodes(
        nodes.sort_values(["tree_id", "node_id"], ignore_index=True),
        meta["psi"],
        meta["score_min"],
        meta["score_max"],
        meta["threshold"],
        config,
    )
    scaler = FlowScaler.from_table(spark.read.parquet(paths["scaler"]), meta["scaler_type"])
    return FlowModel(scaler, forest)
