import itertools
import math

import numpy as np
import pandas as pd
import pytest
from conftest import SF
from pyspark.sql import functions as F

from flowsift.operators.attribution import FlowExplainer, _compile_tree, _forest_phi, distinct_rows, feature_importance
from flowsift.operators.forest import (
    IsolationForest,
    _dense,
    _grow,
    _joined_trees,
    _mean_path,
    average_path,
    calibrate_threshold,
    sample_per_tree,
)
from flowsift.plans.catalog import _split
from flowsift.plans.frozen import frozen_model
from flowsift.plans.pipeline import prepare, score_flows, train_model
from flowsift.schema import FEATURES, ForestConfig
from flowsift.sources.models import load_model, save_model
from flowsift.storage import new_path

COLUMNS = ["tree_id", "node_id", "feature", "threshold", "left", "right", "n", "depth", "value"]


def small_tree(seed, rows=64, depth=5, used=5):
    x = np.zeros((rows, len(FEATURES)))
    x[:, :used] = np.random.default_rng(seed).random((rows, used)).round(1 if seed % 2 else 6)
    return pd.DataFrame(_grow(seed, x, 42, depth), columns=COLUMNS), x


def walk(tree, row):
    nodes = {r.node_id: r for r in tree.itertuples()}
    node = nodes[0]
    while node.feature >= 0:
        node = nodes[node.left if row[node.feature] <= node.threshold else node.right]
    return node.value


def expected(tree, row, known):
    """Value of a coalition: unknown features follow the cover of the children."""
    nodes = {r.node_id: r for r in tree.itertuples()}

    def at(i):
        node = nodes[i]
        if node.feature < 0:
            return node.value
        if node.feature in known:
            return at(node.left if row[node.feature] <= node.threshold else node.right)
        return sum(nodes[c].n * at(c) for c in (node.left, node.right)) / node.n

    return at(0)


def shapley(tree, row, used):
    phi = np.zeros(len(FEATURES))
    for j in range(used):
        others = [f for f in range(used) if f != j]
        for size in range(used):
            weight = math.factorial(size) * math.factorial(used - size - 1) / math.factorial(used)
            for s in itertools.combinations(others, size):
                phi[j] += weight * (expected(tree, row, {*s, j}) - expected(tree, row, set(s)))
    return phi


@pytest.mark.parametrize("seed", range(4))
def test_attribution_equals_brute_force(seed):
    tree, x = small_tree(seed)
    phi = _forest_phi([_compile_tree(tree)], x[:12])
    for i in range(12):
        assert phi[:, i] == pytest.approx(shapley(tree, x[i], 5), abs=1e-12)


@pytest.mark.parametrize("depth", [1, 2, 8, 10])
def test_deep_trees_keep_local_accuracy(depth):
    tree, x = small_tree(2, rows=300, depth=depth, used=9)
    phi = _forest_phi([_compile_tree(tree)], x)
    paths = np.array([walk(tree, row) for row in x])
    leaves = tree[tree.feature < 0]
    mean = (leaves.n * leaves.value).sum() / 300
    assert phi.sum(axis=0) + mean == pytest.approx(paths, abs=1e-10)
    assert _mean_path(_dense(tree), np.ascontiguousarray(x.T)) == pytest.approx(paths)


def test_average_path():
    assert (average_path(1), average_path(2)) == (0.0, 1.0)
    assert average_path(256) == pytest.approx(10.244770920116851)


def test_sample_is_exact_and_repeatable(spark):
    keys = spark.range(5000).select(F.col("id").cast("string").alias("k"))
    config = ForestConfig(n_trees=20)
    for pool in (10**6, 1500):
        one, two = (
            sample_per_tree(d, "k", config, pool_rows=pool).toPandas() for d in (keys.repartition(3), keys.repartition(7))
        )
        assert (one.groupby("tree_id").size() == 256).all()
        assert not one.duplicated().any()
        assert sorted(map(tuple, one.values)) == sorted(map(tuple, two.values))


@pytest.mark.parametrize("n", [1, 255, 256, 300, 390, 2000, 400_000])
def test_one_rule_at_every_size(spark, n):
    config = ForestConfig(n_trees=40)
    keys = spark.range(n).select(F.col("id").cast("string").alias("k"))
    sample = sample_per_tree(keys, "k", config).toPandas()
    assert (sample.groupby("tree_id").size() == min(n, 256)).all() and sample.tree_id.nunique() == 40
    assert not sample.duplicated().any()


def test_rows_join_few_trees(spark):
    """Candidates are about 1.5 samples a tree, evenly over trees and independent of each other."""
    trees, n = 150, 100_000
    joined = _joined_trees(F.col("id"), 1.5 * 256 / n, trees, 42)
    rows = spark.range(n).select("id", joined.alias("t")).where("t IS NOT NULL")
    drawn = rows.select("id", F.explode("t").alias("t")).toPandas()
    assert len(drawn) <= 2 * trees * 256 and not drawn.duplicated().any()
    per_tree = drawn.groupby("t").size()
    assert len(per_tree) == trees and per_tree.min() > 300 and per_tree.max() < 470
    many = spark.range(3000).select(F.explode(_joined_trees(F.col("id"), 0.3, 50, 1)).alias("t"), "id").toPandas()
    together = many[many.t == 3].merge(many[many.t == 4], on="id")
    assert abs(len(together) / 3000 - 0.09) < 0.02 and abs(len(many) / 150_000 - 0.3) < 0.01


def test_unfitted_model_and_explainer():
    with pytest.raises(RuntimeError, match="fitted"):
        IsolationForest().raw_score()
    with pytest.raises(RuntimeError, match="fitted"):
        FlowExplainer(IsolationForest())


@pytest.fixture(scope="module")
def trained(spark):
    base, evaluation = (prepare(d) for d in _split(spark, SF))
    return train_model(base, ForestConfig(n_trees=50), target_fpr=0.04), base, evaluation


def test_training_invariants(trained):
    model, base, _ = trained
    nodes = model.forest.nodes
    leaves = nodes[nodes.feature < 0]
    assert (leaves.groupby("tree_id").n.sum() == 256).all() and nodes.depth.max() <= 8
    scored = score_flows(model, base)
    low, high, flagged = scored.agg(F.min("anomaly_score"), F.max("anomaly_score"), F.avg("is_alert")).first()
    assert (low, high) == (0.0, 1.0)
    assert abs(flagged - 0.04) <= 0.02
    assert model.forest.threshold == pytest.approx(calibrate_threshold(scored, 0.04))


def test_training_does_not_depend_on_partitions(spark, trained):
    model, base, _ = trained
    again = train_model(base.repartition(3), ForestConfig(n_trees=50), target_fpr=0.04)
    pd.testing.assert_frame_equal(model.forest.nodes, again.forest.nodes)
    assert again.forest.threshold == pytest.approx(model.forest.threshold)


def test_save_load_gives_equal_scores(spark, trained):
    model, _, evaluation = trained
    loaded = load_model(spark, save_model(spark, model, new_path(spark, "model")))
    assert loaded.forest.config == model.forest.config and loaded.scaler.stats == model.scaler.stats
    a, b = (score_flows(m, evaluation).select("row_key", "anomaly_score", "is_alert") for m in (model, loaded))
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
    with pytest.raises(FileNotFoundError):
        load_model(spark, new_path(spark, "none"))


def test_importance_is_sorted_and_not_negative(trained):
    model, _, evaluation = trained
    features = model.scaler.with_scaled(evaluation.limit(100))
    rows = feature_importance(FlowExplainer(model.forest).compute_anomaly_shap(features)).collect()
    values = [r["mean_abs_shap"] for r in rows]
    assert len(rows) == 24 and min(values) >= 0 and values == sorted(values, reverse=True)


def test_calibration_on_other_flows(spark, trained):
    model, base, _ = trained
    forest = IsolationForest.from_nodes(
        model.forest.nodes, 256, model.forest.score_min, model.forest.score_max, 0.5, model.forest.config
    )
    assert forest.calibrate_threshold_by_fpr(model.scaler.transform(base), 0.04) == pytest.approx(model.forest.threshold)
    with pytest.raises(RuntimeError):
        frozen_model().forest.calibrate_threshold_by_fpr()


def test_equal_vectors_are_attributed_once():
    x = np.repeat(np.random.default_rng(1).random((5, len(FEATURES))), [1, 400, 3, 1, 95], axis=0)
    distinct, which = distinct_rows(x)
    assert len(distinct) == 5 and (distinct[which] == x).all()


def test_hot_vector_is_spread_and_keeps_its_attributions(spark):
    model = frozen_model()
    rows = [tuple(float(j == 0) * 50 + (i % 3 == 0) * i for j in range(len(FEATURES))) + (f"F-{i}",) for i in range(300)]
    df = spark.createDataFrame(rows, ", ".join(f"{f} double" for f in FEATURES) + ", flow_id string")
    explainer = FlowExplainer(model.forest)
    spread = explainer.compute_anomaly_shap(df).withColumn("part", F.spark_partition_id())
    hot = spread.where(F.col(FEATURES[1]) == 0).groupBy("part").count().collect()
    assert len(hot) > 1
    whole = {r["flow_id"]: r["phi"] for r in df.select("flow_id", explainer.phi().alias("phi")).collect()}
    assert {r["flow_id"]: r["phi"] for r in spread.collect()} == whole
