"""Attributions of small forests: nothing is moved or stored, only used features reach Python, cells agree."""

import numpy as np
import pandas as pd
import pytest
from conftest import SF
from pyspark.sql import functions as F

from flowsift.functions.narrative import fixed_number, short_number
from flowsift.operators.attribution import FlowExplainer, _compile_tree, _forest_phi, distinct_cells, cell_cuts
from flowsift.operators.explain import WATERFALL_ROWS, top_drivers, waterfall
from flowsift.plans.catalog import QUERIES, _flows, frozen_attributions
from flowsift.plans.frozen import frozen_model
from flowsift.schema import FEATURES
from flowsift.storage import recorded


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_frozen_attributions_are_neither_moved_nor_stored(spark):
    _flows(spark, SF)
    with recorded() as paths:
        attributed = frozen_attributions(spark, SF)
        found = {q: QUERIES[q](spark, SF) for q in ("xai2_attributions", "xai5_top_drivers", "xai7_narrative", "xai10_waterfall")}
        assert all("Exchange" not in _plan(df) for df in [attributed, *found.values()])
    assert paths == []


def test_only_features_of_the_forest_reach_python(spark):
    plan = _plan(frozen_attributions(spark, SF).select("flow_id", "phi"))
    assert "dst_port" not in plan and "src_port" not in plan


def test_cells_agree_with_rows():
    forest = frozen_model().forest
    trees = [_compile_tree(t) for _, t in forest.nodes.groupby("tree_id", sort=True)]
    cuts = cell_cuts(forest.nodes)
    rng = np.random.default_rng(3)
    x = rng.random((500, len(FEATURES))) * 1000
    for f, at in cuts.items():
        x[:, f] = rng.choice([*at, *np.nextafter(at, -np.inf), *np.nextafter(at, np.inf), np.nan, np.inf, -np.inf, -0.0], len(x))
    first, which = distinct_cells([x[:, f] for f in cuts], list(cuts.values()))
    assert len(first) <= np.prod([len(c) + 1 for c in cuts.values()])
    assert np.allclose(_forest_phi(trees, x[first])[:, which], _forest_phi(trees, x), atol=0, rtol=1e-12)


def test_many_cuts_fall_back_to_wide_cells():
    x = np.repeat(np.random.default_rng(1).random((5, 24)), [1, 40, 3, 1, 9], axis=0)
    first, which = distinct_cells(list(x.T), [np.linspace(0, 1, 300)] * 24)
    assert len(first) == 5 and (x[first][which] == x).all()


def test_forest_without_splits_attributes_nothing(spark):
    forest = frozen_model().forest
    roots = forest.nodes[forest.nodes.node_id == 0].assign(feature=-1, value=1.0)
    bare = type(forest).from_nodes(pd.DataFrame(roots), 256, 0.4, 0.8, 0.5)
    df = spark.createDataFrame([(1.0,) * len(FEATURES)] * 3, ", ".join(f"{f} double" for f in FEATURES))
    rows = FlowExplainer(bare).compute_anomaly_shap(df).withColumn("path", bare.path_length()).collect()
    assert [r["phi"] for r in rows] == [[0.0] * len(FEATURES)] * 3 and {r["path"] for r in rows} == {1.0}


def test_ties_go_by_feature_order(spark):
    flat = spark.createDataFrame([("A", [0.0, -0.0] * 12), ("B", [0.5] * 24), ("C", [-0.5] * 24)], "flow_id string, phi array<double>")
    scaled = F.array(*[F.lit(float(i)) for i in range(24)])
    for r in flat.select(top_drivers(F.col("phi"), scaled).alias("d")).collect():
        assert [d["feature"] for d in r["d"]] == FEATURES[:4] and [d["scaled_value"] for d in r["d"]] == [0.0, 1.0, 2.0, 3.0]
    rows = waterfall(flat, 1.0).where("flow_id = 'B'").orderBy("position").collect()
    assert [r["feature"] for r in rows] == [*FEATURES[:7], "17 other features"] and len(rows) == WATERFALL_ROWS
    assert [r["running_total"] for r in rows] == pytest.approx([1.5, 2, 2.5, 3, 3.5, 4, 4.5, 13])


def test_odd_numbers_keep_their_text(spark):
    cases = [(None, "null", "nul"), (float("nan"), "NaN", "NaN"), (float("inf"), "Infinity", "Infinity"), (-0.0, "0.0", "0.000"),
             (1e14, "100000000000000.0", "100000000000000.000"), (-5e-5, "-0.0001", "0.000"), (0.0005, "0.0005", "0.001"), (20.0, "20.0", "20.000")]
    rows = spark.createDataFrame([c[:1] for c in cases], "v double").select(short_number(F.col("v")), fixed_number(F.col("v"), 3)).collect()
    assert [tuple(r) for r in rows] == [c[1:] for c in cases]


def test_forest_of_one_feature(spark):
    at = FEATURES.index("log_pps")
    rows = [(0, 0, at, 5.0, 1, 2, 256, 0, float("nan")), (0, 1, -1, float("nan"), -1, -1, 200, 1, 2.0), (0, 2, -1, float("nan"), -1, -1, 56, 1, 6.0)]
    forest = type(frozen_model().forest).from_nodes(pd.DataFrame(rows, columns=frozen_model().forest.nodes.columns), 256, 0.4, 0.8, 0.5)
    df = spark.createDataFrame([(v,) * len(FEATURES) for v in (4.0, 5.0, 6.0)], ", ".join(f"{f} double" for f in FEATURES))
    found = FlowExplainer(forest).compute_anomaly_shap(df).withColumn("path", forest.path_length()).orderBy(FEATURES[0]).collect()
    base = (200 * 2.0 + 56 * 6.0) / 256
    assert [r["path"] for r in found] == [2.0, 2.0, 6.0]
    assert [r["phi"][at] for r in found] == pytest.approx([base - 2, base - 2, base - 6])
