"""A forest of three small trees, fixed as literals.

Its scores and attributions have a closed form, so another engine can compute
them. It works on unscaled features.
"""

from __future__ import annotations

import pandas as pd

from flowsift.operators.forest import IsolationForest, average_path
from flowsift.operators.scaling import FlowScaler
from flowsift.schema import FEATURES, NUMERIC_FEATURES
from flowsift.sources.models import FlowModel

PSI = 256
SCORE_MIN, SCORE_MAX, THRESHOLD = 0.4, 0.8, 0.5

# tree -> nodes (node id, feature, threshold, rows); a leaf has no feature.
TREES = {
    0: [(0, "log_pps", 5.0, 256), (1, None, None, 200), (2, "is_syn_only", 0.5, 56), (5, None, None, 40), (6, None, None, 16)],
    1: [(0, "bytes_per_packet", 100.0, 256), (1, "log_pps", 6.0, 60), (2, None, None, 196), (3, None, None, 50), (4, None, None, 10)],
    2: [(0, "is_syn_only", 0.5, 256), (1, "bytes_per_packet", 600.0, 240), (2, None, None, 16), (3, None, None, 150), (4, None, None, 90)],
}


def frozen_forest() -> IsolationForest:
    rows = []
    for tree_id, nodes in TREES.items():
        for node_id, feature, threshold, n in nodes:
            depth = (node_id + 1).bit_length() - 1
            if feature is None:
                rows.append((tree_id, node_id, -1, float("nan"), -1, -1, n, depth, depth + average_path(n)))
            else:
                at = FEATURES.index(feature)
                rows.append((tree_id, node_id, at, threshold, 2 * node_id + 1, 2 * node_id + 2, n, depth, float("nan")))
    columns = ["tree_id", "node_id", "feature", "threshold", "left", "right", "n", "depth", "value"]
    return IsolationForest.from_nodes(pd.DataFrame(rows, columns=columns), PSI, SCORE_MIN, SCORE_MAX, THRESHOLD)


def frozen_model() -> FlowModel:
    """The frozen forest behind a scaler that changes nothing."""
    scaler = FlowScaler()
    scaler.stats = {c: (0.0, 1.0) for c in NUMERIC_FEATURES}
    return FlowModel(scaler, frozen_forest())
