"""Shapley attribution of the forest's path length, as one Arrow function.

For a leaf of value v, the features on its path, their cover ratios z and
indicators o (the row passes every test on that feature) determine what the leaf
contributes (path-dependent TreeSHAP, Lundberg et al. 2018):

    phi_j += v (o_j - z_j) sum_s s! (m-s-1)! / m! e_s

with e_s the coefficient of t^s in prod_{i != j} (z_i + o_i t). The weights are a
Beta integral, so the sum equals

    integral_0^1 prod_{i != j} (z_i (1-t) + o_i t) dt

a polynomial of degree m - 1, which Gauss-Legendre quadrature with m / 2 points
integrates exactly. At a point t the product runs down the tree and the sum over
leaves runs up again, each edge adding its share to its feature (a split on a
feature seen before replaces the factor of the earlier split). All rows of a
batch go through a level of a tree at once.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowsift.operators.features import feature_vector
from flowsift.operators.forest import IsolationForest, numbers
from flowsift.schema import FEATURES

# Rows per step: the working arrays of one tree then stay in the processor cache.
_CHUNK = 256
# Tasks that may share the rows of one feature vector.
SALTS = 4
# Splits of a forest up to which a row is attributed faster than it is moved to another task.
FEW_SPLITS = 1000


def _compile_tree(tree: pd.DataFrame) -> dict | None:
    """Edges of one tree in breadth-first order as arrays; None for a bare root.

    An edge is named by its lower node. Index -1 stands for "no earlier edge".
    """
    nodes = {r.node_id: r for r in tree.itertuples()}
    inner = [n for n in nodes.values() if n.feature >= 0]
    if not inner:
        return None
    inner_row = {n.node_id: i for i, n in enumerate(inner)}
    points, weights = np.polynomial.legendre.leggauss((max(n.depth for n in nodes.values()) + 1) // 2)
    t, w = (points + 1) / 2, weights / 2

    # (node, edge index, {feature: latest edge index}), level by level
    level, edges, bounds = [(nodes[0], -1, {})], [], [0]
    while level:
        below = []
        for node, edge, latest in level:
            if node.feature < 0:
                continue
            for child_id, flip in ((node.left, False), (node.right, True)):
                child, before = nodes[child_id], latest.get(node.feature, -1)
                z_before = edges[before]["z"] if before >= 0 else 1.0
                index = len(edges)
                edges.append(
                    {
                        "parent": edge,
                        "test": inner_row[node.node_id],
                        "flip": flip,
                        "before": before,
                        "feature": node.feature,
                        "z": z_before * child.n / node.n,
                        "z_before": z_before,
                        # The value of a leaf rides on the factor of its edge.
                        "value": child.value if child.feature < 0 else 1.0,
                    }
                )
                below.append((child, index, {**latest, node.feature: index}))
        if below:
            bounds.append(len(edges))
        level = below
    col = {k: np.array([e[k] for e in edges]) for k in edges[0]}

    def factor(z, o):
        return z[:, None, None] * (1 - t) + o[None, :, None] * t

    # A row passes an edge's tests now and before: (0,0), (0,1) or (1,1).
    now, earlier = np.array([0.0, 0.0, 1.0]), np.array([0.0, 1.0, 1.0])
    z, z_before = col["z"], col["z_before"]
    f_now, f_earlier = factor(z, now), factor(z_before, earlier)
    share = (now[None, :] - z[:, None])[:, :, None] / f_now
    share_earlier = (earlier[None, :] - z_before[:, None])[:, :, None] / f_earlier
    features, which = np.unique(col["feature"], return_inverse=True)
    return {
        "split_feature": np.array([n.feature for n in inner], dtype=np.intp),
        "split_threshold": np.array([n.threshold for n in inner]),
        "test": col["test"],
        "flip": col["flip"][:, None],
        "before": col["before"],
        "parent": col["parent"],
        "bounds": bounds,
        "first_state": 3 * np.arange(len(edges))[:, None],
        "ratio": (col["value"][:, None, None] * f_now / f_earlier).reshape(-1, len(t)),
        "share": (w * (share - share_earlier)).reshape(-1, len(t)),
        "features": features.astype(np.intp),
        "of_feature": (which == np.arange(len(features))[:, None]).astype(np.float64),
    }


def _buffers(trees: list[dict], n_rows: int) -> dict:
    """Working memory for any of the trees, allocated once per batch size."""
    edges = max(len(t["test"]) for t in trees)
    points = max(t["ratio"].shape[1] for t in trees)
    return {
        "now": np.empty((edges + 1) * n_rows, dtype=np.uint8),
        "state": np.empty(edges * n_rows, dtype=np.intp),
        "product": np.empty((edges + 1) * n_rows * points),
        "gathered": np.empty(edges * n_rows * points),
    }


def _tree_phi(tree: dict, x: np.ndarray, buffers: dict) -> np.ndarray:
    """(features of the tree, rows) contributions to the path length."""
    left = (x[:, tree["split_feature"]] <= tree["split_threshold"]).T
    passes = (left[tree["test"]] ^ tree["flip"]).view(np.uint8)
    n_edges, n_rows = passes.shape
    points = tree["ratio"].shape[1]
    levels = list(zip(tree["bounds"][:-1], tree["bounds"][1:]))

    def view(name: str, *shape: int) -> np.ndarray:
        return buffers[name][: int(np.prod(shape))].reshape(shape)

    # One more row, reached by index -1: no earlier edge, every test passed, product 1.
    now, state = view("now", n_edges + 1, n_rows), view("state", n_edges, n_rows)
    product, gathered = view("product", n_edges + 1, n_rows, points), view("gathered", n_edges, n_rows, points)
    now[-1], product[-1] = 1, 1.0
    # Siblings are adjacent, left at an even place, so a level is a list of pairs.
    for a, b in levels:
        earlier = now[tree["before"][a:b]]
        np.bitwise_and(passes[a:b], earlier, out=now[a:b])
        state[a:b] = now[a:b] + earlier
    state += tree["first_state"]
    np.take(tree["ratio"], state, axis=0, out=gathered, mode="clip")
    for a, b in levels:
        pair = ((b - a) // 2, 2, n_rows, points)
        parent = product[tree["parent"][a:b:2]][:, None]
        np.multiply(parent, gathered[a:b].reshape(pair), out=product[a:b].reshape(pair))
    for a, b in reversed(levels[1:]):
        product[tree["parent"][a:b:2]] = product[a:b:2] + product[a + 1 : b : 2]
    np.take(tree["share"], state, axis=0, out=gathered, mode="clip")
    np.multiply(gathered, product[:-1], out=gathered)
    by_edge = (gathered.reshape(-1, points) @ np.ones(points)).reshape(n_edges, n_rows)
    return tree["of_feature"] @ by_edge


def _forest_phi(trees: list[dict], x: np.ndarray) -> np.ndarray:
    """(features, rows) contributions summed over the trees."""
    phi = np.zeros((x.shape[1], len(x)))
    if trees:
        buffers = _buffers(trees, min(_CHUNK, len(x)))
        for start in range(0, len(x), _CHUNK):
            part = x[start : start + _CHUNK]
            for tree in trees:
                phi[tree["features"], start : start + _CHUNK] += _tree_phi(tree, part, buffers)
    return phi


def distinct_rows(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct rows of ``x``, and for each row the place of its like among them."""
    as_bytes = np.ascontiguousarray(x).view(np.dtype((np.void, x.dtype.itemsize * x.shape[1]))).ravel()
    _, first, which = np.unique(as_bytes, return_index=True, return_inverse=True)
    return x[first], which


def cell_cuts(nodes: pd.DataFrame) -> dict[int, np.ndarray]:
    """Split points per feature of the forest, ascending. Rows between the same ones pass the same tests."""
    inner = nodes[nodes["feature"] >= 0]
    return {int(f): np.unique(rows["threshold"].to_numpy(dtype=np.float64)) for f, rows in inner.groupby("feature", sort=True)}


def distinct_cells(values: list[np.ndarray], cuts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """A row of each cell that occurs, and for each row the place of its cell among them.

    ``values`` and ``cuts`` hold one array per feature that the forest splits on. NaN lies above
    every split point, where the tests send it.
    """
    codes = [np.searchsorted(c, v) for v, c in zip(values, cuts)]
    if math.prod(len(c) + 1 for c in cuts) < 2**62:
        cell = codes[0].astype(np.int64)
        for code, c in zip(codes[1:], cuts[1:]):
            cell = cell * (len(c) + 1) + code
    else:
        wide = np.column_stack([code.astype(np.int32) for code in codes])
        cell = wide.view(np.dtype((np.void, wide.dtype.itemsize * wide.shape[1]))).ravel()
    _, first, which = np.unique(cell, return_index=True, return_inverse=True)
    return first, which


def base_value(forest: IsolationForest) -> float:
    """Attribution of nothing: minus the expected path length."""
    nodes = forest._require_fitted()
    leaves = nodes[nodes["feature"] < 0]
    root = nodes[nodes["node_id"] == 0].set_index("tree_id")["n"]
    cover = leaves["n"] / leaves["tree_id"].map(root)
    return -float((cover * leaves["value"]).sum() / len(root))


class FlowExplainer:
    """Attribution of a fitted forest; positive values drive a flow towards an alert."""

    def __init__(self, forest: IsolationForest):
        if not forest.is_fitted:
            raise RuntimeError("attribution needs a forest that has been fitted")
        self.forest = forest
        self.base_value = base_value(forest)
        self._broadcast = None

    def _compiled(self):
        if self._broadcast is None:
            groups = self.forest.nodes.groupby("tree_id", sort=True)
            trees = [_compile_tree(tree) for _, tree in groups]
            self._broadcast = SparkSession.active().sparkContext.broadcast(([t for t in trees if t], len(trees)))
        return self._broadcast

    def phi(self) -> Column:
        """Array of 24 attributions, as a column over the feature columns.

        Only features that the forest splits on cross into Python. A batch attributes each cell
        of the forest's split points once: its rows pass the same tests, so they agree.
        """
        compiled = self._compiled()
        cuts = cell_cuts(self.forest.nodes)
        used, cuts = list(cuts), list(cuts.values())

        @F.arrow_udf("array<double>")
        def attribute(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
            trees, n_trees = compiled.value
            for batch in batches:
                values = numbers(batch)
                n = len(values[0])
                if used and n:
                    first, which = distinct_cells(values, cuts)
                    x = np.zeros((len(first), len(FEATURES)))
                    x[:, used] = np.column_stack([v[first] for v in values])
                    phi = np.ascontiguousarray((_forest_phi(trees, x) / -n_trees).T)[which]
                else:
                    phi = np.zeros((n, len(FEATURES)))
                offsets = np.arange(n + 1, dtype=np.int32) * len(FEATURES)
                yield pa.ListArray.from_arrays(pa.array(offsets), pa.array(phi.ravel()))

        vector = feature_vector()
        # A deterministic function would be pushed into filters and run twice.
        return attribute.asNondeterministic()(*[vector[f] for f in used or [0]])

    def compute_anomaly_shap(self, features: DataFrame) -> DataFrame:
        """``features`` with ``phi``; run it on alerted or sampled flows only.

        A batch attributes each distinct cell once. For a forest of many splits rows are first
        dealt out by their vector, so equal ones meet in a batch and a task that holds most of
        the flagged flows shares them with the others. A vector that most rows have goes to
        ``SALTS`` tasks. For a forest of up to ``FEW_SPLITS`` splits moving the rows would cost
        more than it saves, so they stay where they are. Streams keep the partitions of their source.
        """
        if not features.isStreaming and int((self.forest.nodes["feature"] >= 0).sum()) > FEW_SPLITS:
            tasks = int(features.sparkSession.conf.get("spark.sql.shuffle.partitions"))
            others = [f"`{c}`" for c, kind in features.dtypes if c not in FEATURES and "map<" not in kind]
            salt = F.pmod(F.xxhash64(*others), F.lit(SALTS)) if others else F.lit(0)
            features = features.repartition(tasks, F.xxhash64(*FEATURES), salt)
        return features.withColumn("phi", self.phi())


def long_attributions(df: DataFrame, keep: list[str]) -> DataFrame:
    """One row per flow and feature: ``keep``, ``feature_index``, ``feature``, ``phi``."""
    names = F.array(*[F.lit(n) for n in FEATURES])
    return df.select(*keep, F.posexplode("phi").alias("feature_index", "phi")).withColumn(
        "feature", F.element_at(names, F.col("feature_index") + 1)
    )


def feature_importance(df: DataFrame) -> DataFrame:
    """Mean absolute attribution per feature, largest first: one aggregate, 24 sums."""
    sums = df.agg(*[F.avg(F.abs(F.col("phi")[i])).alias(name) for i, name in enumerate(FEATURES)])
    return (
        sums.unpivot([], FEATURES, "feature", "mean_abs_shap")
        .orderBy(F.col("mean_abs_shap").desc(), "feature")
    )
