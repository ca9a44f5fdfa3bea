"""Scaler fitted on benign flows, applied anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowsift.functions.features import feature_columns
from flowsift.operators.features import extract_features
from flowsift.operators.quantiles import exact_quantiles
from flowsift.schema import FLAG_FEATURES, NUMERIC_FEATURES

SCALER_TYPES = ("robust", "standard")
SCALER_SCHEMA = "feature string, center double, scale double"


class FlowScaler:
    """Centre and scale of the 8 numeric features.

    ``robust``: median and interquartile range. ``standard``: mean and
    population standard deviation. A zero scale becomes 1. The fitted state is
    eight rows, so it travels as literals in the projection. ``exact_rows`` has no effect.
    """

    def __init__(self, scaler_type: str = "robust", exact_rows: int | None = None):
        if scaler_type not in SCALER_TYPES:
            raise ValueError(f"{scaler_type!r} is Unsupported; the scalers are {', '.join(SCALER_TYPES)}")
        self.scaler_type = scaler_type
        self.stats: dict[str, tuple[float, float]] | None = None

    def fit(self, flows: DataFrame, y=None) -> FlowScaler:
        features = flows.select(*[feature_columns()[c].alias(c) for c in NUMERIC_FEATURES])
        fit = self._fit_robust if self.scaler_type == "robust" else self._fit_standard
        self.stats = {c: (center, scale if scale else 1.0) for c, (center, scale) in fit(features).items()}
        return self

    def _fit_robust(self, features: DataFrame) -> dict:
        wanted = {c: [0.25, 0.5, 0.75] for c in NUMERIC_FEATURES}
        by_column = exact_quantiles(features, wanted).get(None)
        if not by_column or any(q[1] is None for q in by_column.values()):
            raise ValueError("scaler needs at least one row with features")
        return {c: (q[1], q[2] - q[0]) for c, q in by_column.items()}

    @staticmethod
    def _fit_standard(features: DataFrame) -> dict:
        row = features.agg(
            *[F.avg(c).alias(f"{c}_avg") for c in NUMERIC_FEATURES],
            *[F.stddev_pop(c).alias(f"{c}_std") for c in NUMERIC_FEATURES],
        ).first()
        if row[f"{NUMERIC_FEATURES[0]}_avg"] is None:
            raise ValueError("scaler needs at least one row with features")
        return {c: (row[f"{c}_avg"], row[f"{c}_std"]) for c in NUMERIC_FEATURES}

    def _fitted(self) -> dict[str, tuple[float, float]]:
        if self.stats is None:
            raise RuntimeError("Scaler must be fitted on baseline flows before transform.")
        return self.stats

    def transform(self, flows: DataFrame, keep: list[str] | None = None) -> DataFrame:
        """Scaled numerics and unchanged flags in model order, after ``keep``."""
        stats = self._fitted()
        raw = extract_features(flows, keep)
        scaled = [((F.col(c) - F.lit(stats[c][0])) / F.lit(stats[c][1])).alias(c) for c in NUMERIC_FEATURES]
        return raw.select(*(keep or []), *scaled, *FLAG_FEATURES)

    def fit_transform(self, flows: DataFrame, y=None) -> DataFrame:
        return self.fit(flows).transform(flows)

    def with_scaled(self, flows: DataFrame) -> DataFrame:
        """All flow columns followed by the 24 scaled features."""
        return self.transform(flows, keep=flows.columns)

    def table(self, spark: SparkSession) -> DataFrame:
        """The state as rows ``(feature, center, scale)``."""
        rows = [(c, float(a), float(b)) for c, (a, b) in self._fitted().items()]
        return spark.createDataFrame(rows, SCALER_SCHEMA)

    @classmethod
    def from_table(cls, df: DataFrame, scaler_type: str = "robust") -> FlowScaler:
        scaler = cls(scaler_type)
        scaler.stats = {r["feature"]: (r["center"], r["scale"]) for r in df.collect()}
        return scaler
