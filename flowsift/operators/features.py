"""Feature extraction as a projection."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowsift.functions.features import feature_columns
from flowsift.schema import FEATURES


def extract_features(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """The 24 unscaled features, after the columns named in ``keep``."""
    exprs = feature_columns()
    return df.select(*(keep or []), *[exprs[name].alias(name) for name in FEATURES])


def with_features(df: DataFrame) -> DataFrame:
    """All columns of ``df`` followed by the 24 unscaled features."""
    return df.withColumns(feature_columns())


def feature_vector() -> list:
    """The feature columns as doubles, in model order."""
    return [F.col(name).cast("double") for name in FEATURES]
