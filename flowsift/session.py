"""Session settings that the jobs of this package profit from."""

from __future__ import annotations

from pyspark.sql import SparkSession

# The JVM does not compile methods above 8000 bytes of bytecode, so a wide
# projection fused into one larger method would be interpreted. With this limit
# Spark splits it into small compiled functions instead.
SETTINGS = {"spark.sql.codegen.hugeMethodLimit": "8000"}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings; nothing that a cluster sets at start is touched."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark
