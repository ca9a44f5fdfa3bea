"""Results of several tables that appear together or not at all.

A version is a folder of its own below the root. Once all its parts are written, one row
in the manifest names it; the commit of that one-row write is the switch. Readers follow
the manifest, so they see all parts of one version, and a run that dies before the switch
leaves the version before it in place.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowsift.storage import remove

_SCHEMA = "number bigint, version string, parts array<string>"
# Versions that stay: the current one, and one that readers may still be at.
KEPT = 2


def _manifest(spark: SparkSession, root: str) -> list:
    """Rows of the manifest, latest first; none where nothing was published."""
    try:
        rows = spark.read.schema(_SCHEMA).json(f"{root}/_manifest")
        return rows.orderBy(F.col("number").desc(), "version").collect()
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return []
        raise


def publish(spark: SparkSession, root: str, parts: dict[str, Callable[[str], object]]) -> str:
    """Call the writer of each part with its path, then make them current; returns the version.

    Of two runs at the same time the one that switches last is current, whole.
    """
    version = f"v-{uuid.uuid4().hex}"
    for name, write in parts.items():
        write(f"{root}/{version}/{name}")
    earlier = _manifest(spark, root)
    number = earlier[0]["number"] + 1 if earlier else 0
    row = spark.createDataFrame([(number, version, list(parts))], _SCHEMA)
    row.coalesce(1).write.mode("append").json(f"{root}/_manifest")
    remove(spark, [f"{root}/{old['version']}" for old in earlier[KEPT - 1 :]])
    return version


def current(spark: SparkSession, root: str) -> dict[str, str]:
    """Path of each part of the current version; ``FileNotFoundError`` where there is none."""
    rows = _manifest(spark, root)
    if not rows:
        raise FileNotFoundError(f"nothing is published at {root}")
    return {name: f"{root}/{rows[0]['version']}/{name}" for name in rows[0]["parts"]}


def parquet(df: DataFrame) -> Callable[[str], None]:
    """Writer of a part as Parquet."""
    return lambda path: df.write.parquet(path)
