"""Where intermediate tables live, and their removal."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

_KEY = "spark.checkpoint.dir"


@lru_cache(1)
def _own_folder() -> str:
    """Folder of a local session without a shared one; it goes when the process ends."""
    folder = tempfile.mkdtemp(prefix="flowsift-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def shared_dir(spark: SparkSession) -> str:
    """The shared folder of the session.

    A cluster names it in ``spark.checkpoint.dir``. Only a local session without
    that setting gets a temporary folder of its own; the setting is left as it is.
    """
    folder = spark.conf.get(_KEY, None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {_KEY} to a folder that every executor can reach")
    return _own_folder()


def _session_dir(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/flowsift/{spark.sparkContext.applicationId}"


_RECORDS: list[list[str]] = []


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other run uses."""
    path = f"{_session_dir(spark)}/{name}-{uuid.uuid4().hex}"
    for record in _RECORDS:
        record.append(path)
    return path


@contextmanager
def recorded() -> Iterator[list[str]]:
    """The paths that are handed out inside the block, to be removed when their readers are done."""
    paths: list[str] = []
    _RECORDS.append(paths)
    try:
        yield paths
    finally:
        _RECORDS[:] = [r for r in _RECORDS if r is not paths]


def remove(spark: SparkSession, paths: list[str]) -> None:
    """Remove folders of the shared folder; what is gone already is no error."""
    for name in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def release(spark: SparkSession) -> None:
    """Remove the intermediate tables of this application, once their readers are done."""
    remove(spark, [_session_dir(spark)])


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet and go on from the written table.

    The lineage ends at the files, so a lost executor costs a re-read and not a
    re-computation, and every later reader sees the same rows.
    """
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
