"""Readers and writers of flow tables, metrics and alerts."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowsift.operators.validate import rejection_reason, validate_and_clean, validate_schema
from flowsift.schema import RAW_FLOW_SCHEMA

METRICS_SCHEMA = (
    "auroc double, pr_auc double, threshold double, precision double, recall double, f1_score double, "
    "false_positive_rate double, "
    "confusion_matrix struct<true_negatives: bigint, false_positives: bigint, "
    "false_negatives: bigint, true_positives: bigint>, "
    "operational_impact struct<assumed_daily_flows: bigint, projected_daily_alerts: bigint, "
    "projected_daily_false_alarms: bigint>, "
    "per_attack_recall map<string, struct<count: bigint, detected: bigint, recall: double>>"
)


def _existing(read, path: str) -> DataFrame:
    """Run ``read``; a missing path becomes ``FileNotFoundError``."""
    try:
        return read()
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"nothing to read at {path}") from e
        raise


def read_flows_csv(spark: SparkSession, path: str, strict_ip: bool = False) -> DataFrame:
    """Flow CSV with header, in any column order, validated and cleaned.

    Only the header is looked at to find the columns; the types are fixed, so
    no pass over the data is spent on inference. Files of one folder must agree in
    their column order: a header that differs fails the read. Whole numbers may be
    written with a fraction (``1.0``), as tools do once a column has a gap.
    """
    return validate_and_clean(_typed_csv(spark, path), strict_ip)


def _typed_csv(spark: SparkSession, path: str, line: str | None = None) -> DataFrame:
    """CSV rows with the types of raw flows; ``line`` names a column for lines that do not fit them."""
    text = _existing(lambda: spark.read.option("header", True).csv(path), path)
    known = {f.name: f.dataType for f in RAW_FLOW_SCHEMA.fields} | {c: T.DoubleType() for c in ("tos", "is_anomaly")}
    fields = [T.StructField(c, known.get(c, T.StringType())) for c in text.columns]
    reader = spark.read.option("header", True).option("enforceSchema", False)
    if line:
        fields.append(T.StructField(line, T.StringType()))
        # Every column is parsed, wanted or not, so that the same lines are rejected in every query.
        reader = reader.option("columnNameOfCorruptRecord", line).option("columnPruning", False)
    typed = reader.schema(T.StructType(fields)).csv(path)
    return typed.withColumns({c: F.col(c).cast("int") for c in ("tos", "is_anomaly") if c in typed.columns})


def read_flows_csv_checked(spark: SparkSession, path: str, strict_ip: bool = False) -> tuple[DataFrame, DataFrame]:
    """Clean flows, and what was rejected as ``file, reason, line``.

    A line with a text where a number belongs, in any typed column, or with more or fewer
    cells than the header is ``unreadable`` and kept as it stands; the plain reader takes
    such a cell as missing. Other reasons are those of ``rejection_reason``; their line is
    made from the cells. Each of the two tables is a narrow pass over the files.
    """
    line = "_line"
    rows = _typed_csv(spark, path, line)
    validate_schema(rows)
    cells = [c for c in rows.columns if c != line]
    reason = F.when(F.col(line).isNotNull(), "unreadable").otherwise(rejection_reason(strict_ip))
    rejected = rows.select(
        F.col("_metadata.file_path").alias("file"),
        reason.alias("reason"),
        F.coalesce(line, F.to_csv(F.struct(*[F.col(f"`{c}`") for c in cells]))).alias("line"),
    )
    flows = validate_and_clean(rows.where(F.col(line).isNull()).drop(line), strict_ip)
    return flows, rejected.where("reason <> 'accepted'")


def write_rejected(rejected: DataFrame, path: str, mode: str = "overwrite") -> str:
    """Rejected lines as Parquet, a folder per reason."""
    rejected.write.mode(mode).partitionBy("reason").parquet(path)
    return path


def read_flows_parquet(spark: SparkSession, path: str, strict_ip: bool = False) -> DataFrame:
    return validate_and_clean(_existing(lambda: spark.read.parquet(path), path), strict_ip)


def write_flows_csv(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """Flow table as a folder of CSV files with header; a run that is repeated replaces its result.

    An empty text and a missing value stay apart.
    """
    df.write.mode(mode).option("header", True).option("emptyValue", '""').csv(path)
    return path


def write_flows_parquet(df: DataFrame, path: str, partition_by_date: bool = False, mode: str = "overwrite") -> str:
    """Flow table as Parquet, by day of ``timestamp`` if wanted."""
    if partition_by_date:
        # Rebalancing gathers the rows of a day before writing and splits days that
        # are too large for one file, so neither tiny files nor one huge task arise.
        dated = df.withColumn("event_date", F.substring("timestamp", 1, 10)).hint("rebalance", "event_date")
        dated.write.mode(mode).partitionBy("event_date").parquet(path)
    else:
        df.write.mode(mode).parquet(path)
    return path


def read_raw_csv(spark: SparkSession, path: str) -> DataFrame:
    """Raw dataset CSV, every column as text (header matching and casts follow).

    A file whose header differs from the first one's fails the read, as its columns would be mixed up.
    """
    found = _existing(lambda: spark.read.option("header", True).csv(path), path)
    return spark.read.schema(found.schema).option("header", True).option("enforceSchema", False).csv(path)


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """Metrics or alerts as JSON Lines; nested fields and nulls are kept."""
    df.write.mode(mode).option("ignoreNullFields", False).json(path)
    return path


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    return _existing(lambda: spark.read.schema(METRICS_SCHEMA).json(path), path)


def read_alerts(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return _existing(lambda: spark.read.schema(schema).json(path), path)


def export_alert(alerts: DataFrame, flow_id: str) -> DataFrame:
    """One alert as a JSON text."""
    chosen = alerts.where(F.col("flow_id") == flow_id)
    return chosen.select("flow_id", F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("alert_json"))
