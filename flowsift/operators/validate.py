"""Schema check, cleaning and rejection counts of flow tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowsift.schema import FLOW_COLUMNS

REQUIRED_VALUES = ["src_ip", "dst_ip", "src_port", "dst_port", "byte_count"]
MAX_PORT = 65535
_OCTET = r"(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"


class FlowValidationError(ValueError):
    """A flow table lacks required columns."""


def validate_schema(df: DataFrame) -> DataFrame:
    """Raise if a required column is missing; no job is started."""
    missing = [c for c in FLOW_COLUMNS if c not in df.columns]
    if missing:
        raise FlowValidationError(f"Missing required flow columns: {missing}")
    return df


def drop_incomplete(df: DataFrame) -> DataFrame:
    """Drop rows without addresses, ports or byte count."""
    return df.dropna(subset=REQUIRED_VALUES)


def _is_number(name: str) -> Column:
    # In Spark NaN is larger than any number, so `NaN >= 0` would pass.
    return F.col(name).isNotNull() & ~F.isnan(F.col(name).cast("double"))


def in_range() -> Column:
    """Ports in 0..65535, bytes >= 0, packets >= 1, duration >= 0; null and NaN fail."""
    bounds = (
        F.col("src_port").between(0, MAX_PORT)
        & F.col("dst_port").between(0, MAX_PORT)
        & (F.col("byte_count") >= 0)
        & (F.col("packet_count") >= 1)
        & (F.col("flow_duration") >= 0)
    )
    return bounds & _is_number("packet_count") & _is_number("flow_duration") & _is_number("byte_count")


def valid_ipv4(name: str) -> Column:
    """Four decimal octets of at most 255."""
    return F.coalesce(F.col(name).rlike(rf"^{_OCTET}(\.{_OCTET}){{3}}$"), F.lit(False))


def keep_in_range(df: DataFrame) -> DataFrame:
    return df.where(in_range())


def cast_types(df: DataFrame) -> DataFrame:
    """Standard types; numbers are cut, protocol is upper-cased, null flags become ``NONE``."""
    return df.withColumns(
        {
            "src_port": F.col("src_port").cast("int"),
            "dst_port": F.col("dst_port").cast("int"),
            "packet_count": F.col("packet_count").cast("bigint"),
            "byte_count": F.col("byte_count").cast("bigint"),
            "flow_duration": F.col("flow_duration").cast("double"),
            "protocol": F.upper("protocol"),
            "tcp_flags": F.coalesce(F.col("tcp_flags"), F.lit("NONE")),
        }
    )


def validate_and_clean(df: DataFrame, strict_ip: bool = False) -> DataFrame:
    """Schema check, incomplete rows, ranges, casts: one narrow stage.

    The range test sees the value before it is cut: port 65535.5 is dropped,
    443.7 becomes 443. Copies and further columns are kept.
    """
    validate_schema(df)
    kept = df.transform(drop_incomplete).transform(keep_in_range)
    if strict_ip:
        kept = kept.where(valid_ipv4("src_ip") & valid_ipv4("dst_ip"))
    return cast_types(kept)


def rejection_reason(strict_ip: bool = False) -> Column:
    """First reason for which cleaning drops a row, ``accepted`` for a kept row."""

    def missing(name: str) -> Column:
        return F.col(name).isNull() | F.isnan(F.col(name).cast("double"))

    reason = (
        F.when(F.col("src_ip").isNull() | F.col("dst_ip").isNull(), "missing_ip")
        .when(missing("src_port") | missing("dst_port"), "missing_port")
        .when(missing("byte_count"), "missing_bytes")
        .when(~F.col("src_port").between(0, MAX_PORT) | ~F.col("dst_port").between(0, MAX_PORT), "port_out_of_range")
        .when(F.col("byte_count") < 0, "negative_bytes")
        .when(missing("packet_count") | (F.col("packet_count") < 1), "no_packets")
        .when(missing("flow_duration") | (F.col("flow_duration") < 0), "bad_duration")
    )
    if strict_ip:
        reason = reason.when(~valid_ipv4("src_ip") | ~valid_ipv4("dst_ip"), "bad_ip")
    return reason.otherwise("accepted")


def rejection_counts(df: DataFrame, strict_ip: bool = False) -> DataFrame:
    """Rows per rejection reason."""
    return df.groupBy(rejection_reason(strict_ip).alias("reason")).agg(F.count(F.lit(1)).alias("n_rows"))
