"""The 24 behavioural features as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from flowsift.schema import FEATURES

MIN_DURATION = 0.0001

PORT_BANDS = {"well_known": (0, 1023), "registered": (1024, 49151), "ephemeral": (49152, 65535)}
FLAG_NAMES = ["SYN", "ACK", "FIN", "RST", "PSH", "URG"]
PROTOCOLS = ["TCP", "UDP", "ICMP"]


def _at_least(name: str, floor: float) -> Column:
    """``max(column, floor)`` that stays null when the column is null."""
    value = F.col(name).cast("double")
    return F.when(value < floor, F.lit(floor)).otherwise(value)


def _bit(condition: Column) -> Column:
    return F.coalesce(condition.cast("int"), F.lit(0))


def feature_columns() -> dict[str, Column]:
    """Feature name -> expression over the flow columns, in model order."""
    packets = _at_least("packet_count", 1.0)
    size = _at_least("byte_count", 0.0)
    seconds = _at_least("flow_duration", MIN_DURATION)
    exprs = {
        "bytes_per_packet": size / packets,
        "packets_per_second": packets / seconds,
        "bytes_per_second": size / seconds,
        "log_bytes": F.log1p(size),
        "log_packets": F.log1p(packets),
        "log_duration": F.log1p(seconds),
        "log_bps": F.log1p(size / seconds),
        "log_pps": F.log1p(packets / seconds),
    }
    flags = F.upper(F.coalesce(F.col("tcp_flags"), F.lit("NONE")))
    has = {name: flags.contains(name) for name in FLAG_NAMES}
    for name in FLAG_NAMES:
        exprs[f"flag_{name}"] = has[name].cast("int")
    exprs["is_syn_only"] = (has["SYN"] & ~has["ACK"] & ~has["FIN"]).cast("int")
    for side in ("src_port", "dst_port"):
        for band, (low, high) in PORT_BANDS.items():
            exprs[f"{side}_{band}"] = _bit(F.col(side).between(low, high))
    for name in PROTOCOLS:
        exprs[f"proto_{name}"] = _bit(F.upper("protocol") == name)
    return {name: exprs[name] for name in FEATURES}
