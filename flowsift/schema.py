"""Flow schema, feature names, settings and the threat dimension."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# They must be equal to the expected names, texts and numbers.
# ---------------------------------------------------------------------------

FLOW_COLUMNS = [
    "flow_id",
    "timestamp",
    "src_ip",
    "dst_ip",
    "src_port",
    "dst_port",
    "protocol",
    "flow_duration",
    "packet_count",
    "byte_count",
    "tcp_flags",
    "tos",
    "label",
    "is_anomaly",
]

NUMERIC_FEATURES = [
    "bytes_per_packet",
    "packets_per_second",
    "bytes_per_second",
    "log_bytes",
    "log_packets",
    "log_duration",
    "log_bps",
    "log_pps",
]

FLAG_FEATURES = [
    "flag_SYN",
    "flag_ACK",
    "flag_FIN",
    "flag_RST",
    "flag_PSH",
    "flag_URG",
    "is_syn_only",
    "src_port_well_known",
    "src_port_registered",
    "src_port_ephemeral",
    "dst_port_well_known",
    "dst_port_registered",
    "dst_port_ephemeral",
    "proto_TCP",
    "proto_UDP",
    "proto_ICMP",
]

FEATURES = NUMERIC_FEATURES + FLAG_FEATURES

BENIGN = "benign"

# (label, technique_id, technique_name, tactic, severity, playbook)
THREATS = [
    (
        "dns_exfiltration",
        "T1071.004",
        "Application Layer Protocol: DNS",
        "Exfiltration",
        "CRITICAL",
        "PB-EXFIL-002: Isolate host endpoint, inspect DNS query payload length, sinkhole external resolver.",
    ),
    (
        "c2_beacon",
        "T1071.001",
        "Application Layer Protocol: Web Protocols",
        "Command and Control",
        "HIGH",
        "PB-C2-004: Quarantine external IP at border firewall, pull process tree from source host, analyze EDR telemetry.",
    ),
    (
        "port_scan",
        "T1046",
        "Network Service Discovery",
        "Discovery",
        "MEDIUM",
        "PB-RECON-001: Rate-limit or block source IP, verify external perimeter exposure on scanned ports.",
    ),
    (
        "syn_flood",
        "T1498.001",
        "Network Denial of Service: Direct Network Flood",
        "Impact",
        "CRITICAL",
        "PB-DDOS-001: Enable SYN cookies on perimeter routers, trigger upstream scrubbing center mitigation.",
    ),
    (
        "ssh_brute_force",
        "T1110.001",
        "Brute Force: Password Guessing",
        "Credential Access",
        "HIGH",
        "PB-AUTH-003: Temporarily lock compromised accounts, enforce MFA / public-key auth, block source IP.",
    ),
]

# What an alert says when no archetype fits.
UNKNOWN_THREAT = (
    "T1046",
    "Network Anomaly / Behavioral Outlier",
    "Initial Access / Command and Control",
    "HIGH",
    "PB-ANOM-001: Inspect source endpoint network socket history; query proxy logs for destination IP reputation.",
)

# Default time of a raw record whose layout has no time column.
DEFAULT_TIMESTAMP = "2026-09-20T08:00:00"

DAILY_FLOWS = 1_000_000
TOP_K = 4
TREES = 150
SEED = 42
CONTAMINATION = 0.05
TARGET_FPR = 0.03
TRADEOFF_STEPS = 50
THRESHOLD_PRESETS = {"balanced": 0.55, "high_recall": 0.45}
THRESHOLD_RANGE = (0.20, 0.95)

# ---------------------------------------------------------------------------

THREAT_COLUMNS = [
    "label",
    "technique_id",
    "technique_name",
    "tactic",
    "base_severity",
    "playbook",
]

FLOW_SCHEMA = T.StructType(
    [
        T.StructField("flow_id", T.StringType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("src_ip", T.StringType()),
        T.StructField("dst_ip", T.StringType()),
        T.StructField("src_port", T.IntegerType()),
        T.StructField("dst_port", T.IntegerType()),
        T.StructField("protocol", T.StringType()),
        T.StructField("flow_duration", T.DoubleType()),
        T.StructField("packet_count", T.LongType()),
        T.StructField("byte_count", T.LongType()),
        T.StructField("tcp_flags", T.StringType()),
        T.StructField("tos", T.IntegerType()),
        T.StructField("label", T.StringType()),
        T.StructField("is_anomaly", T.IntegerType()),
    ]
)

# Before cleaning, numbers may carry fractions (443.7) or be missing.
_UNCLEAN = {"src_port", "dst_port", "flow_duration", "packet_count", "byte_count"}
RAW_FLOW_SCHEMA = T.StructType(
    [
        T.StructField(f.name, T.DoubleType() if f.name in _UNCLEAN else f.dataType)
        for f in FLOW_SCHEMA.fields
    ]
)


@dataclass(frozen=True)
class ForestConfig:
    """Settings of the isolation forest.

    ``contamination`` is accepted for compatibility; scores and thresholds do
    not depend on it.
    """

    n_trees: int = TREES
    sample_size: int = 256
    seed: int = SEED
    contamination: float = CONTAMINATION


def threat_dimension(spark: SparkSession) -> DataFrame:
    """The five archetypes as a table (five rows, so always safe to broadcast)."""
    return spark.createDataFrame(THREATS, " string, ".join(THREAT_COLUMNS) + " string")
