"""Normalisation of two public dataset layouts into the flow schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowsift.functions.parsing import (
    CIC_FLAGS,
    flags_from_counts,
    lookup,
    parse_byte_size,
    parse_letter_flags,
    protocol_name,
    strip,
    to_number,
    to_whole,
)
from flowsift.operators.rowkeys import with_flow_id, with_position_id
from flowsift.schema import BENIGN, DEFAULT_TIMESTAMP, FLOW_COLUMNS

# Label maps of the two layouts and constants for absent columns.
CIDDS_LABELS = {
    "---": "benign",
    "portscan": "port_scan",
    "dos": "syn_flood",
    "pingScan": "port_scan",
    "bruteForce": "ssh_brute_force",
    "unknown": "benign",
}
CIC_LABELS = {
    "benign": "benign",
    "portscan": "port_scan",
    "ddos": "syn_flood",
    "dos hulk": "syn_flood",
    "dos goldeneye": "syn_flood",
    "dos slowloris": "syn_flood",
    "dos slowhttptest": "syn_flood",
    "ssh-patator": "ssh_brute_force",
    "ftp-patator": "ssh_brute_force",
    "bot": "c2_beacon",
    "infiltration": "c2_beacon",
}
CIC_DEFAULTS = {"src_ip": "10.100.1.10", "src_port": 49152, "dst_ip": "10.200.1.53", "dst_port": 443}

# Accepted headers per field (lower case, trimmed), best first.
CIDDS_HEADERS = {
    "timestamp": ["date first seen", "date"],
    "flow_duration": ["duration"],
    "protocol": ["proto"],
    "src_ip": ["src ip addr", "src_ip"],
    "src_port": ["src pt", "src_port"],
    "dst_ip": ["dst ip addr", "dst_ip"],
    "dst_port": ["dst pt", "dst_port"],
    "packet_count": ["packets"],
    "byte_count": ["bytes"],
    "tcp_flags": ["flags"],
    "tos": ["tos"],
    "label": ["attacktype", "class"],
}
CIDDS_REQUIRED = [
    "flow_duration",
    "protocol",
    "src_ip",
    "src_port",
    "dst_ip",
    "dst_port",
    "packet_count",
    "byte_count",
]
CIC_HEADERS = {
    "timestamp": ["timestamp"],
    "flow_duration": ["flow duration"],
    "src_ip": ["source ip"],
    "src_port": ["source port"],
    "dst_ip": ["destination ip"],
    "dst_port": ["destination port"],
    "protocol": ["protocol"],
    "fwd_packets": ["total fwd packets"],
    "bwd_packets": ["total backward packets"],
    "fwd_bytes": ["total length of fwd packets"],
    "bwd_bytes": ["total length of bwd packets"],
    "label": ["label"],
} | {name: [f"{name.lower()} flag count"] for name in CIC_FLAGS}


class LayoutError(KeyError):
    """A raw table lacks a column that its layout requires."""


def match_headers(columns: list[str], headers: dict[str, list[str]]) -> dict[str, int]:
    """Field -> column position; of equal headers the last one wins."""
    where = {c.strip().lower(): i for i, c in enumerate(columns)}
    found = {}
    for field, names in headers.items():
        for name in names:
            if name in where:
                found[field] = where[name]
                break
    return found


def normalise_headers(df: DataFrame, headers: dict[str, list[str]]) -> DataFrame:
    """Only the matched columns, under their field names.

    Columns are renamed by position first: headers that differ in case or blanks
    only would be ambiguous by name.
    """
    found = match_headers(df.columns, headers)
    by_position = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    return by_position.select(*[F.col(f"c{i}").alias(field) for field, i in found.items()])


def cidds_label(raw: Column, labels: dict[str, str] = CIDDS_LABELS) -> Column:
    """Archetype of an attack type: lower-cased key, exact key, else benign."""
    key = strip(raw)
    return F.coalesce(lookup(labels, F.lower(key)), lookup(labels, key), F.lit(BENIGN))


def cic_label(raw: Column, labels: dict[str, str] = CIC_LABELS) -> Column:
    """Archetype of a CIC label, by map, then by the words ``port`` and ``dos``."""
    key = F.lower(strip(raw))
    by_word = F.when(key.contains("port"), F.lit("port_scan")).when(key.contains("dos"), F.lit("syn_flood"))
    return F.coalesce(lookup(labels, key), by_word, F.lit(BENIGN))


def _anomaly_bit(label: str = "label") -> Column:
    return (F.col(label) != BENIGN).cast("int")


def _ordered(df: DataFrame) -> DataFrame:
    return df.select(*[c for c in FLOW_COLUMNS if c in df.columns])


def project_cidds(df: DataFrame, labels: dict[str, str] = CIDDS_LABELS) -> DataFrame:
    """CIDDS-001 rows in the flow schema, without ``flow_id``: one narrow stage."""
    raw = normalise_headers(df, CIDDS_HEADERS)
    missing = [c for c in CIDDS_REQUIRED if c not in raw.columns]
    if missing:
        raise LayoutError(f"CIDDS-001 layout needs columns for {missing}")
    has = set(raw.columns)
    if dict(raw.dtypes).get("tcp_flags", "string") != "string":
        has.discard("tcp_flags")  # only text carries flags
    cols = {
        "timestamp": F.col("timestamp").cast("string") if "timestamp" in has else F.lit(DEFAULT_TIMESTAMP),
        "flow_duration": F.coalesce(to_number(F.col("flow_duration")), F.lit(0.0)),
        "protocol": F.upper("protocol"),
        "src_ip": F.col("src_ip").cast("string"),
        "src_port": to_whole(F.col("src_port"), 0),
        "dst_ip": F.col("dst_ip").cast("string"),
        "dst_port": to_whole(F.col("dst_port"), 0),
        "packet_count": to_whole(F.col("packet_count"), 1),
        "byte_count": parse_byte_size(F.col("byte_count")),
        "tcp_flags": parse_letter_flags(F.col("tcp_flags")) if "tcp_flags" in has else F.lit("NONE"),
        "tos": F.coalesce(to_whole(F.col("tos"), 0).try_cast("int"), F.lit(0)) if "tos" in has else F.lit(0),
        "label": cidds_label(F.col("label").cast("string"), labels) if "label" in has else F.lit(BENIGN),
    }
    return _ordered(raw.select(*[v.alias(k) for k, v in cols.items()]).withColumn("is_anomaly", _anomaly_bit()))


def project_cic(df: DataFrame, labels: dict[str, str] = CIC_LABELS) -> DataFrame:
    """CIC-IDS2017 rows in the flow schema, without ``flow_id``: one narrow stage."""
    raw = normalise_headers(df, CIC_HEADERS)
    has = set(raw.columns)

    def total(*names: str) -> Column:
        parts = [F.coalesce(to_number(F.col(c)), F.lit(0.0)) if c in has else F.lit(0.0) for c in names]
        return (parts[0] + parts[1]).try_cast("bigint")

    def or_default(name: str, value: Column) -> Column:
        return value if name in has else F.lit(CIC_DEFAULTS[name])

    cols = {
        "timestamp": F.col("timestamp").cast("string") if "timestamp" in has else F.lit(DEFAULT_TIMESTAMP),
        "flow_duration": F.coalesce(to_number(F.col("flow_duration")), F.lit(0.0)) / F.lit(1_000_000.0)
        if "flow_duration" in has
        else F.lit(0.0),
        "src_ip": or_default("src_ip", F.col("src_ip").cast("string")),
        "src_port": or_default("src_port", to_whole(F.col("src_port"), 0)).cast("bigint"),
        "dst_ip": or_default("dst_ip", F.col("dst_ip").cast("string")),
        "dst_port": or_default("dst_port", to_whole(F.col("dst_port"), 0)).cast("bigint"),
        "protocol": protocol_name(to_whole(F.col("protocol"), 6)) if "protocol" in has else F.lit("TCP"),
        "packet_count": F.greatest(total("fwd_packets", "bwd_packets"), F.lit(1).cast("bigint")),
        "byte_count": F.greatest(total("fwd_bytes", "bwd_bytes"), F.lit(0).cast("bigint")),
        "tcp_flags": flags_from_counts({x: F.col(x) for x in CIC_FLAGS if x in has})
        if has.intersection(CIC_FLAGS)
        else F.lit("NONE"),
        "tos": F.lit(0),
        "label": cic_label(F.col("label").cast("string"), labels) if "label" in has else F.lit(BENIGN),
    }
    return _ordered(raw.select(*[v.alias(k) for k, v in cols.items()]).withColumn("is_anomaly", _anomaly_bit()))


def _identified(rows: DataFrame, prefix: str, ids: str) -> DataFrame:
    if ids not in ("content", "position"):
        raise ValueError(f"ids must be 'content' or 'position', not {ids}")
    add = with_flow_id if ids == "content" else with_position_id
    return add(rows, prefix).select(*FLOW_COLUMNS)


def convert_cidds(df: DataFrame, labels: dict[str, str] = CIDDS_LABELS, ids: str = "content") -> DataFrame:
    """CIDDS-001 layout -> flow schema.

    ``ids="content"``: ids that any later run repeats, at the price of a shuffle
    that numbers copies. ``ids="position"``: unique ids in one narrow stage.
    """
    return _identified(project_cidds(df, labels), "CIDDS", ids)


def convert_cic(df: DataFrame, labels: dict[str, str] = CIC_LABELS, ids: str = "content") -> DataFrame:
    """CIC-IDS2017 layout -> flow schema; ``ids`` as for :func:`convert_cidds`."""
    return _identified(project_cic(df, labels), "CIC", ids)
