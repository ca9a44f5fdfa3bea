"""Threat context, severity and alert records."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowsift.operators.rowkeys import may_be_among, with_occurrence
from flowsift.schema import THREATS, UNKNOWN_THREAT, threat_dimension

VENDOR_PRODUCT = "flowsift"
BEACON_PORTS = [8443, 4444, 9001]


def known_label(label: Column) -> Column:
    """The label if it names an archetype, else null."""
    return F.when(label.isin(*[t[0] for t in THREATS]), label)


def infer_archetype() -> Column:
    """Archetype of an unlabelled flow by ordered rules, null if none fits."""
    flags = F.coalesce(F.col("tcp_flags"), F.lit(""))
    density = F.col("byte_count").cast("double") / F.greatest(F.col("packet_count").cast("double"), F.lit(1.0))
    return (
        F.when((F.col("dst_port") == 53) & (density > 400), "dns_exfiltration")
        .when((flags == "SYN") & (F.col("packet_count") > 500), "syn_flood")
        .when(F.col("dst_port") == 22, "ssh_brute_force")
        .when((flags == "SYN") & (F.col("flow_duration") < 0.01), "port_scan")
        .when(F.col("dst_port").isin(*BEACON_PORTS), "c2_beacon")
    )


def with_threat_context(flows: DataFrame, use_label: bool = True) -> DataFrame:
    """Join the threat dimension by known label, else by the inferred archetype.

    ``use_label=False`` ignores the label, as for live traffic without ground
    truth. The dimension has five rows, so the join is a broadcast join.
    """
    inferred = infer_archetype()
    archetype = F.coalesce(known_label(F.col("label")), inferred) if use_label else inferred
    dimension = threat_dimension(flows.sparkSession).withColumnRenamed("label", "archetype")
    joined = flows.withColumn("archetype", archetype).join(F.broadcast(dimension), "archetype", "left")
    fallback = dict(zip(["technique_id", "technique_name", "tactic", "base_severity", "playbook"], UNKNOWN_THREAT))
    return joined.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in fallback.items()})


def severity(score: Column, base: Column) -> Column:
    """Alert priority from the rounded score and the archetype's severity."""
    return (
        F.when(score >= 0.85, F.when(base.isin("CRITICAL", "HIGH"), "CRITICAL").otherwise("HIGH"))
        .when(score >= 0.65, F.when(base == "CRITICAL", "HIGH").otherwise(base))
        .otherwise("MEDIUM")
    )


def containment(src_ip: Column) -> Column:
    text = "Block source IP %s at perimeter firewall or isolate endpoint."
    return F.format_string(text, src_ip)


def alert_id(key: Column, run_date: dt.date) -> Column:
    """``ALT-yyyymmdd-`` + 16 hex digits of the flow's key: the same on every run."""
    return F.concat(F.lit(f"ALT-{run_date:%Y%m%d}-"), F.substring(F.sha2(key, 256), 1, 16))


def create_alerts(
    explained: DataFrame,
    run_date: dt.date | None = None,
    vendor_product: str = VENDOR_PRODUCT,
    use_label: bool = True,
    key: str = "flow_id",
) -> DataFrame:
    """One nested alert per explained flow.

    ``explained`` carries the flow columns next to ``anomaly_score``,
    ``top_drivers`` and ``narrative``.
    """
    day = run_date or dt.datetime.now(dt.timezone.utc).date()
    c = F.col
    rows = with_threat_context(explained, use_label)
    return rows.select(
        alert_id(c(key), day).alias("alert_id"),
        F.coalesce(c("timestamp"), F.lit(f"{day:%Y-%m-%d}T00:00:00")).alias("timestamp"),
        F.lit(vendor_product).alias("vendor_product"),
        F.coalesce(c("flow_id"), F.concat(F.lit("FLW-"), F.substring(F.sha2(c(key), 256), 1, 8))).alias("flow_id"),
        severity(c("anomaly_score"), c("base_severity")).alias("severity"),
        F.lit("flagged_for_triage").alias("action"),
        F.struct(
            c("src_ip").alias("src"),
            c("src_ip").alias("src_ip"),
            c("src_port").alias("src_port"),
            c("dst_ip").alias("dest"),
            c("dst_ip").alias("dest_ip"),
            c("dst_port").alias("dest_port"),
            F.lower("protocol").alias("transport"),
            c("flow_duration").alias("duration"),
            c("packet_count").alias("packets"),
            c("byte_count").alias("bytes"),
            c("tcp_flags").alias("tcp_flags"),
        ).alias("network_traffic"),
        F.struct(
            c("anomaly_score").alias("calibrated_anomaly_score"),
            c("top_drivers").alias("top_driving_features"),
            c("narrative").alias("soc_justification"),
        ).alias("anomaly_analysis"),
        F.struct(
            c("technique_id").alias("mitre_technique_id"),
            c("technique_name").alias("mitre_technique_name"),
            c("tactic").alias("mitre_tactic"),
        ).alias("fusion_threat_intel"),
        F.struct(
            c("playbook").alias("recommended_playbook"),
            containment(c("src_ip")).alias("suggested_containment"),
        ).alias("soar_remediation"),
    )


def generate_alerts_batch(
    flows: DataFrame,
    explanations: DataFrame,
    filter_anomalies_only: bool = True,
    key: str = "flow_id",
    **options,
) -> DataFrame:
    """Alerts for flows and explanations held in two tables, paired by ``key``.

    Where keys repeat, the first row of a key in ``flows`` meets the first one in
    ``explanations`` and so on, so n equal keys give n alerts; null keys pair with null keys.
    Rows whose key no alert has leave both tables in the scan, before keys are counted and
    rows are moved; all rows of a key stay or leave together, so their numbers do not change.
    """
    number = "__occurrence"
    flag = ["is_alert"] if filter_anomalies_only else []
    narrow = explanations.select(F.col(key).alias("__key"), *flag, "anomaly_score", "top_drivers", "narrative")
    if filter_anomalies_only:
        flagged = narrow.where(F.col("is_alert") == 1).select("__key")
        wanted = may_be_among(flagged, "__key", narrow.count())
        if wanted is not None:
            narrow, flows = narrow.where(wanted(F.col("__key"))), flows.where(wanted(F.col(key)))
    told = with_occurrence(narrow, "__key", "__told")
    if filter_anomalies_only:
        told = told.where(F.col("is_alert") == 1)
    same = F.col(key).eqNullSafe(F.col("__key")) & (F.col(number) == F.col("__told"))
    paired = with_occurrence(flows, key, number).join(told.drop(*flag), same)
    return create_alerts(paired.drop(number, "__key", "__told"), key=key, **options)
