import datetime as dt

import pytest
from pyspark.sql import functions as F

from flowsift.operators.explain import explain_flows, top_drivers, waterfall
from flowsift.operators.triage import create_alerts, generate_alerts_batch, severity, with_threat_context
from flowsift.operators.validate import validate_and_clean
from flowsift.functions.narrative import short_number
from flowsift.schema import FEATURES
from flowsift.sources.tables import export_alert, read_alerts, write_json
from flowsift.storage import materialize, new_path

DRIVER = "array<struct<feature: string, shap_contribution: double, scaled_value: double, raw_value: double>>"


def explained(spark, flows, score=0.89, is_alert=1):
    drivers = F.array(
        F.struct(
            F.lit("bytes_per_packet").alias("feature"),
            F.lit(1.25).alias("shap_contribution"),
            F.lit(3.5).alias("scaled_value"),
            F.lit(None).cast("double").alias("raw_value"),
        )
    ).cast(DRIVER)
    return validate_and_clean(flows).withColumns(
        {
            "anomaly_score": F.lit(score),
            "is_alert": F.lit(is_alert),
            "top_drivers": drivers,
            "narrative": F.lit("text"),
        }
    )


DNS = dict(
    src_ip="10.100.1.15", src_port=51234.0, dst_ip="185.220.101.5", dst_port=53.0, protocol="UDP", flow_duration=4.5,
    packet_count=120.0, byte_count=85000.0, tcp_flags="NONE", label="dns_exfiltration",
)


def test_dns_alert(spark, make_flows):
    alert = create_alerts(explained(spark, make_flows(DNS)), dt.date(2026, 9, 20)).first().asDict(True)
    assert alert["severity"] == "CRITICAL"
    assert alert["fusion_threat_intel"]["mitre_technique_id"] == "T1071.004"
    assert "PB-EXFIL-002" in alert["soar_remediation"]["recommended_playbook"]
    assert "10.100.1.15" in alert["soar_remediation"]["suggested_containment"]
    assert alert["network_traffic"]["dest_port"] == 53 and alert["network_traffic"]["transport"] == "udp"
    assert alert["alert_id"].startswith("ALT-20260920-")


def test_json_round_trip_and_export(spark, make_flows):
    alerts = create_alerts(explained(spark, make_flows(DNS, {})), dt.date(2026, 9, 20))
    path = write_json(alerts, new_path(spark, "alerts"))
    back = read_alerts(spark, path, alerts.schema)
    assert sorted(map(str, back.collect())) == sorted(map(str, alerts.collect()))
    one = export_alert(back, "F-0").collect()
    assert len(one) == 1 and '"raw_value":null' in one[0]["alert_json"]


@pytest.mark.parametrize(
    "row, archetype",
    [
        (dict(dst_port=53.0, packet_count=10.0, byte_count=4001.0), "dns_exfiltration"),
        (dict(dst_port=53.0, packet_count=10.0, byte_count=4000.0), None),
        (dict(tcp_flags="SYN", packet_count=501.0), "syn_flood"),
        (dict(tcp_flags="SYN,ACK", packet_count=501.0), None),
        (dict(dst_port=22.0), "ssh_brute_force"),
        (dict(tcp_flags="SYN", flow_duration=0.009), "port_scan"),
        (dict(tcp_flags="SYN", flow_duration=0.01), None),
        (dict(dst_port=9001.0), "c2_beacon"),
        (dict(label="port_scan", dst_port=22.0), "port_scan"),
        (dict(label=None, dst_port=22.0), "ssh_brute_force"),
    ],
)
def test_context_rules(make_flows, row, archetype):
    got = with_threat_context(validate_and_clean(make_flows(row))).first()
    assert got["archetype"] == archetype
    if archetype is None:
        assert got["technique_id"] == "T1046" and got["base_severity"] == "HIGH" and "PB-ANOM-001" in got["playbook"]


def test_labels_can_be_ignored(make_flows):
    flows = validate_and_clean(make_flows(dict(label="port_scan", dst_port=22.0)))
    assert with_threat_context(flows, use_label=False).first()["archetype"] == "ssh_brute_force"


def test_severity_levels(spark):
    cases = [
        (0.85, "CRITICAL", "CRITICAL"), (0.85, "HIGH", "CRITICAL"), (0.85, "MEDIUM", "HIGH"), (0.8499, "CRITICAL", "HIGH"),
        (0.65, "HIGH", "HIGH"), (0.65, "MEDIUM", "MEDIUM"), (0.6499, "CRITICAL", "MEDIUM"),
    ]
    df = spark.createDataFrame(cases, "s double, base string, want string")
    assert df.where(severity(F.col("s"), F.col("base")) != F.col("want")).isEmpty()


def test_batch_pairs_by_key(spark, make_flows):
    flows = make_flows(DNS, {}, {})
    full = explained(spark, flows).withColumn("is_alert", (F.col("flow_id") != "F-1").cast("int"))
    explanations = full.select("flow_id", "anomaly_score", "is_alert", "top_drivers", "narrative")
    clean = validate_and_clean(flows)
    assert {r["flow_id"] for r in generate_alerts_batch(clean, explanations).collect()} == {"F-0", "F-2"}
    assert generate_alerts_batch(clean, explanations, filter_anomalies_only=False).count() == 3


def test_a_thousand_equal_ids_give_a_thousand_alerts(spark, make_flows):
    flows = validate_and_clean(make_flows(*[{"flow_id": "SAME"}] * 1000, {"flow_id": "F-1"}, {"flow_id": None}))
    full = explained(spark, flows).select("flow_id", "anomaly_score", "is_alert", "top_drivers", "narrative")
    stored = materialize(flows, "same-flows"), materialize(full, "same-explanations")
    for a, b in (stored, (flows, full)):
        alerts = generate_alerts_batch(a, b)
        assert alerts.count() == 1002 and alerts.where("flow_id = 'SAME'").count() == 1000
    half = materialize(full.withColumn("is_alert", (F.monotonically_increasing_id() % 2).cast("int")), "half")
    assert generate_alerts_batch(stored[0], half).count() == half.where("is_alert = 1").count()


def attributed(spark, make_flows, phi, **scaled):
    values = {c: F.lit(float(scaled.get(c, 0.0))) for c in FEATURES}
    flows = validate_and_clean(make_flows(dict(packet_count=3.0, byte_count=2520.0)))
    full = [float(phi.get(c, 0.0)) for c in FEATURES]
    return flows.withColumns({"anomaly_score": F.lit(0.61234), "phi": F.array(*map(F.lit, full)), **values})


def test_drivers_and_narrative(spark, make_flows):
    df = attributed(
        spark, make_flows, {"bytes_per_packet": 1.5, "log_duration": 0.25, "is_syn_only": 0.0001, "log_bps": -2.0, "dst_port_registered": 0.12345},
        log_duration=-0.5, is_syn_only=1.0,
    )
    row = explain_flows(df, 0.6).first()
    assert [d["feature"] for d in row["top_drivers"]] == ["bytes_per_packet", "log_duration", "dst_port_registered", "is_syn_only"]
    assert (row["anomaly_score"], row["is_alert"]) == (0.6123, 1)
    assert row["narrative"] == (
        "Flow flagged as ANOMALOUS (calibrated anomaly score: 0.612, threshold: 0.600). Primary operational drivers: "
        "Payload density `bytes_per_packet` (840.0 B/pkt, SHAP: +1.5) significantly exceeds baseline; "
        "Flow duration was anomalously brief for the requested port (SHAP: +0.25); "
        "Destination port profile `dst_port_registered` deviates from baseline enterprise behavior (SHAP: +0.1235); "
        "TCP flag profile is strictly `SYN-only` without handshake completion (SHAP: +0.0001), typical of scans or SYN floods."
    )
    assert explain_flows(df, 0.6, k=2).select(F.size("top_drivers")).first()[0] == 2
    assert "scaled=0.0, SHAP" in explain_flows(df, 0.6, with_raw_flow=False).first()["narrative"]


def test_no_positive_driver_falls_back_to_the_largest(spark, make_flows):
    df = attributed(spark, make_flows, {c: -1.0 - i for i, c in enumerate(FEATURES)})
    row = explain_flows(df, 0.9).first()
    assert [d["feature"] for d in row["top_drivers"]] == FEATURES[:4]
    assert row["is_alert"] == 0 and "BENIGN" in row["narrative"] and "SHAP: +-1.0" in row["narrative"]


def test_raw_values_are_optional(spark, make_flows):
    df = attributed(spark, make_flows, {"log_pps": 1.0})
    assert explain_flows(df, 0.5).first()["top_drivers"][0]["raw_value"] is None
    got = explain_flows(df, 0.5, raw_features=[F.lit(float(i)) for i in range(24)]).first()
    assert got["top_drivers"][0]["raw_value"] == 7.0


def test_waterfall_adds_up(spark, make_flows):
    phi = {c: (-1) ** i * (i + 1) / 10 for i, c in enumerate(FEATURES)}
    rows = waterfall(attributed(spark, make_flows, phi), -5.0).orderBy("position").collect()
    assert len(rows) == 8 and rows[0]["feature"] == FEATURES[-1] and rows[7]["feature"] == "17 other features"
    assert rows[7]["running_total"] == pytest.approx(-5.0 + sum(phi.values()))


def test_short_numbers(spark):
    df = spark.createDataFrame([(0.5, "0.5"), (1.0, "1.0"), (0.0001, "0.0001"), (12.3456, "12.3456"), (10.0, "10.0")], "v double, want string")
    assert df.where(short_number(F.col("v")) != F.col("want")).isEmpty()


def test_top_drivers_break_ties_by_feature_order(spark):
    df = spark.range(1).select(F.array(*[F.lit(1.0)] * 24).alias("phi"), F.array(*[F.lit(0.0)] * 24).alias("x"))
    drivers = df.select(top_drivers(F.col("phi"), F.col("x"), 3)).first()[0]
    assert [d["feature"] for d in drivers] == FEATURES[:3]
