import pytest

from flowsift.operators.validate import FlowValidationError, rejection_counts, validate_and_clean, validate_schema


def test_missing_columns_are_named(make_flows):
    with pytest.raises(FlowValidationError, match="tos"):
        validate_schema(make_flows({}).drop("tos"))


def test_cleaning_keeps_and_drops_the_right_rows(make_flows):
    nan = float("nan")
    rows = make_flows(
        {},
        {"src_port": -99.0},
        {"dst_port": 65535.5},
        {"dst_port": 65535.0},
        {"dst_port": 443.7},
        {"packet_count": 0.0},
        {"packet_count": nan},
        {"flow_duration": -1.0},
        {"flow_duration": nan},
        {"flow_duration": None},
        {"byte_count": None},
        {"src_ip": None},
        {"tcp_flags": None, "protocol": "udp"},
        {"protocol": None},
    )
    clean = {r["flow_id"]: r for r in validate_and_clean(rows).collect()}
    assert set(clean) == {"F-0", "F-3", "F-4", "F-12", "F-13"}
    assert clean["F-4"]["dst_port"] == 443
    assert (clean["F-12"]["tcp_flags"], clean["F-12"]["protocol"]) == ("NONE", "UDP")
    assert clean["F-13"]["protocol"] is None
    counts = {r["reason"]: r["n_rows"] for r in rejection_counts(rows).collect()}
    assert counts["accepted"] == 5 and sum(counts.values()) == 14
    assert counts["bad_duration"] == 3 and counts["no_packets"] == 2


def test_copies_and_extra_columns_stay(make_flows):
    rows = make_flows({"flow_id": "A"}, {"flow_id": "A"}).selectExpr("*", "1 AS extra")
    clean = validate_and_clean(rows)
    assert clean.count() == 2 and "extra" in clean.columns


def test_strict_ip_is_optional(make_flows):
    rows = make_flows({"src_ip": "10.0.0.256"}, {"src_ip": "10.0.0.255"}, {"src_ip": "host"})
    assert validate_and_clean(rows).count() == 3
    assert validate_and_clean(rows, strict_ip=True).count() == 1
