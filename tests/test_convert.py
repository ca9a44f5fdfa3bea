import datetime as dt

import pytest
from pyspark.sql import functions as F

from flowsift.functions.parsing import parse_byte_size, parse_letter_flags, to_number
from flowsift.operators.convert import LayoutError, cic_label, cidds_label, convert_cic, convert_cidds, match_headers
from flowsift.operators.features import extract_features
from flowsift.operators.rowkeys import has_repeated_key, number_copies, with_flow_id, with_row_key
from flowsift.operators.triage import alert_id
from flowsift.operators.validate import validate_and_clean
from flowsift.schema import FLOW_COLUMNS
from flowsift.storage import materialize

CIDDS = {
    "Date first seen": "2026-09-20 08:12:30.000",
    "Duration": "0.5",
    "Proto": "tcp",
    "Src IP Addr": "10.100.1.12",
    "Src Pt": "51234",
    "Dst IP Addr": "10.200.1.15",
    "Dst Pt": "443.0",
    "Packets": "12",
    "Bytes": "8.5 K",
    "Flags": ".AP.SF",
    "Tos": "0",
    "class": "normal",
    "attackType": "---",
}
CIC = {
    " Timestamp": "2026-09-20 08:30:00",
    "Flow Duration": "50000",
    "Source IP": "172.16.0.1",
    "Source Port": "50123",
    "Destination IP": "192.168.1.5",
    "Destination Port": "80",
    "Protocol": "6",
    "Total Fwd Packets": "4",
    "Total Backward Packets": "2",
    "Total Length of Fwd Packets": "400",
    "Total Length of Bwd Packets": "600",
    "FIN Flag Count": "0",
    "SYN Flag Count": "1",
    "RST Flag Count": "0",
    "PSH Flag Count": "0",
    "ACK Flag Count": "2",
    "URG Flag Count": "0",
    " Label": "PortScan",
}


def table(spark, *rows):
    return spark.createDataFrame([tuple(r.values()) for r in rows], ", ".join(f"`{c}` string" for c in rows[0]))


def values(spark, texts, expr):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r["v"] for r in df.select("i", expr(F.col("t")).alias("v")).orderBy("i").collect()]


def test_flag_texts(spark):
    texts = ["....S.", ".A....", ".AP.SF", "", None, "  ", "0x5a", "s", "111111", "......", "....s."]
    assert values(spark, texts, parse_letter_flags) == [
        "SYN", "ACK", "ACK,PSH,SYN,FIN", "NONE", "NONE", "NONE", "ACK", "SYN", "URG,ACK,PSH,RST,SYN,FIN", "NONE", "NONE",
    ]


def test_byte_texts(spark):
    texts = ["1024", "1.2 M", "450 K", "54", None, "abc", "x K", " 2k ", "1.9", "1.0f", "1e3"]
    assert values(spark, texts, parse_byte_size) == [1024, 1200000, 450000, 54, 0, 0, 0, 2000, 1, 0, 1000]


def test_byte_texts_are_cut_like_binary_products(spark):
    texts = [f"{i / 1000} K" for i in range(0, 20000, 7)]
    want = [int(float(t[:-2]) * 1000) for t in texts]
    assert values(spark, texts, parse_byte_size) == want


def test_numbers(spark):
    assert values(spark, ["1.5", " 2 ", "-", "", None, "1d", ".5", "-3."], to_number) == [1.5, 2, None, None, None, None, 0.5, -3]


def test_labels(spark):
    raw = ["---", "portScan", "PORTSCAN", "pingScan", "PINGSCAN", "bruteForce", "bruteforce", " dos ", None]
    assert values(spark, raw, cidds_label) == [
        "benign", "port_scan", "port_scan", "port_scan", "benign", "ssh_brute_force", "benign", "syn_flood", "benign",
    ]
    assert values(spark, ["\tdos\r\n"], cidds_label) == ["syn_flood"]
    raw = ["BENIGN", " DoS Hulk ", "Bot", "my port thing", "new dos", "Heartbleed", None]
    assert values(spark, raw, cic_label) == [
        "benign", "syn_flood", "c2_beacon", "port_scan", "syn_flood", "benign", "benign",
    ]


def test_headers_last_duplicate_wins():
    assert match_headers(["Label", " label "], {"label": ["label"]}) == {"label": 1}
    assert match_headers(["Date", "DATE FIRST SEEN"], {"t": ["date first seen", "date"]}) == {"t": 1}


def test_cidds_row(spark):
    row = convert_cidds(table(spark, CIDDS)).first()
    assert row["byte_count"] == 8500 and row["is_anomaly"] == 0 and row["protocol"] == "TCP"
    assert row["dst_port"] == 443 and row["tcp_flags"] == "ACK,PSH,SYN,FIN"
    assert list(row.asDict()) == FLOW_COLUMNS


def test_cic_row(spark):
    row = convert_cic(table(spark, CIC)).first()
    assert (row["flow_duration"], row["packet_count"], row["byte_count"]) == (0.05, 6, 1000)
    assert (row["label"], row["is_anomaly"], row["protocol"]) == ("port_scan", 1, "TCP")
    assert row["tcp_flags"] == "SYN"  # a count of two does not set the flag


def test_numeric_columns(spark):
    typed = table(spark, CIDDS).withColumns(
        {"Flags": F.lit(111111), "Bytes": F.lit(12345678.9), "Packets": F.lit(3), "Duration": F.lit(0.25)}
    )
    row = convert_cidds(typed).first()
    assert (row["tcp_flags"], row["byte_count"], row["packet_count"], row["flow_duration"]) == ("NONE", 12345678, 3, 0.25)


def test_case_only_duplicates_do_not_clash(spark):
    raw = table(spark, CIC).withColumn("x", F.lit("BENIGN"))
    raw = raw.toDF(*[*list(CIC), "label"])
    assert convert_cic(raw).first()["label"] == "benign"


def test_missing_columns(spark):
    slim = table(spark, CIDDS).drop("Flags", "Tos", "class", "attackType", "Date first seen")
    row = convert_cidds(slim).first()
    assert (row["tcp_flags"], row["tos"], row["label"]) == ("NONE", 0, "benign")
    assert row["timestamp"] == "2026-09-20T08:00:00"
    with pytest.raises(LayoutError, match="byte_count"):
        convert_cidds(slim.drop("Bytes"))
    row = convert_cic(table(spark, CIC).select("Flow Duration")).first()
    assert (row["src_ip"], row["src_port"], row["dst_port"], row["packet_count"]) == ("10.100.1.10", 49152, 443, 1)


def test_converted_rows_have_finite_features(spark):
    rows = [CIDDS | {"Src Pt": str(50000 + i)} for i in range(30)]
    features = extract_features(validate_and_clean(convert_cidds(table(spark, *rows))))
    bad = features.select(*[F.count_if(F.col(c).isNull() | F.isnan(F.col(c).cast("double"))).alias(c) for c in features.columns])
    assert set(bad.first()) == {0}


def test_ids_are_unique_and_repeatable_with_hot_copies(spark):
    hot = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string"))
    df = spark.range(3000, numPartitions=5).select(hot.alias("v"), F.lit(None).cast("string").alias("w"))
    ids = [sorted(r["flow_id"] for r in with_flow_id(d, "X").collect()) for d in (df, df.repartition(2))]
    assert ids[0] == ids[1] and len(set(ids[0])) == 3000
    numbered = number_copies(df, per_task=100)
    assert numbered.count() == 3000
    hot_numbers = sorted(r["copy_no"] for r in numbered.where("v = 'hot'").collect())
    assert hot_numbers == list(range(1000))


def test_position_ids_need_no_shuffle(spark):
    raw = table(spark, *[CIDDS] * 50).repartition(4)
    stored = spark.createDataFrame(raw.collect(), raw.schema)
    converted = convert_cidds(stored, ids="position")
    assert len({r["flow_id"] for r in converted.collect()}) == 50
    assert "Exchange" not in converted._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(ValueError, match="content"):
        convert_cidds(stored, ids="random")


def test_row_key_only_changes_repeated_ids(make_flows):
    unique = make_flows({"flow_id": "A"}, {"flow_id": "B"})
    assert {r["row_key"] for r in with_row_key(unique).collect()} == {"A", "B"}
    repeated = make_flows({"flow_id": "A"}, {"flow_id": "A"}, {"flow_id": "A", "tos": 1}, {"flow_id": None})
    assert has_repeated_key(repeated, "flow_id")
    keys = [r["row_key"] for r in with_row_key(repeated).collect()]
    assert len(set(keys)) == 4


def test_one_repeated_flow_changes_no_other_key(spark, make_flows):
    flows = materialize(make_flows(*[{"tos": i} for i in range(200)]), "flows")
    before = {r["tos"]: r["row_key"] for r in with_row_key(flows).collect()}
    third = make_flows({"flow_id": "F-7", "tos": 7}, {"flow_id": None, "tos": 900}, *[{"flow_id": "HOT", "tos": 1000}] * 100)
    mixed = materialize(flows.unionByName(third), "mixed")
    for table_ in (mixed, mixed.where("tos >= 0"), mixed.unionByName(flows.limit(0))):
        rows = with_row_key(table_).collect()
        after = {r["tos"]: r["row_key"] for r in rows}
        assert len({r["row_key"] for r in rows}) == len(rows) == 302
        assert all(after[k] == v for k, v in before.items() if k != 7)
    ids = [sorted(r["row_key"] for r in with_row_key(t).collect()) for t in (mixed, materialize(mixed.repartition(3), "again"))]
    assert ids[0] == ids[1]


def test_alert_ids_of_other_flows_stay(spark, make_flows):
    flows = materialize(make_flows(*[{"tos": i} for i in range(30)]), "flows")
    more = materialize(flows.unionByName(make_flows({"flow_id": "F-3", "tos": 3})), "more")
    ids = []
    for table_ in (flows, more):
        keyed = with_row_key(table_)
        ids.append({r["tos"]: r["a"] for r in keyed.select("tos", alert_id(F.col("row_key"), dt.date(2026, 9, 20)).alias("a")).collect()})
    assert all(ids[0][k] == ids[1][k] for k in range(30) if k != 3)


def test_flow_ids_move_no_rows(spark):
    raw = materialize(table(spark, *[CIDDS | {"Src Pt": str(i)} for i in range(500)]), "raw")
    plain = convert_cidds(raw)
    assert "Exchange" not in plain._jdf.queryExecution().executedPlan().toString()
    copies = materialize(raw.unionByName(raw.where("`Src Pt` < 5")), "copies")
    converted = convert_cidds(copies)
    plan = converted._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "BroadcastHashJoin" in plan
    ids = [r["flow_id"] for r in converted.collect()]
    assert len(set(ids)) == 505 and sum(i.endswith("-1") for i in ids) == 5
    assert {i for i in ids if i.endswith("-0")} == {r["flow_id"] for r in plain.collect()}
