import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowsift.functions.ordering import from_image, order_image
from flowsift.operators import reports
from flowsift.operators.features import extract_features
from flowsift.operators.quantiles import exact_quantiles, quantile_table
from flowsift.operators.scaling import FlowScaler
from flowsift.schema import FEATURES, NUMERIC_FEATURES
from flowsift.storage import materialize


def test_order_and_zero_duration(make_flows):
    edge = {"flow_duration": 0.0, "packet_count": 1.0, "byte_count": 0.0, "tcp_flags": "SYN", "src_port": 80.0, "dst_port": 80.0}
    features = extract_features(make_flows(edge))
    assert features.columns == FEATURES
    row = features.first()
    assert all(math.isfinite(v) for v in row)
    assert row["packets_per_second"] == pytest.approx(10000.0)
    assert row["is_syn_only"] == 1 and row["src_port_well_known"] == 1 and row["proto_TCP"] == 1


def test_flags_and_bands(make_flows):
    rows = extract_features(
        make_flows(
            {"tcp_flags": "syn,rst", "protocol": "icmp", "src_port": 1023.0, "dst_port": 1024.0},
            {"tcp_flags": None, "protocol": None, "src_port": 49151.0, "dst_port": 49152.0},
            {"tcp_flags": "SYN,FIN"},
        ),
        keep=["flow_id"],
    ).orderBy("flow_id").collect()
    assert (rows[0]["flag_SYN"], rows[0]["flag_RST"], rows[0]["is_syn_only"], rows[0]["proto_ICMP"]) == (1, 1, 1, 1)
    assert (rows[0]["src_port_well_known"], rows[0]["dst_port_registered"]) == (1, 1)
    assert (rows[1]["flag_SYN"], rows[1]["proto_TCP"], rows[1]["src_port_registered"], rows[1]["dst_port_ephemeral"]) == (0, 0, 1, 1)
    assert rows[2]["is_syn_only"] == 0


def test_scaler_guards(make_flows):
    with pytest.raises(ValueError, match="Unsupported"):
        FlowScaler("minmax")
    with pytest.raises(RuntimeError, match="fitted"):
        FlowScaler().transform(make_flows({}))


@pytest.mark.parametrize("kind", ["robust", "standard"])
def test_scaler_matches_numpy(spark, make_flows, kind):
    rng = np.random.default_rng(1)
    rows = [{"packet_count": float(p), "byte_count": float(b), "flow_duration": float(d)} for p, b, d in zip(rng.integers(1, 90, 200), rng.integers(0, 9000, 200), rng.random(200))]
    flows = make_flows(*rows)
    x = extract_features(flows).select(*NUMERIC_FEATURES).toPandas()
    scaler = FlowScaler(kind, exact_rows=20).fit(flows)
    for c in NUMERIC_FEATURES:
        q25, q50, q75 = np.percentile(x[c], [25, 50, 75])
        want = (q50, q75 - q25) if kind == "robust" else (x[c].mean(), x[c].std(ddof=0))
        assert scaler.stats[c] == pytest.approx(want, rel=1e-12)
    again = FlowScaler.from_table(scaler.table(spark), kind)
    assert again.stats == scaler.stats


def test_zero_scale_becomes_one(make_flows):
    scaler = FlowScaler().fit(make_flows({}, {}, {}))
    assert all(scale == 1.0 for _, scale in scaler.stats.values())


PS = [0.0, 0.01, 0.25, 0.5, 0.75, 0.97, 1.0]


@pytest.mark.parametrize("shape", ["smooth", "ties", "hot", "few", "tiny"])
def test_bracketed_quantiles_equal_numpy(spark, shape):
    rng = np.random.default_rng(7)
    x = {
        "smooth": rng.lognormal(0, 2, 20000),
        "ties": rng.integers(0, 40, 20000).astype(float),
        "hot": np.where(rng.random(20000) < 0.34, 0.5, rng.random(20000)),
        "few": np.array([1.0, 2.0, 2.0, 9.0] * 60),
        "tiny": np.array([3.0, 1.0]),
    }[shape]
    df = spark.createDataFrame([(float(v),) for v in x], "x double").unionAll(
        spark.createDataFrame([(None,), (float("nan"),)], "x double")
    )
    for limit in (1, 50, 10**6):
        got = exact_quantiles(df, {"x": PS}, exact_rows=limit)[None]["x"]
        assert got == pytest.approx(np.percentile(x, np.array(PS) * 100).tolist(), rel=1e-12)


def test_grouped_quantiles_and_shrinking_brackets(spark):
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(0, 1, 30000), rng.normal(5, 2, 300), [7.0]])
    g = ["a"] * 30000 + ["b"] * 300 + [None]
    df = spark.createDataFrame(list(zip(g, x.tolist())), "g string, x double")
    got = exact_quantiles(df, {"x": PS}, group="g", exact_rows=3)
    for name, part in (("a", x[:30000]), ("b", x[30000:30300]), (None, x[30300:])):
        assert got[name]["x"] == pytest.approx(np.percentile(part, np.array(PS) * 100).tolist(), rel=1e-12)


def test_images_sort_as_doubles(spark):
    rng = np.random.default_rng(5)
    bits = rng.integers(-(2**63), 2**63 - 1, 4000, dtype=np.int64).view(np.float64)
    x = np.concatenate([bits[np.isfinite(bits)], rng.normal(0, 1, 500), [2.0**k for k in range(-1074, 1024)], [-(2.0**k) for k in range(-1074, 1024)],
                        [0.0, -0.0, math.inf, -math.inf, 5e-324, 2.0**-1022, np.nextafter(2.0**-1022, 0), 1.7976931348623157e308]])
    x = np.concatenate([x, np.nextafter(x, 0)])
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    got = df.select("x", order_image(F.col("x")).alias("i"), from_image(order_image(F.col("x"))).alias("back")).toPandas()
    assert (got.x == got.back).all()
    want = np.where(x < 0, -1, 1) * np.abs(got.x.to_numpy()).view(np.int64)
    assert (got.i.to_numpy() == np.where(got.x == 0, 0, want)).all()
    odd = spark.createDataFrame([(None,), (float("nan"),)], "x double")
    assert odd.select(order_image(F.col("x"))).distinct().collect()[0][0] is None


def test_thousands_of_groups(spark):
    df = spark.range(60_000).select(
        (F.col("id") % 5000).alias("g"), (F.xxhash64("id") % 1000 / 7.0).alias("x"), F.when(F.col("id") % 3 == 0, F.col("id")).alias("y")
    )
    df = materialize(df, "groups")
    got = quantile_table(df, {"x": PS, "y": [0.5]}, "g").toPandas()
    assert len(got) == 5000 * (len(PS) + 1)
    pdf = df.toPandas()
    want = pdf.groupby("g").x.quantile(PS)
    mine = got[got.column == "x"].assign(grp=lambda d: d.grp.astype(int)).set_index(["grp", "p"]).value.sort_index()
    assert np.allclose(mine.to_numpy(), want.sort_index().to_numpy(), rtol=1e-12)
    medians = got[got.column == "y"].assign(grp=lambda d: d.grp.astype(int)).set_index("grp").value.sort_index()
    assert np.allclose(medians.to_numpy(), pdf.groupby("g").y.quantile(0.5).to_numpy(), equal_nan=True)
    boxes = reports.box_statistics(df.select(F.col("g").cast("string"), "x"), ["x"], group="g")
    assert boxes.count() == 5000


def test_empty_and_all_null(spark):
    df = spark.createDataFrame([(None,)], "x double")
    assert exact_quantiles(df, {"x": [0.5]})[None]["x"] == [None]
    assert exact_quantiles(df.where(F.lit(False)), {"x": [0.5]}) == {}
