import numpy as np
import pytest
from pyspark.sql import functions as F

from flowsift.operators import evaluate
from flowsift.operators.evaluate import (
    confusion,
    confusion_of_counts,
    evaluate_detection,
    per_attack_recall,
    pr_points,
    ranking_quality,
    rates,
    roc_points,
    score_counts,
    score_curve,
    tradeoff_curve,
)
from flowsift.operators.running import running_totals
from flowsift.storage import materialize


def scored(spark, y, s, labels=None):
    labels = labels or ["benign" if v == 0 else "c2_beacon" for v in y]
    rows = [(int(a), float(b), c) for a, b, c in zip(y, s, labels)]
    return spark.createDataFrame(rows, "is_anomaly int, anomaly_score double, label string")


def pairwise_auroc(y, s):
    y, s = np.asarray(y), np.asarray(s)
    pos, neg = s[y == 1][:, None], s[y == 0][None, :]
    return ((pos > neg) + 0.5 * (pos == neg)).mean()


def step_precision(y, s):
    y, s = np.asarray(y), np.asarray(s)
    total, last = 0.0, 0.0
    for t in sorted(set(s), reverse=True):
        tp, seen = y[s >= t].sum(), (s >= t).sum()
        total += (tp / y.sum() - last) * tp / seen
        last = tp / y.sum()
    return total


def test_perfect_separation(spark):
    y = [0] * 5 + [1] * 5
    s = [0.1, 0.2, 0.15, 0.3, 0.25, 0.8, 0.85, 0.9, 0.75, 0.95]
    labels = ["benign"] * 5 + ["c2_beacon"] * 3 + ["port_scan"] * 2
    doc = evaluate_detection(scored(spark, y, s, labels), 0.5).first().asDict(True)
    assert [doc[k] for k in ("auroc", "pr_auc", "precision", "recall", "f1_score")] == [1.0] * 5
    assert doc["false_positive_rate"] == 0.0
    assert doc["confusion_matrix"] == dict(true_negatives=5, false_positives=0, false_negatives=0, true_positives=5)
    assert doc["operational_impact"] == dict(
        assumed_daily_flows=1000000, projected_daily_alerts=500000, projected_daily_false_alarms=0
    )
    assert doc["per_attack_recall"]["port_scan"] == dict(count=2, detected=2, recall=1.0)


@pytest.mark.parametrize("kind", ["ties", "smooth", "hot"])
def test_ranking_with_ties_and_hot_scores(spark, kind):
    rng = np.random.default_rng(5)
    y = rng.integers(0, 2, 600)
    s = rng.random(600) + y * 0.3
    s = {"ties": s.round(1), "smooth": s, "hot": np.where(rng.random(600) < 0.4, 1.0, s)}[kind]
    row = ranking_quality(score_curve(scored(spark, y, s))).first()
    assert row["auroc"] == pytest.approx(pairwise_auroc(y, s), abs=1e-12)
    assert row["average_precision"] == pytest.approx(step_precision(y, s), abs=1e-12)


def test_one_class_and_no_alerts(spark):
    benign = scored(spark, [0, 0], [0.1, 0.2])
    row = ranking_quality(score_curve(benign)).first()
    assert row["auroc"] is None and row["average_precision"] == 0.0
    r = rates(confusion(scored(spark, [0, 1], [0.1, 0.2]), 0.9)).first()
    assert (r["precision"], r["recall"], r["f1_score"], r["false_positive_rate"]) == (0.0, 0.0, 0.0, 0.0)


@pytest.mark.parametrize("descending", [True, False])
@pytest.mark.parametrize("buckets", [2, 7, 128])
def test_running_totals(spark, descending, buckets):
    x = np.random.default_rng(2).permutation(500) / 7.0
    df = spark.createDataFrame([(float(v), int(i % 5)) for i, v in enumerate(x)], "x double, n bigint")
    got = running_totals(df, "x", ["n"], descending, buckets).toPandas().sort_values("x", ascending=not descending)
    assert (got["cum_n"].to_numpy() == got["n"].cumsum().to_numpy()).all()
    assert len(got) == 500


def test_running_totals_of_nothing(spark):
    df = spark.createDataFrame([], "x double, n bigint")
    assert running_totals(df, "x", ["n"]).count() == 0


def test_curves(spark):
    data = scored(spark, [0, 1, 0, 1], [0.1, 0.4, 0.4, 0.9])
    roc = sorted((r["fpr"], r["tpr"]) for r in roc_points(score_curve(data)).collect())
    assert roc == [(0.0, 0.0), (0.0, 0.5), (0.5, 1.0), (1.0, 1.0)]
    pr = {(r["recall"], round(r["precision"], 6)) for r in pr_points(score_curve(data)).collect()}
    assert pr == {(0.0, 1.0), (0.5, 1.0), (1.0, 0.666667), (1.0, 0.5)}


@pytest.mark.parametrize("steps", [1, 2, 50, 100])
def test_tradeoff_equals_one_pass_per_threshold(spark, steps):
    rng = np.random.default_rng(9)
    grid = np.linspace(0.1, 0.95, steps)
    s = np.concatenate([rng.random(300), grid, [0.0, 1.0, np.nextafter(0.1, 0)]])
    y = rng.integers(0, 2, len(s))
    rows = tradeoff_curve(scored(spark, y, s), steps).collect()
    assert len(rows) == steps
    for row, t in zip(sorted(rows, key=lambda r: r["threshold"]), grid):
        hit = s >= t
        assert row["recall"] == pytest.approx(hit[y == 1].mean(), abs=6e-5)
        assert row["fpr"] == pytest.approx(hit[y == 0].mean(), abs=6e-6)
        assert row["alert_percentage"] == pytest.approx(hit.mean() * 100, abs=6e-4)


def test_per_attack_has_no_benign_row(spark):
    data = scored(spark, [0, 1, 1], [0.9, 0.9, 0.1])
    assert [tuple(r) for r in per_attack_recall(data, 0.5).collect()] == [("c2_beacon", 2, 1, 0.5)]


def test_too_many_labels_fail_instead_of_being_cut(spark, monkeypatch):
    monkeypatch.setattr(evaluate, "MAX_LABELS", 2)
    data = scored(spark, [1, 1, 1], [0.9] * 3, ["a", "b", "c"])
    with pytest.raises(Exception, match="more than 2 attack labels"):
        evaluate_detection(data, 0.5).collect()
    doc = evaluate_detection(data, 0.5, with_labels=False)
    assert "per_attack_recall" not in doc.columns and doc.count() == 1


def test_score_at_threshold_is_an_alert(spark):
    row = confusion(scored(spark, [1, 0], [0.5, 0.5]), 0.5).first()
    assert (row["tp"], row["fp"]) == (1, 1)


def test_every_score_is_different(spark):
    """60,000 distinct scores against numpy, in as many partitions as the session sorts with."""
    n = 60_000
    df = spark.range(n).select(
        (F.xxhash64("id") / float(2**63)).alias("anomaly_score"), (F.xxhash64("id", F.lit(1)) % 5 == 0).cast("int").alias("is_anomaly")
    )
    df = materialize(df, "distinct-scores")
    pdf = df.toPandas().sort_values("anomaly_score", ascending=False, ignore_index=True)
    curve = score_curve(df).toPandas().sort_values("threshold", ascending=False, ignore_index=True)
    assert len(curve) == pdf.anomaly_score.nunique() == n
    assert (curve.cum_p.to_numpy() == pdf.is_anomaly.cumsum().to_numpy()).all() and (curve.cum_n.to_numpy() == range(1, n + 1)).all()
    row = ranking_quality(score_curve(df)).first()
    p, hits = pdf.is_anomaly.to_numpy(), pdf.is_anomaly.cumsum().to_numpy()
    assert row["average_precision"] == pytest.approx((p * hits / np.arange(1, n + 1)).sum() / p.sum(), rel=1e-9)
    assert row["auroc"] == pytest.approx(((1 - p) * hits).sum() / (p.sum() * (n - p.sum())), rel=1e-9)
    matrix = confusion(df, 0.25).first()
    assert confusion_of_counts(score_counts(df), 0.25).first() == matrix


def test_metrics_read_the_scores_twice(spark, monkeypatch):
    rows = [(i / 40_000, i % 3 == 0, f"label{i}") for i in range(20_000)]
    df = spark.createDataFrame(rows, "anomaly_score double, hit boolean, label string").withColumn("is_anomaly", F.col("hit").cast("int"))
    df = materialize(df, "many-labels")
    path = df.inputFiles()[0].rsplit("/", 1)[0]
    scans = []
    store = evaluate.materialize

    def watched(out, name):
        scans.append(out._jdf.queryExecution().executedPlan().toString().count(path))
        return store(out, name)

    monkeypatch.setattr(evaluate, "materialize", watched)
    doc = evaluate.evaluate_detection(df, 0.3)
    scans.append(doc._jdf.queryExecution().executedPlan().toString().count(path))
    assert sum(scans) <= 2
    # As many labels as the data has; none is refused.
    assert len(doc.first()["per_attack_recall"]) == 20_000
