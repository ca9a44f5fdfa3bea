"""Detection quality and alert volume from scored, labelled flows."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowsift.operators.running import running_totals
from flowsift.schema import BENIGN, DAILY_FLOWS, TRADEOFF_STEPS
from flowsift.storage import materialize

# A caller that knows how many attack labels there can be may set a limit: more are an error then.
MAX_LABELS: int | None = None
SCORE, TRUTH = "anomaly_score", "is_anomaly"


def _share(part: Column, whole: Column) -> Column:
    """part / whole, 0 when whole is 0."""
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def confusion(scored: DataFrame, threshold: float, score: str = SCORE, truth: str = TRUTH) -> DataFrame:
    """One row ``tn, fp, fn, tp``: one pass, four counters."""
    hit, attack = F.col(score) >= F.lit(float(threshold)), F.col(truth) == 1
    return scored.agg(
        F.count_if(~hit & ~attack).alias("tn"),
        F.count_if(hit & ~attack).alias("fp"),
        F.count_if(~hit & attack).alias("fn"),
        F.count_if(hit & attack).alias("tp"),
    )


def rates(matrix: DataFrame) -> DataFrame:
    """Unrounded precision, recall, F1 and false-positive rate of a confusion row."""
    tn, fp, fn, tp = (F.col(c).cast("double") for c in ("tn", "fp", "fn", "tp"))
    with_parts = matrix.withColumns(
        {
            "precision": _share(tp, tp + fp),
            "recall": _share(tp, tp + fn),
            "false_positive_rate": _share(fp, fp + tn),
        }
    )
    p, r = F.col("precision"), F.col("recall")
    return with_parts.withColumn("f1_score", F.when(p + r > 0, F.lit(2.0) * p * r / (p + r)).otherwise(F.lit(0.0)))


def rounded_rates(matrix: DataFrame) -> DataFrame:
    return rates(matrix).select(
        F.round("precision", 4).alias("precision"),
        F.round("recall", 4).alias("recall"),
        F.round("f1_score", 4).alias("f1_score"),
        F.round("false_positive_rate", 5).alias("false_positive_rate"),
    )


def score_counts(scored: DataFrame, score: str = SCORE, truth: str = TRUTH) -> DataFrame:
    """One stored row per distinct score: rows, attacks and rows whose truth is known."""
    attack = F.col(truth)
    counts = scored.groupBy(F.col(score).alias("threshold")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(attack.cast("bigint")).alias("p"), F.count(attack).alias("known")
    )
    return materialize(counts, "score-counts")


def score_curve(scored: DataFrame, score: str = SCORE, truth: str = TRUTH) -> DataFrame:
    """One row per distinct score, highest first: rows, attacks and their running totals."""
    return curve_of_counts(score_counts(scored, score, truth))


def curve_of_counts(counts: DataFrame) -> DataFrame:
    """The curve of :func:`score_counts`, which is all that it reads."""
    return running_totals(counts.drop("known"), "threshold", ["n", "p"], descending=True, stored=True)


def confusion_of_counts(counts: DataFrame, threshold: float) -> DataFrame:
    """The confusion row of :func:`score_counts`."""
    hit = F.col("threshold") >= F.lit(float(threshold))
    p, clean = F.coalesce("p", F.lit(0)), F.col("known") - F.coalesce("p", F.lit(0))
    cells = {"tn": (~hit, clean), "fp": (hit, clean), "fn": (~hit, p), "tp": (hit, p)}
    return counts.agg(*[F.coalesce(F.sum(F.when(rows, n)), F.lit(0)).alias(c) for c, (rows, n) in cells.items()])


def ranking_quality(curve: DataFrame) -> DataFrame:
    """One row ``auroc, average_precision`` from :func:`score_curve`.

    Ties count half for AUROC. Average precision is the step sum, not the
    trapezoid. AUROC is null when only one class is present.
    """
    n, p, tp, seen = (F.col(c).cast("double") for c in ("n", "p", "cum_p", "cum_n"))
    sums = curve.agg(
        F.sum(p).alias("P"),
        F.sum(n - p).alias("N"),
        F.sum((n - p) * (tp - p / 2)).alias("area"),
        F.sum(p * tp / seen).alias("steps"),
    )
    return sums.select(
        F.when((F.col("P") > 0) & (F.col("N") > 0), F.col("area") / (F.col("P") * F.col("N"))).alias("auroc"),
        F.when(F.col("P") > 0, F.col("steps") / F.col("P")).otherwise(F.lit(0.0)).alias("average_precision"),
    )


def roc_points(curve: DataFrame) -> DataFrame:
    """``fpr, tpr, threshold`` for every distinct score plus the origin."""
    total = curve.agg(F.struct(F.sum("p").alias("p"), F.sum(F.col("n") - F.col("p")).alias("n")).alias("t")).scalar()
    points = curve.select(
        _share((F.col("cum_n") - F.col("cum_p")).cast("double"), total["n"].cast("double")).alias("fpr"),
        _share(F.col("cum_p").cast("double"), total["p"].cast("double")).alias("tpr"),
        "threshold",
    )
    origin = curve.sparkSession.range(1).select(
        F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"), F.lit(float("inf")).alias("threshold")
    )
    return points.unionByName(origin)


def pr_points(curve: DataFrame) -> DataFrame:
    """``precision, recall, threshold`` for every distinct score plus the end point."""
    total = curve.agg(F.sum("p")).scalar()
    points = curve.select(
        (F.col("cum_p").cast("double") / F.col("cum_n").cast("double")).alias("precision"),
        _share(F.col("cum_p").cast("double"), total.cast("double")).alias("recall"),
        "threshold",
    )
    end = curve.sparkSession.range(1).select(
        F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall"), F.lit(None).cast("double").alias("threshold")
    )
    return points.unionByName(end)


def no_skill_precision(scored: DataFrame, truth: str = TRUTH) -> DataFrame:
    return scored.agg(F.avg(truth).alias("no_skill_precision"))


def operational_impact(matrix: DataFrame, daily_flows: int = DAILY_FLOWS) -> DataFrame:
    """Alerts and false alarms per day if the rates hold, cut to whole numbers."""
    tn, fp, fn, tp = (F.col(c).cast("double") for c in ("tn", "fp", "fn", "tp"))
    alerts = _share(tp + fp, tn + fp + fn + tp)
    return matrix.select(
        F.lit(daily_flows).cast("bigint").alias("assumed_daily_flows"),
        (alerts * F.lit(float(daily_flows))).cast("bigint").alias("projected_daily_alerts"),
        (_share(fp, fp + tn) * F.lit(float(daily_flows))).cast("bigint").alias("projected_daily_false_alarms"),
    )


def per_attack_recall(scored: DataFrame, threshold: float, score: str = SCORE) -> DataFrame:
    """``label, count, detected, recall`` of the attack classes."""
    hit = (F.col(score) >= F.lit(float(threshold))).cast("bigint")
    return (
        scored.where(F.col("label") != BENIGN)
        .groupBy("label")
        .agg(
            F.count(F.lit(1)).alias("count"),
            F.sum(hit).alias("detected"),
            F.round(F.avg(hit), 4).alias("recall"),
        )
    )


def tradeoff_curve(
    scored: DataFrame,
    steps: int = TRADEOFF_STEPS,
    daily_flows: int = DAILY_FLOWS,
    score: str = SCORE,
    truth: str = TRUTH,
) -> DataFrame:
    """Recall, precision, FPR and alert volume for ``steps`` thresholds in 0.1..0.95.

    One pass: every score falls into the slot of the highest threshold it
    reaches; per-slot counts (at most ``steps`` + 1 rows) are added up from the
    top.
    """
    thresholds = [float(t) for t in np.linspace(0.1, 0.95, steps)]
    grid = F.array(*map(F.lit, thresholds))
    width = (thresholds[-1] - thresholds[0]) / max(steps - 1, 1)
    value = F.col(score)
    # Arithmetic guess, then one step up or down by comparing with the exact threshold.
    guess = F.floor((value - F.lit(thresholds[0])) / F.lit(width or 1.0)).cast("int") + 1
    guess = F.least(F.greatest(guess, F.lit(0)), F.lit(steps))
    slots = scored.select(value.alias("s"), (F.col(truth) == 1).cast("bigint").alias("y"), guess.alias("g"))
    reached = (
        F.col("g")
        - F.when((F.col("g") > 0) & (F.col("s") < F.try_element_at(grid, F.greatest(F.col("g"), F.lit(1)))), 1).otherwise(0)
        + F.when((F.col("g") < steps) & (F.col("s") >= F.try_element_at(grid, F.col("g") + 1)), 1).otherwise(0)
    )
    per_slot = (
        slots.groupBy(reached.alias("slot"))
        .agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("p"))
    )
    # At most steps + 1 small rows: fold them into one array and expand per threshold.
    packed = per_slot.agg(
        F.collect_list(F.struct("slot", "n", "p")).alias("slots"),
        F.coalesce(F.sum("n"), F.lit(0)).cast("double").alias("total"),
        F.coalesce(F.sum("p"), F.lit(0)).cast("double").alias("attacks"),
    )
    lines = packed.select("slots", "total", "attacks", F.posexplode(grid).alias("i", "threshold"))

    def at_or_above(field: str) -> Column:
        return F.aggregate(
            F.filter("slots", lambda s: s["slot"] > F.col("i")),
            F.lit(0).cast("bigint"),
            lambda acc, s: acc + s[field],
        ).cast("double")

    counted = lines.select("threshold", "total", "attacks", at_or_above("n").alias("hits"), at_or_above("p").alias("tp"))
    share = _share(F.col("hits"), F.col("total")) * 100.0
    return counted.select(
        F.round("threshold", 3).alias("threshold"),
        F.round(_share(F.col("tp"), F.col("attacks")), 4).alias("recall"),
        F.round(_share(F.col("tp"), F.col("hits")), 4).alias("precision"),
        F.round(_share(F.col("hits") - F.col("tp"), F.col("total") - F.col("attacks")), 5).alias("fpr"),
        F.round(share, 3).alias("alert_percentage"),
        (share / 100.0 * F.lit(float(daily_flows))).cast("bigint").alias("projected_daily_alerts"),
    )


def confusion_cells(matrix: DataFrame) -> DataFrame:
    """The confusion matrix as four labelled rows (labels are fixed values)."""
    return matrix.select(
        F.expr(
            "stack(4, "
            "'Actual Benign', 'Predicted Benign', 'Benign Ignored', tn, "
            "'Actual Benign', 'Predicted Anomaly', 'False Alarms', fp, "
            "'Actual Attack', 'Predicted Benign', 'Missed Attacks', fn, "
            "'Actual Attack', 'Predicted Anomaly', 'True Alerts', tp) "
            "as (actual, predicted, cell, n)"
        )
    )


def evaluate_detection(
    scored: DataFrame,
    threshold: float,
    daily_flows: int = DAILY_FLOWS,
    with_labels: bool = True,
    score: str = SCORE,
    truth: str = TRUTH,
) -> DataFrame:
    """The metrics document: one nested row.

    ``scored`` is read twice: once for counts per distinct score, from which all but the
    per-attack map follows, and once for that map, which has one entry per attack label.
    """
    counts = score_counts(scored, score, truth)
    matrix = confusion_of_counts(counts, threshold)
    quality = ranking_quality(curve_of_counts(counts))
    impact = operational_impact(matrix, daily_flows)
    columns = [
        F.round(F.col("quality.auroc"), 4).alias("auroc"),
        F.round(F.col("quality.average_precision"), 4).alias("pr_auc"),
        F.round(F.lit(float(threshold)), 4).alias("threshold"),
        F.round("precision", 4).alias("precision"),
        F.round("recall", 4).alias("recall"),
        F.round("f1_score", 4).alias("f1_score"),
        F.round("false_positive_rate", 5).alias("false_positive_rate"),
        F.struct(
            F.col("tn").alias("true_negatives"),
            F.col("fp").alias("false_positives"),
            F.col("fn").alias("false_negatives"),
            F.col("tp").alias("true_positives"),
        ).alias("confusion_matrix"),
        F.col("impact").alias("operational_impact"),
    ]
    parts = {
        "quality": quality.select(F.struct("*")).scalar(),
        "impact": impact.select(F.struct("*")).scalar(),
    }
    if with_labels:
        per_attack = per_attack_recall(scored, threshold, score)
        entry = F.struct("label", F.struct("count", "detected", "recall").alias("v"))
        entries = per_attack.agg(F.collect_list(entry).alias("e"))
        entry_map = F.map_from_entries("e")
        if MAX_LABELS is not None:
            too_many = F.raise_error(F.lit(f"more than {MAX_LABELS} attack labels"))
            entry_map = F.when(F.size("e") > MAX_LABELS, too_many).otherwise(entry_map)
        parts["attacks"] = entries.select(entry_map).scalar()
        columns.append(F.col("attacks").alias("per_attack_recall"))
    return rates(matrix).withColumns(parts).select(*columns)
