"""Report queries over scored flows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowsift.operators.evaluate import per_attack_recall
from flowsift.operators.forest import flag_alerts
from flowsift.operators.quantiles import exact_quantiles, quantile_table
from flowsift.schema import BENIGN, THRESHOLD_PRESETS, THRESHOLD_RANGE
from flowsift.storage import materialize

QUEUE_COLUMNS = [
    "flow_id",
    "src_ip",
    "dst_ip",
    "dst_port",
    "protocol",
    "packet_count",
    "byte_count",
    "anomaly_score",
    "label",
]


def kpis(scored: DataFrame, threshold: float, with_labels: bool = True) -> DataFrame:
    """Total, flagged, flagged % and false-positive % in one pass."""
    hit = F.col("anomaly_score") >= F.lit(float(threshold))
    benign = F.col("is_anomaly") == 0 if with_labels else F.lit(False)
    counts = scored.agg(
        F.count(F.lit(1)).alias("total_flows"),
        F.count_if(hit).alias("flagged_flows"),
        F.count_if(hit & benign).alias("fp"),
        F.count_if(benign).alias("benign"),
    )
    total = F.col("total_flows")
    return counts.select(
        "total_flows",
        "flagged_flows",
        F.when(total > 0, F.col("flagged_flows") / total * 100.0).otherwise(F.lit(0.0)).alias("flagged_pct"),
        (F.col("fp") / F.greatest(F.col("benign"), F.lit(1)) * 100.0).alias("fpr_pct"),
    )


def preset_threshold(preset: str, calibrated: float) -> float:
    """Threshold of a named preset; ``calibrated`` rounds the fitted threshold to 2 places."""
    if preset != "calibrated" and preset not in THRESHOLD_PRESETS:
        raise ValueError(f"presets are calibrated, {', '.join(THRESHOLD_PRESETS)}; not {preset!r}")
    value = THRESHOLD_PRESETS.get(preset, round(calibrated, 2))
    low, high = THRESHOLD_RANGE
    return min(max(value, low), high)


def apply_threshold(scored: DataFrame, threshold: float) -> DataFrame:
    return flag_alerts(scored, threshold)


def scored_view(scored: DataFrame, threshold: float) -> DataFrame:
    """Status from the full score, then the score rounded to 3 places for display."""
    hit = F.col("anomaly_score") >= F.lit(float(threshold))
    return scored.withColumns(
        {
            "status": F.when(hit, "FLAGGED").otherwise("NORMAL"),
            # Scaled, rounded half to even, scaled back: what array libraries do.
            "anomaly_score": F.rint(F.col("anomaly_score") * 1000) / 1000,
        }
    )


def incident_queue(scored: DataFrame, threshold: float, label: str | None = None) -> DataFrame:
    """Flagged flows, highest score first, ties by flow id."""
    queue = scored_view(scored, threshold).where(F.col("status") == "FLAGGED")
    if label is not None:
        queue = queue.where(F.col("label") == label)
    return queue.orderBy(F.col("anomaly_score").desc(), "flow_id")


def queue_labels(scored: DataFrame, threshold: float) -> DataFrame:
    flagged = scored.where(F.col("anomaly_score") >= F.lit(float(threshold)))
    return flagged.select("label").distinct().orderBy("label")


def queue_page(scored: DataFrame, threshold: float, rows: int = 30, label: str | None = None) -> DataFrame:
    """The first rows of the queue (a top-k, no full sort)."""
    return incident_queue(scored, threshold, label).select(*QUEUE_COLUMNS).limit(rows)


def per_attack_table(scored: DataFrame, threshold: float) -> DataFrame:
    """Per-attack recall as percent text with one decimal."""
    table = per_attack_recall(scored, threshold)
    percent = F.format_string("%.1f%%", F.round(F.col("recall") * 100.0, 1))
    return table.select("label", "count", "detected", percent.alias("recall"))


def flagged_share(scored: DataFrame, threshold: float) -> DataFrame:
    hit = (F.col("anomaly_score") >= F.lit(float(threshold))).cast("bigint")
    return scored.agg(F.sum(hit).alias("flagged"), F.avg(hit).alias("flagged_share"))


def top_flows(scored: DataFrame, n: int) -> DataFrame:
    """The ``n`` most anomalous flows, ties by flow id."""
    return scored.orderBy(F.col("anomaly_score").desc(), "flow_id").limit(n)


def most_anomalous(scored: DataFrame) -> DataFrame:
    return top_flows(scored, 1)


def top_flagged(scored: DataFrame, threshold: float, n: int = 50) -> DataFrame:
    return top_flows(scored.where(F.col("anomaly_score") >= F.lit(float(threshold))), n)


def attack_share(flows: DataFrame) -> DataFrame:
    return flows.agg(F.avg("is_anomaly").alias("attack_share"))


def label_counts(flows: DataFrame) -> DataFrame:
    return flows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), "label")


def column_summary(df: DataFrame, columns: list[str]) -> DataFrame:
    """Count, mean, sample std, min, exact quartiles, max per column, 3 decimals."""
    quartiles = exact_quantiles(df, {c: [0.25, 0.5, 0.75] for c in columns}).get(None, {})
    kinds = {"count": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    row = df.agg(*[f(F.col(c).cast("double")).alias(f"{c}_{k}") for c in columns for k, f in kinds.items()]).first()

    def line(c: str) -> tuple:
        q = quartiles.get(c, [None] * 3)
        v = {k: row[f"{c}_{k}"] for k in kinds}
        return (c, v["count"], v["mean"], v["std"], v["min"], *q, v["max"])

    table = df.sparkSession.createDataFrame(
        [line(c) for c in columns],
        "column string, count bigint, mean double, std double, min double, q25 double, q50 double, q75 double, max double",
    )
    return table.select("column", "count", *[F.round(c, 3).alias(c) for c in table.columns[2:]])


def box_statistics(df: DataFrame, measures: list[str], group: str = "label") -> DataFrame:
    """Quartiles and 1.5 IQR whiskers of each measure per group, long form.

    Quartiles are exact; the whiskers are the extreme rows inside the fences, found in one
    more aggregation over the rows joined with the fences of their group. Fences are a
    table, so the number of groups is not limited; Spark broadcasts it where it is small.
    """
    quartiles = quantile_table(df, {m: [0.25, 0.5, 0.75] for m in measures}, group=group)
    q = lambda p: F.max(F.when(F.col("p") == p, F.col("value")))
    fences = quartiles.groupBy("grp", "column").agg(q(0.25).alias("q25"), q(0.5).alias("q50"), q(0.75).alias("q75"))
    reach = 1.5 * (F.col("q75") - F.col("q25"))
    fences = materialize(
        fences.where("q25 IS NOT NULL").select(
            F.col("grp").alias(group),
            F.col("column").alias("measure"),
            "q25",
            "q50",
            "q75",
            (F.col("q25") - reach).alias("low"),
            (F.col("q75") + reach).alias("high"),
        ),
        "fences",
    )
    pivoted = fences.groupBy(group).agg(
        *[F.max(F.when(F.col("measure") == m, F.struct("low", "high"))).alias(f"__{m}") for m in measures]
    )
    fenced = pivoted.withColumnRenamed(group, "__group")
    joined = df.select(group, *measures).join(fenced, F.col(group).cast("string").eqNullSafe(F.col("__group")))

    def inside(m: str) -> Column:
        return F.when(F.col(m).between(F.col(f"__{m}.low"), F.col(f"__{m}.high")), F.col(m))

    ends = joined.groupBy(group).agg(
        *[
            F.struct(F.lit(m).alias("measure"), F.min(inside(m)).alias("whisker_low"), F.max(inside(m)).alias("whisker_high"), F.count(m).alias("n")).alias(m)
            for m in measures
        ]
    )
    long = ends.select(group, F.explode(F.array(*measures)).alias("r")).select(group, "r.*")
    known = fences.drop("low", "high").withColumnRenamed(group, "__group").withColumnRenamed("measure", "__measure")
    same = F.col(group).cast("string").eqNullSafe(F.col("__group")) & (F.col("measure") == F.col("__measure"))
    return long.join(known, same).drop("__group", "__measure")


def score_density(scored: DataFrame, bins: int = 50) -> DataFrame:
    """Rows per class and score bin."""
    slot = F.least(F.floor(F.col("anomaly_score") * bins), F.lit(bins - 1)).cast("int")
    return (
        scored.groupBy("is_anomaly", slot.alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def split_baseline(flows: DataFrame, key: Column) -> tuple[DataFrame, DataFrame]:
    """Baseline (benign rows with an even key) and evaluation (rows with an odd key)."""
    even = F.pmod(key, F.lit(2)) == 0
    return flows.where((F.col("label") == BENIGN) & even), flows.where(~even)


def bounded_sample(df: DataFrame, rows: int = 500, key: str = "flow_id") -> DataFrame:
    """A repeatable sample of at most ``rows`` rows, by hash of the key (a top-k)."""
    return df.orderBy(F.xxhash64(key), key).limit(rows)


def append_rows(flows: DataFrame, more: DataFrame) -> DataFrame:
    return flows.unionByName(more)


def find_flow(df: DataFrame, flow_id: str) -> DataFrame:
    return df.where(F.col("flow_id") == flow_id)
