"""Explanation records, importance and waterfall tables from attributions.

Input rows carry ``phi`` (24 attributions), ``anomaly_score`` and the 24 scaled
features. Everything here is column work inside one stage; flows are never
looped over.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowsift.functions.narrative import narrative, payload_density, short_number
from flowsift.operators.quantiles import exact_quantiles
from flowsift.schema import FEATURES, TOP_K

WATERFALL_ROWS = 8


def baseline_statistics(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Mean, population std (0 -> 1) and median of every numeric column, long form."""
    numeric = {"double", "float", "int", "bigint", "smallint", "tinyint"}
    names = columns or [name for name, kind in df.dtypes if kind in numeric or kind.startswith("decimal")]
    medians = exact_quantiles(df, {c: [0.5] for c in names}).get(None, {})
    row = df.agg(
        *[F.avg(c).alias(f"{c}_avg") for c in names], *[F.stddev_pop(c).alias(f"{c}_std") for c in names]
    ).first()
    rows = [
        (c, row[f"{c}_avg"], row[f"{c}_std"] or 1.0, medians.get(c, [None])[0]) for c in names
    ]
    return df.sparkSession.createDataFrame(rows, "column string, mean double, std double, median double")


def top_drivers(phi: Column, scaled: Column, k: int = TOP_K, raw: Column | None = None) -> Column:
    """The ``k`` largest positive attributions, or the ``k`` largest if none is positive.

    The 24 entries are written out, so that generated code makes and sorts them; lambdas, which
    Spark interprets, see the ``k`` chosen ones only. Positive ones alone are sorted, and all
    are made only where none is positive.
    """

    def entry(i: int) -> Column:
        return F.struct(
            phi[i].alias("phi"),
            F.lit(-i).alias("turn"),
            F.lit(FEATURES[i]).alias("feature"),
            scaled[i].alias("scaled"),
            (F.lit(None).cast("double") if raw is None else raw[i]).alias("raw"),
        )

    def largest(entries: list[Column]) -> Column:
        return F.slice(F.sort_array(F.array_compact(F.array(*entries)), asc=False), 1, k)

    every = [entry(i) for i in range(len(FEATURES))]
    above = [-phi[i] < 0 for i in range(len(FEATURES))]
    positive = [F.when(is_above, e) for is_above, e in zip(above, every)]
    chosen = F.when(phi.isNotNull(), F.when(reduce(or_, above), largest(positive)).otherwise(largest(every)))

    def record(d: Column) -> Column:
        return F.struct(
            d["feature"].alias("feature"),
            F.round(d["phi"], 4).alias("shap_contribution"),
            F.round(d["scaled"], 4).alias("scaled_value"),
            d["raw"].alias("raw_value"),
        )

    return F.transform(chosen, record)


def explain_flows(
    attributed: DataFrame,
    threshold: float,
    k: int = TOP_K,
    key: str = "flow_id",
    with_raw_flow: bool = True,
    raw_features: list[Column] | None = None,
) -> DataFrame:
    """One explanation per row: rounded score, alert bit, drivers, narrative.

    The alert bit and the status in the text use the unrounded score.
    ``raw_features`` (24 columns) fills ``raw_value``; raw flows have no
    engineered columns, so it is null by default.
    """
    scaled = F.array(*[F.col(c).cast("double") for c in FEATURES])
    raw = F.array(*[c.cast("double") for c in raw_features]) if raw_features else None
    with_drivers = attributed.withColumn("top_drivers", top_drivers(F.col("phi"), scaled, k, raw))
    if with_raw_flow:
        density = payload_density(F.col("byte_count"), F.col("packet_count"))
    else:
        value = F.round(F.col("bytes_per_packet"), 4)
        density = F.concat(F.lit("scaled="), short_number(value))
    score = F.col("anomaly_score")
    return with_drivers.select(
        key,
        F.round(score, 4).alias("explained_score"),
        (score >= F.lit(float(threshold))).cast("int").alias("is_alert"),
        "top_drivers",
        narrative(score, threshold, F.col("top_drivers"), density).alias("narrative"),
        *[c for c in attributed.columns if c not in (key, "phi", "anomaly_score", "is_alert", *FEATURES)],
    ).withColumnRenamed("explained_score", "anomaly_score")


def waterfall(attributed: DataFrame, base_value: float, key: str = "flow_id") -> DataFrame:
    """Rows of a waterfall per flow: the 7 largest by size, the rest as one, with running totals.

    Each flow has 24 attributions, so ranking and running sums are array work
    inside the row; nothing is shuffled.
    """
    top, phi = WATERFALL_ROWS - 1, F.col("phi")
    # All entries are written out, so that generated code and no lambda makes, sorts and sums them.
    entries = [
        F.struct(F.abs(phi[i]).alias("size"), F.lit(-i).alias("turn"), F.lit(name).alias("feature"), phi[i].alias("phi"))
        for i, name in enumerate(FEATURES)
    ]
    ranked = F.when(phi.isNotNull(), F.sort_array(F.array(*entries), asc=False))
    rows = attributed.select(key, ranked.alias("__ranked"))
    at = [F.col("__ranked")[i] for i in range(len(FEATURES))]
    rest = reduce(lambda total, d: total + d["phi"], at[top:], F.lit(0.0))
    steps = [(d["feature"], d["phi"]) for d in at[:top]] + [(F.lit(f"{len(FEATURES) - top} other features"), rest)]
    running, total = [], F.lit(base_value)
    for n, (feature, value) in enumerate(steps, 1):
        total = total + value
        running.append(
            F.struct(F.lit(n).alias("position"), feature.alias("feature"), value.alias("phi"), total.alias("running_total"))
        )
    return rows.select(key, F.explode(F.array(*running)).alias("r")).select(key, "r.*")
