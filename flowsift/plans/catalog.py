"""Every operator as a named query over the given tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowsift.functions.features import feature_columns
from flowsift.functions.parsing import parse_byte_size, parse_letter_flags, protocol_name, to_number, to_whole
from flowsift.operators import convert, evaluate, explain, reports, triage, validate
from flowsift.operators.attribution import FlowExplainer, feature_importance, long_attributions
from flowsift.operators.features import extract_features, with_features
from flowsift.operators.forest import (
    IsolationForest,
    calibrate_threshold,
    default_threshold,
    flag_alerts,
    forest_table,
    sample_per_tree,
)
from flowsift.operators.rowkeys import with_flow_id
from flowsift.operators.scaling import FlowScaler
from flowsift.plans import benchmark, pipeline
from flowsift.plans.frozen import frozen_model
from flowsift.session import tune
from flowsift.schema import BENIGN, FEATURES, FLAG_FEATURES, FLOW_COLUMNS, NUMERIC_FEATURES, ForestConfig
from flowsift.sources import tables
from flowsift.fixtures.views import stored_view
from flowsift.sources.models import FlowModel, load_model, save_model
from flowsift.storage import materialize, new_path
from flowsift.streaming.scoring import alert_stream, read_flow_stream, write_alert_stream
from flowsift.streaming.windows import read_window_counts, windowed_alerts, write_window_counts

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

THRESHOLD = 0.5
RUN_DATE = dt.date(2026, 9, 20)
_MODELS: dict[tuple[str, str], FlowModel] = {}
_FROZEN: dict[tuple[str, str, str], DataFrame] = {}


def query(name: str) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(tune(spark), sf_dir)

        QUERIES[name] = run
        return run

    return register


# -- shared inputs ---------------------------------------------------------


def _flows(spark, sf):
    return stored_view(spark, sf, "flows")


def _dirty(spark, sf):
    return stored_view(spark, sf, "flows_dirty")


def _scored(spark, sf):
    return stored_view(spark, sf, "scored_surrogate")


def _split(spark, sf):
    base, evaluation = reports.split_baseline(stored_view(spark, sf, "flows_with_order_key"), F.col("order_key"))
    return base.drop("order_key"), evaluation.drop("order_key")


def _rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.select(
        *[F.round(c, digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes]
    )


def _once(cache: dict, spark: SparkSession, sf: str, name: str, make):
    key = (spark.sparkContext.applicationId, sf, name)
    if key not in cache:
        cache[key] = make()
    return cache[key]


def trained_model(spark: SparkSession, sf: str) -> FlowModel:
    """Model trained on the baseline split, once per session and folder."""
    return _once(_MODELS, spark, sf, "model", lambda: pipeline.train_model(pipeline.prepare(_split(spark, sf)[0])))


def scored_evaluation(spark: SparkSession, sf: str) -> DataFrame:
    """The evaluation split scored by the trained model, stored once."""

    def make():
        evaluation = pipeline.prepare(_split(spark, sf)[1])
        return materialize(pipeline.score_flows(trained_model(spark, sf), evaluation), "scored-evaluation")

    return _once(_FROZEN, spark, sf, "trained", make)


def frozen_attributions(spark: SparkSession, sf: str) -> DataFrame:
    """All flows scored and attributed by the frozen forest, in the pass that reads them.

    Nothing is stored: 24 features and 24 attributions a flow take several times the room of
    the flows, and three small trees cost less than reading them back. A query computes what it uses.
    """

    def make():
        model = frozen_model()
        scored = model.forest.compute_anomaly_scores(model.scaler.with_scaled(_flows(spark, sf)))
        return FlowExplainer(model.forest).compute_anomaly_shap(scored)

    return _once(_FROZEN, spark, sf, "frozen", make)


def frozen_explanations(spark: SparkSession, sf: str) -> DataFrame:
    return explain.explain_flows(frozen_attributions(spark, sf), frozen_model().forest.threshold)


def _metrics_row(doc: DataFrame) -> DataFrame:
    """A metrics document as flat columns, the per-attack map as text."""
    attacks = F.array_join(
        F.transform(
            F.array_sort(F.map_keys("per_attack_recall")),
            lambda k: F.concat(
                k,
                F.lit(":"),
                F.col("per_attack_recall")[k]["count"].cast("string"),
                F.lit(":"),
                F.col("per_attack_recall")[k]["detected"].cast("string"),
            ),
        ),
        ",",
    )
    top = ["auroc", "pr_auc", "threshold", "precision", "recall", "f1_score", "false_positive_rate"]
    return doc.select(*top, "confusion_matrix.*", "operational_impact.*", attacks.alias("attacks"))


def _flat_alerts(alerts: DataFrame) -> DataFrame:
    drivers = F.transform("anomaly_analysis.top_driving_features", lambda d: d["feature"])
    return alerts.select(
        "alert_id",
        "flow_id",
        "timestamp",
        "severity",
        "action",
        "network_traffic.*",
        F.col("anomaly_analysis.calibrated_anomaly_score").alias("score"),
        F.array_join(drivers, ",").alias("drivers"),
        F.col("anomaly_analysis.soc_justification").alias("justification"),
        "fusion_threat_intel.*",
        "soar_remediation.*",
    )


# -- sources and sinks -----------------------------------------------------


@query("src1_read_flows_csv")
def _(spark, sf):
    path = tables.write_flows_csv(_dirty(spark, sf), new_path(spark, "flows-csv"))
    return tables.read_flows_csv(spark, path)


@query("src2_flows_csv_round_trip")
def _(spark, sf):
    path = tables.write_flows_csv(_flows(spark, sf), new_path(spark, "flows-csv"))
    return tables.read_flows_csv(spark, path)


@query("src3_read_raw_cidds_csv")
def _(spark, sf):
    path = new_path(spark, "cidds-csv")
    stored_view(spark, sf, "raw_cidds").write.option("header", True).csv(path)
    return convert.project_cidds(tables.read_raw_csv(spark, path))


@query("src4_read_raw_cic_csv")
def _(spark, sf):
    path = new_path(spark, "cic-csv")
    raw = stored_view(spark, sf, "raw_cic")
    raw.write.option("header", True).option("ignoreLeadingWhiteSpace", False).option(
        "ignoreTrailingWhiteSpace", False
    ).csv(path)
    return convert.project_cic(tables.read_raw_csv(spark, path))


@query("src5_6_model_save_load")
def _(spark, sf):
    path = save_model(spark, frozen_model(), new_path(spark, "model"))
    model = load_model(spark, path)
    scored = pipeline.score_flows(model, _flows(spark, sf))
    return scored.select("flow_id", F.round("raw_score", 6).alias("raw_score"), "is_alert")


@query("src7_9_metrics_json")
def _(spark, sf):
    doc = evaluate.evaluate_detection(_scored(spark, sf), THRESHOLD)
    return _metrics_row(tables.read_metrics(spark, tables.write_json(doc, new_path(spark, "metrics"))))


@query("src8_alerts_json")
def _(spark, sf):
    alerts = triage.create_alerts(_frozen_flagged(spark, sf), RUN_DATE)
    path = tables.write_json(alerts, new_path(spark, "alerts"))
    return _flat_alerts(tables.read_alerts(spark, path, alerts.schema))


@query("src10_user_csv_feed")
def _(spark, sf):
    path = tables.write_flows_csv(_dirty(spark, sf), new_path(spark, "user-csv"))
    feed = tables.read_flows_csv(spark, path, strict_ip=True)
    return feed.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.sum("byte_count").alias("bytes"))


@query("src11_export_alert")
def _(spark, sf):
    flow_id = reports.most_anomalous(_scored(spark, sf)).first()["flow_id"]
    explained = explain.explain_flows(
        frozen_attributions(spark, sf).where(F.col("flow_id") == flow_id), frozen_model().forest.threshold
    )
    out = tables.export_alert(triage.create_alerts(explained, RUN_DATE), flow_id)
    return out.select(
        "flow_id",
        F.get_json_object("alert_json", "$.severity").alias("severity"),
        F.get_json_object("alert_json", "$.network_traffic.src_ip").alias("src_ip"),
        F.get_json_object("alert_json", "$.network_traffic.dest_port").alias("dest_port"),
        F.get_json_object("alert_json", "$.fusion_threat_intel.mitre_technique_id").alias("technique"),
    )


# -- validation ------------------------------------------------------------


@query("val1_schema_check")
def _(spark, sf):
    checked = validate.validate_schema(_dirty(spark, sf))
    return checked.agg(F.count(F.lit(1)).alias("n_rows"))


@query("val2_drop_incomplete")
def _(spark, sf):
    return validate.drop_incomplete(_dirty(spark, sf)).select("flow_id", "src_ip", "dst_ip", "byte_count")


@query("val3_keep_in_range")
def _(spark, sf):
    kept = _dirty(spark, sf).transform(validate.drop_incomplete).transform(validate.keep_in_range)
    return kept.select("flow_id", "src_port", "dst_port", "packet_count", "flow_duration")


@query("val4_cast_types")
def _(spark, sf):
    kept = _dirty(spark, sf).transform(validate.drop_incomplete).transform(validate.keep_in_range)
    return validate.cast_types(kept).select(
        "flow_id", "src_port", "dst_port", "packet_count", "byte_count", "protocol", "tcp_flags"
    )


@query("val5_clean")
def _(spark, sf):
    return validate.validate_and_clean(_dirty(spark, sf))


@query("val6_rejections")
def _(spark, sf):
    return validate.rejection_counts(_dirty(spark, sf))


@query("val6_rejected_lines")
def _(spark, sf):
    bad = F.when(F.col("dst_port") == 53, F.lit("abc")).otherwise(F.col("dst_port").cast("string"))
    path = tables.write_flows_csv(_dirty(spark, sf).withColumn("dst_port", bad), new_path(spark, "odd-csv"))
    _, rejected = tables.read_flows_csv_checked(spark, path)
    out = tables.write_rejected(rejected, new_path(spark, "rejected"))
    kept = F.count(F.when(F.col("line").contains("abc"), 1))
    return spark.read.parquet(out).groupBy("reason").agg(F.count("*").alias("n_rows"), kept.alias("n_abc"))


@query("val7_strict_ip")
def _(spark, sf):
    return validate.validate_and_clean(_dirty(spark, sf), strict_ip=True)


# -- conversion ------------------------------------------------------------


@query("cnv1_headers")
def _(spark, sf):
    raw = stored_view(spark, sf, "raw_cic")
    named = convert.normalise_headers(raw, convert.CIC_HEADERS)
    return named.select("timestamp", "src_ip", "dst_ip", "label")


@query("cnv2_numbers")
def _(spark, sf):
    raw = convert.normalise_headers(stored_view(spark, sf, "raw_cidds"), convert.CIDDS_HEADERS)
    return raw.select(
        F.coalesce(to_number(F.col("flow_duration")), F.lit(0.0)).alias("flow_duration"),
        *[to_whole(F.col(c), d).alias(c) for c, d in (("src_port", 0), ("dst_port", 0), ("packet_count", 1))],
    )


@query("cnv3_letter_flags")
def _(spark, sf):
    raw = stored_view(spark, sf, "raw_cidds")
    parsed = raw.select(parse_letter_flags(F.col("Flags")).alias("tcp_flags"), "Flags")
    return parsed.groupBy(F.col("Flags").alias("raw_flags"), "tcp_flags").agg(F.count(F.lit(1)).alias("n"))


@query("cnv4_byte_sizes")
def _(spark, sf):
    raw = stored_view(spark, sf, "raw_cidds")
    return raw.select(F.col("Bytes").alias("raw_bytes"), parse_byte_size(F.col("Bytes")).alias("byte_count"))


@query("cnv5_cidds_labels")
def _(spark, sf):
    raw = stored_view(spark, sf, "raw_cidds")
    label = convert.cidds_label(F.col("attackType"))
    return raw.groupBy(label.alias("label")).agg(F.count(F.lit(1)).alias("n"))


@query("cnv6_convert_cidds")
def _(spark, sf):
    return convert.convert_cidds(stored_view(spark, sf, "raw_cidds")).drop("flow_id")


@query("cnv7_cic_duration")
def _(spark, sf):
    converted = convert.project_cic(stored_view(spark, sf, "raw_cic"))
    return converted.select("timestamp", "src_ip", "dst_ip", "flow_duration")


@query("cnv8_protocol_numbers")
def _(spark, sf):
    raw = stored_view(spark, sf, "raw_cic")
    name = protocol_name(to_whole(F.col("Protocol"), 6))
    return raw.groupBy(F.col("Protocol").alias("number"), name.alias("protocol")).agg(F.count(F.lit(1)).alias("n"))


@query("cnv9_sum_directions")
def _(spark, sf):
    converted = convert.project_cic(stored_view(spark, sf, "raw_cic"))
    return converted.select("timestamp", "src_ip", "dst_ip", "packet_count", "byte_count")


@query("cnv10_count_flags")
def _(spark, sf):
    converted = convert.project_cic(stored_view(spark, sf, "raw_cic"))
    return converted.groupBy("tcp_flags").agg(F.count(F.lit(1)).alias("n"))


@query("cnv11_cic_labels")
def _(spark, sf):
    raw = stored_view(spark, sf, "raw_cic")
    label = convert.cic_label(F.col("` Label`"))
    return raw.groupBy(F.col("` Label`").alias("raw_label"), label.alias("label")).agg(F.count(F.lit(1)).alias("n"))


@query("cnv12_convert_cic")
def _(spark, sf):
    return convert.convert_cic(stored_view(spark, sf, "raw_cic")).drop("flow_id")


@query("cnv13_flow_ids")
def _(spark, sf):
    ids = with_flow_id(convert.project_cidds(stored_view(spark, sf, "raw_cidds")), "CIDDS").select("flow_id")
    per_id = ids.groupBy("flow_id").agg(F.count(F.lit(1)).alias("n"))
    return per_id.agg(
        F.sum("n").alias("n_rows"),
        F.count(F.lit(1)).alias("n_ids"),
        F.count_if(F.col("flow_id").rlike("^CIDDS-[0-9a-f]{24}-[0-9]+$")).alias("n_wellformed"),
        F.count_if(~F.col("flow_id").endswith("-0")).alias("n_copies"),
    )


@query("cnv14_missing_columns")
def _(spark, sf):
    raw = stored_view(spark, sf, "raw_cidds").drop("Date first seen", "Flags", "Tos", "attackType", "class")
    return convert.project_cidds(raw)


@query("cnv14_missing_columns_cic")
def _(spark, sf):
    raw = stored_view(spark, sf, "raw_cic").select(" Flow Duration", "Total Fwd Packets", "Total Length of Fwd Packets")
    return convert.project_cic(raw)


# -- features and scaling --------------------------------------------------


def _feature_query(*names: str) -> Query:
    def run(spark, sf):
        exprs = feature_columns()
        return _rounded(_flows(spark, sf).select("flow_id", *[exprs[n].alias(n) for n in names]))

    return run


for _i, _name in enumerate(NUMERIC_FEATURES, 1):
    query(f"fea{_i}_{_name}")(_feature_query(_name))
query("fea9_14_flags")(_feature_query(*FLAG_FEATURES[:6]))
query("fea15_is_syn_only")(_feature_query("is_syn_only"))
query("fea16_18_src_port_bands")(_feature_query(*FLAG_FEATURES[7:10]))
query("fea19_21_dst_port_bands")(_feature_query(*FLAG_FEATURES[10:13]))
query("fea22_24_protocols")(_feature_query(*FLAG_FEATURES[13:]))


@query("fea_all_features")
def _(spark, sf):
    return _rounded(extract_features(_flows(spark, sf), keep=["flow_id"]))


def _benign(spark, sf):
    return _flows(spark, sf).where(F.col("label") == BENIGN)


@query("scl1_robust_fit")
def _(spark, sf):
    return _rounded(FlowScaler("robust").fit(_benign(spark, sf)).table(spark))


@query("scl2_standard_fit")
def _(spark, sf):
    return _rounded(FlowScaler("standard").fit(_benign(spark, sf)).table(spark))


@query("scl3_transform")
def _(spark, sf):
    scaler = FlowScaler("robust").fit(_benign(spark, sf))
    return _rounded(scaler.transform(_flows(spark, sf), keep=["flow_id"]))


@query("scl5_fit_transform")
def _(spark, sf):
    return _rounded(FlowScaler("standard").fit_transform(_benign(spark, sf)))


# -- model -----------------------------------------------------------------


@query("mdl1_tree_samples")
def _(spark, sf):
    base = pipeline.prepare(_split(spark, sf)[0])
    sample = sample_per_tree(base.select("row_key"), "row_key", ForestConfig())
    return sample.groupBy("tree_id").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("row_key").alias("n_distinct")
    )


@query("mdl2_tree_invariants")
def _(spark, sf):
    nodes = forest_table(spark, trained_model(spark, sf).forest)
    leaf = F.col("feature") < 0
    return nodes.groupBy("tree_id").agg(
        F.sum(F.when(leaf, F.col("n"))).alias("leaf_rows"),
        (F.max("depth") <= 8).cast("int").alias("depth_ok"),
        (F.count_if(leaf) == F.count_if(~leaf) + 1).cast("int").alias("binary_ok"),
    )


@query("mdl3_path_length")
def _(spark, sf):
    forest = frozen_model().forest
    features = with_features(_flows(spark, sf))
    return features.select("flow_id", F.round(forest.path_length(), 6).alias("path_length"))


@query("mdl4_raw_score")
def _(spark, sf):
    forest = frozen_model().forest
    scored = forest.compute_raw_scores(with_features(_flows(spark, sf)))
    return scored.select("flow_id", F.round("raw_score", 6).alias("raw_score"))


@query("mdl5_score_range")
def _(spark, sf):
    forest = frozen_model().forest
    scored = forest.compute_raw_scores(with_features(_benign(spark, sf)))
    low, high = F.min("raw_score"), F.max("raw_score")
    return scored.agg(
        F.round(low, 6).alias("score_min"),
        F.round(F.when(high > low, high).otherwise(low + 1e-6), 6).alias("score_max"),
    )


@query("mdl6_anomaly_score")
def _(spark, sf):
    forest = frozen_model().forest
    scored = forest.compute_anomaly_scores(with_features(_flows(spark, sf)))
    return scored.select("flow_id", F.round("anomaly_score", 6).alias("anomaly_score"))


@query("mdl7_default_threshold")
def _(spark, sf):
    value = default_threshold(_scored(spark, sf).where(F.col("label") == BENIGN))
    return spark.createDataFrame([(value,)], "threshold double").select(F.round("threshold", 6).alias("threshold"))


@query("mdl8_fpr_threshold")
def _(spark, sf):
    benign = _scored(spark, sf).where(F.col("label") == BENIGN).select("anomaly_score")
    rows = [(fpr, calibrate_threshold(benign, fpr)) for fpr in (0.01, 0.02, 0.03, 0.08)]
    return _rounded(spark.createDataFrame(rows, "target_fpr double, threshold double"))


@query("mdl9_predict")
def _(spark, sf):
    return flag_alerts(_scored(spark, sf), THRESHOLD).select("flow_id", "anomaly_score", "is_alert")


@query("mdl_trained_scores")
def _(spark, sf):
    """Quality of the trained forest: invariants that must hold, no exact values."""
    scored = scored_evaluation(spark, sf)
    quality = evaluate.ranking_quality(evaluate.score_curve(scored))
    bounds = scored.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("anomaly_score").between(0, 1)).alias("in_range"),
    )
    return bounds.select(
        "n",
        "in_range",
        (quality.select("auroc").scalar() > 0.85).cast("int").alias("auroc_ok"),
    )


# -- attribution -----------------------------------------------------------


@query("xai1_baseline_statistics")
def _(spark, sf):
    return _rounded(explain.baseline_statistics(_benign(spark, sf)), 4)


@query("xai2_attributions")
def _(spark, sf):
    long = long_attributions(frozen_attributions(spark, sf), ["flow_id"])
    return long.select("flow_id", "feature", F.round("phi", 6).alias("phi"))


@query("xai2_local_accuracy")
def _(spark, sf):
    """Attributions plus base value equal minus the path length, on every flagged flow."""
    model = trained_model(spark, sf)
    explainer = FlowExplainer(model.forest)
    flagged = scored_evaluation(spark, sf).where(F.col("is_alert") == 1)
    attributed = explainer.compute_anomaly_shap(model.scaler.with_scaled(flagged)).withColumn(
        "path", model.forest.path_length()
    )
    total = F.aggregate("phi", F.lit(explainer.base_value), lambda acc, v: acc + v)
    return attributed.agg(F.count_if(F.abs(total + F.col("path")) > 1e-9).alias("n_violations"))


@query("xai3_base_value")
def _(spark, sf):
    explainer = FlowExplainer(frozen_model().forest)
    total = F.aggregate("phi", F.lit(explainer.base_value), lambda acc, v: acc + v)
    return frozen_attributions(spark, sf).select("flow_id", F.round(-total, 6).alias("path_length"))


@query("xai4_importance")
def _(spark, sf):
    return _rounded(feature_importance(frozen_attributions(spark, sf)))


@query("xai5_top_drivers")
def _(spark, sf):
    # Spark would put a filter on the size of a plain column here, which finds the drivers twice.
    known = F.filter("top_drivers", lambda d: d.isNotNull())
    drivers = frozen_explanations(spark, sf).select("flow_id", F.posexplode(known).alias("position", "d"))
    return drivers.select("flow_id", "position", "d.feature", "d.shap_contribution", "d.scaled_value")


@query("xai6_raw_values")
def _(spark, sf):
    attributed = frozen_attributions(spark, sf)
    explained = explain.explain_flows(
        attributed, frozen_model().forest.threshold, raw_features=[F.col(c) for c in FEATURES]
    )
    drivers = explained.select("flow_id", F.explode("top_drivers").alias("d"))
    return drivers.select("flow_id", "d.feature", F.round("d.raw_value", 6).alias("raw_value"))


@query("xai7_narrative")
def _(spark, sf):
    return frozen_explanations(spark, sf).select("flow_id", "narrative")


@query("xai8_explanations")
def _(spark, sf):
    explained = frozen_explanations(spark, sf)
    return explained.select("flow_id", "anomaly_score", "is_alert", F.size("top_drivers").alias("n_drivers"))


@query("xai10_waterfall")
def _(spark, sf):
    base = FlowExplainer(frozen_model().forest).base_value
    rows = explain.waterfall(frozen_attributions(spark, sf), base)
    return rows.select(
        "flow_id", "position", "feature", F.round(F.col("phi") + 0.0, 6).alias("phi"), F.round("running_total", 6).alias("running_total")
    )


# -- evaluation ------------------------------------------------------------


@query("evl1_binarise")
def _(spark, sf):
    return flag_alerts(_scored(spark, sf), THRESHOLD).groupBy("is_anomaly", "is_alert").agg(
        F.count(F.lit(1)).alias("n")
    )


@query("evl2_confusion")
def _(spark, sf):
    return evaluate.confusion(_scored(spark, sf), THRESHOLD)


@query("evl3_rates")
def _(spark, sf):
    return evaluate.rounded_rates(evaluate.confusion(_scored(spark, sf), THRESHOLD))


@query("evl4_auroc")
def _(spark, sf):
    return _rounded(evaluate.ranking_quality(evaluate.score_curve(_scored(spark, sf))).select("auroc"))


@query("evl5_average_precision")
def _(spark, sf):
    quality = evaluate.ranking_quality(evaluate.score_curve(_scored(spark, sf)))
    return _rounded(quality.select("average_precision"))


@query("evl6_daily_alerts")
def _(spark, sf):
    return evaluate.operational_impact(evaluate.confusion(_scored(spark, sf), THRESHOLD))


@query("evl7_per_attack")
def _(spark, sf):
    return evaluate.per_attack_recall(_scored(spark, sf), THRESHOLD)


@query("evl8_tradeoff")
def _(spark, sf):
    return evaluate.tradeoff_curve(_scored(spark, sf))


@query("evl9_roc_points")
def _(spark, sf):
    points = evaluate.roc_points(evaluate.score_curve(_scored(spark, sf)))
    # The origin has an infinite threshold; show it as null for comparison.
    threshold = F.when(F.col("threshold") <= 1.0, F.col("threshold"))
    return _rounded(points.withColumn("threshold", threshold))


@query("evl10_pr_points")
def _(spark, sf):
    return _rounded(evaluate.pr_points(evaluate.score_curve(_scored(spark, sf))))


@query("evl11_no_skill")
def _(spark, sf):
    return _rounded(evaluate.no_skill_precision(_scored(spark, sf)))


@query("evl12_metrics")
def _(spark, sf):
    return _metrics_row(evaluate.evaluate_detection(_scored(spark, sf), THRESHOLD))


@query("evl13_confusion_cells")
def _(spark, sf):
    return evaluate.confusion_cells(evaluate.confusion(_scored(spark, sf), THRESHOLD))


# -- triage ----------------------------------------------------------------

_CONTEXT = ["flow_id", "technique_id", "technique_name", "tactic", "base_severity", "playbook"]


def _frozen_flagged(spark, sf):
    return frozen_explanations(spark, sf).where(F.col("is_alert") == 1)


@query("tri1_label_context")
def _(spark, sf):
    return triage.with_threat_context(_flows(spark, sf).where(F.col("label") != BENIGN)).select(*_CONTEXT)


@query("tri2_inferred_context")
def _(spark, sf):
    joined = triage.with_threat_context(_flows(spark, sf), use_label=False)
    return joined.select("flow_id", F.coalesce("archetype", F.lit("none")).alias("archetype"), "technique_id")


@query("tri3_fallback_context")
def _(spark, sf):
    joined = triage.with_threat_context(_flows(spark, sf))
    return joined.groupBy(*_CONTEXT[1:]).agg(F.count(F.lit(1)).alias("n"))


@query("tri4_severity")
def _(spark, sf):
    joined = triage.with_threat_context(_scored(spark, sf))
    level = triage.severity(F.round("anomaly_score", 4), F.col("base_severity"))
    return joined.select("flow_id", level.alias("severity"))


@query("tri5_alerts")
def _(spark, sf):
    return _flat_alerts(triage.create_alerts(_frozen_flagged(spark, sf), RUN_DATE))


@query("tri6_alert_ids")
def _(spark, sf):
    ids = triage.create_alerts(_frozen_flagged(spark, sf), RUN_DATE).select("alert_id", "vendor_product")
    per_id = ids.groupBy("alert_id").agg(F.count(F.lit(1)).alias("n"), F.count("vendor_product").alias("v"))
    return per_id.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_alerts"),
        F.count(F.lit(1)).alias("n_ids"),
        F.count_if(F.col("alert_id").rlike("^ALT-20260920-[0-9a-f]{16}$")).alias("n_wellformed"),
    )


@query("tri7_alert_batch")
def _(spark, sf):
    explanations = frozen_explanations(spark, sf).select(
        "flow_id", "anomaly_score", "is_alert", "top_drivers", "narrative"
    )
    alerts = triage.generate_alerts_batch(_flows(spark, sf), explanations, run_date=RUN_DATE)
    return _flat_alerts(alerts)


@query("tri8_containment")
def _(spark, sf):
    return _flows(spark, sf).select("flow_id", triage.containment(F.col("src_ip")).alias("suggested_containment"))


# -- reports ---------------------------------------------------------------


@query("qry1_kpis")
def _(spark, sf):
    return _rounded(reports.kpis(_scored(spark, sf), THRESHOLD))


@query("qry2_presets")
def _(spark, sf):
    scored = _scored(spark, sf)
    frames = [
        reports.apply_threshold(scored, reports.preset_threshold(p, 0.687))
        .agg(F.sum("is_alert").cast("bigint").alias("flagged"))
        .select(F.lit(p).alias("preset"), "flagged")
        for p in ("calibrated", "balanced", "high_recall")
    ]
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


@query("qry3_scored_view")
def _(spark, sf):
    return reports.scored_view(_scored(spark, sf), THRESHOLD).select("flow_id", "anomaly_score", "status")


@query("qry4_incident_queue")
def _(spark, sf):
    return reports.incident_queue(_scored(spark, sf), THRESHOLD).select("flow_id", "anomaly_score", "label")


@query("qry5_queue_labels")
def _(spark, sf):
    return reports.queue_labels(_scored(spark, sf), THRESHOLD)


@query("qry6_queue_by_label")
def _(spark, sf):
    return reports.incident_queue(_scored(spark, sf), THRESHOLD, "port_scan").select("flow_id", "anomaly_score")


@query("qry7_queue_page")
def _(spark, sf):
    return reports.queue_page(_scored(spark, sf), THRESHOLD)


@query("qry8_inspect_flow")
def _(spark, sf):
    flow_id = reports.most_anomalous(_scored(spark, sf)).first()["flow_id"]
    chosen = reports.find_flow(frozen_attributions(spark, sf), flow_id)
    explained = explain.explain_flows(chosen, frozen_model().forest.threshold)
    return _flat_alerts(triage.create_alerts(explained, RUN_DATE))


@query("qry9_attack_table")
def _(spark, sf):
    return reports.per_attack_table(_scored(spark, sf), THRESHOLD)


@query("qry10_flagged_share")
def _(spark, sf):
    return _rounded(reports.flagged_share(_scored(spark, sf), THRESHOLD))


@query("qry11_most_anomalous")
def _(spark, sf):
    return reports.most_anomalous(_scored(spark, sf)).select("flow_id", "anomaly_score", "label")


@query("qry12_top_flagged")
def _(spark, sf):
    return reports.top_flagged(_scored(spark, sf), THRESHOLD).select("flow_id", "anomaly_score", "label")


@query("qry13_attack_share")
def _(spark, sf):
    return _rounded(reports.attack_share(_flows(spark, sf)))


@query("qry14_label_counts")
def _(spark, sf):
    return reports.label_counts(_flows(spark, sf))


@query("qry15_column_summary")
def _(spark, sf):
    scaler = FlowScaler("robust").fit(_benign(spark, sf))
    return reports.column_summary(scaler.transform(_benign(spark, sf)), NUMERIC_FEATURES)


@query("qry16_box_statistics")
def _(spark, sf):
    exprs = feature_columns()
    measures = ["bytes_per_packet", "packets_per_second"]
    narrow = validate.validate_and_clean(_flows(spark, sf)).select("label", *[exprs[m].alias(m) for m in measures])
    return _rounded(reports.box_statistics(narrow, measures))


@query("qry17_score_density")
def _(spark, sf):
    return reports.score_density(_scored(spark, sf))


@query("qry18_split")
def _(spark, sf):
    base, evaluation = _split(spark, sf)

    def count(df, name):
        return df.agg(F.count(F.lit(1)).alias("n"), F.sum("is_anomaly").cast("bigint").alias("attacks")).select(
            F.lit(name).alias("split"), "n", "attacks"
        )

    return count(base, "baseline").unionByName(count(evaluation, "evaluation"))


@query("qry19_bounded_sample")
def _(spark, sf):
    sample = reports.bounded_sample(scored_evaluation(spark, sf), key="row_key")
    model = trained_model(spark, sf)
    attributed = FlowExplainer(model.forest).compute_anomaly_shap(model.scaler.with_scaled(sample))
    return feature_importance(attributed)


@query("qry19_sample_size")
def _(spark, sf):
    sample = reports.bounded_sample(_flows(spark, sf))
    return sample.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("flow_id").alias("n_distinct"))


@query("qry20_benchmark_counts")
def _(spark, sf):
    """Rows and attack classes that reach the evaluation, for both layouts."""
    frames = []
    for layout, view in (("cidds-001", "raw_cidds"), ("cic-ids2017", "raw_cic")):
        doc = benchmark.evaluate_benchmark(trained_model(spark, sf), stored_view(spark, sf, view), layout)
        total = sum((F.col(f"confusion_matrix.{c}") for c in ("true_negatives", "false_positives", "false_negatives")), F.col("confusion_matrix.true_positives"))
        frames.append(
            doc.select(
                F.lit(layout).alias("layout"),
                total.alias("n_rows"),
                F.explode("per_attack_recall").alias("label", "r"),
            ).select("layout", "n_rows", "label", F.col("r.count").alias("n_label"))
        )
    return frames[0].unionByName(frames[1])


@query("qry20_benchmark_cidds")
def _(spark, sf):
    doc = benchmark.evaluate_benchmark(trained_model(spark, sf), stored_view(spark, sf, "raw_cidds"), "cidds-001")
    return _metrics_row(doc)


@query("qry20_benchmark_cic")
def _(spark, sf):
    doc = benchmark.evaluate_benchmark(trained_model(spark, sf), stored_view(spark, sf, "raw_cic"), "cic-ids2017")
    return _metrics_row(doc)


@query("qry20_benchmark_frozen")
def _(spark, sf):
    doc = benchmark.evaluate_benchmark(frozen_model(), stored_view(spark, sf, "raw_cic"), "cic-ids2017")
    return _metrics_row(doc)


@query("qry21_pipeline")
def _(spark, sf):
    base, evaluation = _split(spark, sf)
    result = pipeline.run_pipeline(base, evaluation, run_date=RUN_DATE, max_alerts=None)
    return _flat_alerts(result.alerts)


@query("qry21_pipeline_frozen")
def _(spark, sf):
    """The whole pipeline with a ready model: alerts of all flagged flows of the evaluation split."""
    base, evaluation = _split(spark, sf)
    result = pipeline.run_pipeline(base, evaluation, run_date=RUN_DATE, max_alerts=None, model=frozen_model())
    return _flat_alerts(result.alerts)


@query("qry20_benchmark_cidds_frozen")
def _(spark, sf):
    return _metrics_row(benchmark.evaluate_benchmark(frozen_model(), stored_view(spark, sf, "raw_cidds"), "cidds-001"))


@query("qry21_acceptance")
def _(spark, sf):
    """Bounds that the trained pipeline must keep, at a false-positive budget of 8 %."""
    model, scored = trained_model(spark, sf), scored_evaluation(spark, sf)
    baseline = pipeline.score_flows(model, pipeline.prepare(_split(spark, sf)[0], unique_ids=True))
    cut = calibrate_threshold(materialize(baseline.select("anomaly_score"), "baseline-scores"), 0.08)
    doc = evaluate.evaluate_detection(scored, cut)
    return doc.select(
        (F.col("auroc") > 0.85).cast("int").alias("auroc_ok"),
        (F.col("recall") >= 0.5).cast("int").alias("recall_ok"),
        (F.abs(F.col("false_positive_rate") - 0.08) <= 0.02).cast("int").alias("fpr_ok"),
        (F.col("confusion_matrix.true_negatives") + F.col("confusion_matrix.false_positives")).alias("n_benign"),
        (F.col("confusion_matrix.true_positives") + F.col("confusion_matrix.false_negatives")).alias("n_attacks"),
    )


@query("qry22_append_rows")
def _(spark, sf):
    base, evaluation = _split(spark, sf)
    return reports.append_rows(base, evaluation).groupBy("label").agg(F.count(F.lit(1)).alias("n"))


# -- streaming -------------------------------------------------------------


@query("ext1_stream_alerts")
def _(spark, sf):
    """The frozen model over the flow files as a stream; same alerts as the batch."""
    incoming = new_path(spark, "stream-in")
    unclean = {"src_port", "dst_port", "packet_count", "byte_count"}
    flows = _flows(spark, sf).select(*[F.col(c).cast("double").alias(c) if c in unclean else c for c in FLOW_COLUMNS])
    flows.write.parquet(incoming)
    alerts = alert_stream(frozen_model(), read_flow_stream(spark, incoming, files_per_batch=4), RUN_DATE)
    out = new_path(spark, "stream-out")
    write_alert_stream(alerts, out, new_path(spark, "stream-state")).awaitTermination()
    return _flat_alerts(tables.read_alerts(spark, out, alerts.schema))


@query("ext2_windowed_alerts")
def _(spark, sf):
    """Alerts of the frozen model per source address and window, counted on a stream of flow files."""
    incoming = new_path(spark, "stream-in")
    unclean = {"src_port", "dst_port", "packet_count", "byte_count"}
    flows = _flows(spark, sf).select(*[F.col(c).cast("double").alias(c) if c in unclean else c for c in FLOW_COLUMNS])
    flows.write.parquet(incoming)
    scored = pipeline.score_flows(frozen_model(), read_flow_stream(spark, incoming, files_per_batch=4))
    counts = windowed_alerts(scored, size="1 hour", delay="3650 days")
    out = new_path(spark, "window-counts")
    write_window_counts(counts, out, new_path(spark, "window-state")).awaitTermination()
    return _rounded(read_window_counts(spark, out)).select(
        F.date_format("window_start", "yyyy-MM-dd HH:mm").alias("window_start"), "src_ip", "alerts", "targets", "top_score"
    )


__all__ = ["QUERIES", "IsolationForest", "frozen_attributions", "scored_evaluation", "trained_model"]
