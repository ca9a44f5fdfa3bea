"""Time the headline jobs and print one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
The derived flow tables are written before the clock starts; each job then reads
them from files and sends its whole result to the noop sink.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowsift.operators import convert, evaluate, reports, validate
from flowsift.operators.features import extract_features
from flowsift.operators.scaling import FlowScaler
from flowsift.plans import catalog, pipeline
from flowsift.schema import NUMERIC_FEATURES
from flowsift.session import tune
from flowsift.fixtures.views import stored_view
from flowsift.storage import release

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")


def drain(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    tune(spark)
    started = time.perf_counter()
    view = {n: stored_view(spark, SF_DIR, n) for n in ("flows", "flows_dirty", "raw_cidds", "raw_cic", "scored_surrogate")}
    base, evaluation = catalog._split(spark, SF_DIR)
    prepared = time.perf_counter() - started
    flows, scored = view["flows"], view["scored_surrogate"]
    state: dict = {}

    def train() -> None:
        state["model"] = pipeline.train_model(pipeline.prepare(base))

    def score() -> None:
        table = pipeline.score_flows(state["model"], pipeline.prepare(evaluation))
        state["scored"] = pipeline.materialize(table, "bench-scored")

    def trained_metrics() -> None:
        drain(evaluate.evaluate_detection(state["scored"], state["model"].forest.threshold))

    features = ["bytes_per_packet", "packets_per_second"]
    jobs = {
        "clean": lambda: drain(validate.validate_and_clean(view["flows_dirty"])),
        "convert_cidds": lambda: drain(convert.convert_cidds(view["raw_cidds"])),
        "convert_cic": lambda: drain(convert.convert_cic(view["raw_cic"])),
        "features": lambda: drain(extract_features(flows, keep=["flow_id"])),
        "robust_scaler": lambda: FlowScaler("robust").fit(base),
        "train": train,
        "score": score,
        "metrics": trained_metrics,
        "explain_all_flagged": lambda: drain(pipeline.alerts_for(state["model"], state["scored"])),
        "auroc_ap": lambda: drain(evaluate.ranking_quality(evaluate.score_curve(scored))),
        "tradeoff": lambda: drain(evaluate.tradeoff_curve(scored)),
        "per_attack": lambda: drain(evaluate.per_attack_recall(scored, 0.5)),
        "queue_page": lambda: drain(reports.queue_page(scored, 0.5)),
        "box_statistics": lambda: drain(
            reports.box_statistics(extract_features(flows, keep=["label"]).select("label", *features), features)
        ),
        "column_summary": lambda: drain(
            reports.column_summary(extract_features(flows).select(*NUMERIC_FEATURES), NUMERIC_FEATURES)
        ),
    }
    # One small job starts the Python workers and the compiler.
    drain(flows.limit(1).select(F.pandas_udf(lambda s: s, "string")("flow_id")))
    times = {}
    for name, job in jobs.items():
        start = time.perf_counter()
        job()
        times[name] = round(time.perf_counter() - start, 3)
    rows = flows.count()
    release(spark)
    print(
        json.dumps(
            {
                "metric": "flow_analytics_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                "rows": rows,
                "prepare_sec": round(prepared, 3),
            }
        )
    )


if __name__ == "__main__":
    main()
