"""Flow views derived from the ``lineitem`` table: narrow projections with the text of ``profiles``.

A column that a query does not use is never computed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowsift.fixtures.profiles import STEPS
from flowsift.functions.features import feature_columns
from flowsift.schema import FLOW_COLUMNS
from flowsift.storage import materialize

def _by_class(cases: dict[int, Column], otherwise: Column | None = None) -> Column:
    (first, value), *rest = cases.items()
    expr = F.when(F.col("a") == first, value)
    for code, value in rest:
        expr = expr.when(F.col("a") == code, value)
    return expr if otherwise is None else expr.otherwise(otherwise)


def _text(*parts) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


_VIEWS: dict[tuple[str, str, str], DataFrame] = {}


def stored_view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A derived view as a Parquet table, written once per session.

    Flows arrive as stored tables in practice. Reading them back from files gives
    the operators the same input: column pruning and filters reach the scan, and
    the derivation is not repeated by every query.
    """
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _VIEWS:
        _VIEWS[key] = materialize(VIEWS[name](spark, sf_dir), name)
    return _VIEWS[key]


# Tasks per core from which a scan is left as it is, and how much of an even share its largest may hold.
_TASKS_PER_CORE, _UNEVEN = 4, 2


def _evenly_split(lines: DataFrame) -> bool:
    """Whether the scan itself gives every core several tasks of much the same size.

    Rows per split come from the footers: no column is read.
    """
    cores = lines.sparkSession.sparkContext.defaultParallelism
    splits, rows, most = (
        lines.groupBy(F.spark_partition_id()).count().agg(F.count(F.lit(1)), F.sum("count"), F.max("count")).first()
    )
    return splits >= _TASKS_PER_CORE * cores and most <= _UNEVEN * rows / splits


def _derived(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All columns of the derivation over ``lineitem``."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    cores = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # A file of one row group would be expanded by one task; the key columns are few and narrow.
    rows = lines.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice", "l_quantity", "l_shipdate")
    if not _evenly_split(lines):
        rows = rows.repartition(cores)
    for step in STEPS:
        rows = rows.withColumns({name: F.expr(text) for name, text in step.items()})
    return rows


def flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flow table in the standard schema."""
    return _derived(spark, sf_dir).select(*FLOW_COLUMNS)


def flows_with_order_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flow table plus ``order_key``, used to split baseline from evaluation."""
    return _derived(spark, sf_dir).select(*FLOW_COLUMNS, F.col("k").alias("order_key"))


def flows_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flows with faults: bad ports, zero packets, nulls, NaN, fractions."""
    base = _derived(spark, sf_dir)
    m = F.col("mix")

    def fault(modulus: int, value, column: Column) -> Column:
        return F.when(m % modulus == 0, F.lit(value)).otherwise(column)

    return base.select(
        "flow_id",
        "timestamp",
        F.when(m % 67 == 0, F.lit("10.0.0.999")).when(m % 61 == 0, F.lit(None)).otherwise(F.col("src_ip")).alias("src_ip"),
        "dst_ip",
        fault(97, -99.0, F.col("src_port").cast("double")).alias("src_port"),
        F.when(m % 101 == 0, F.lit(65535.5))
        .when(m % 73 == 0, F.col("dst_port") + F.lit(0.7))
        .otherwise(F.col("dst_port").cast("double"))
        .alias("dst_port"),
        F.when(m % 59 == 0, F.lower("protocol")).otherwise(F.col("protocol")).alias("protocol"),
        F.when(m % 79 == 0, F.lit(float("nan")))
        .when(m % 103 == 0, F.lit(-1.0))
        .otherwise(F.col("flow_duration"))
        .alias("flow_duration"),
        fault(89, 0.0, F.col("packet_count").cast("double")).alias("packet_count"),
        fault(83, None, F.col("byte_count").cast("double")).alias("byte_count"),
        fault(71, None, F.col("tcp_flags")).alias("tcp_flags"),
        "tos",
        "label",
        "is_anomaly",
    )


def raw_cidds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flows in the CIDDS-001 layout, all text, with the layout's odd values."""
    base = _derived(spark, sf_dir)
    m, b, flags = F.col("mix"), F.col("byte_count"), F.col("tcp_flags")
    size = (
        F.when(m % 97 == 0, F.lit(None))
        .when(m % 89 == 0, F.lit("n/a"))
        .when(b > 1000000, _text(F.floor(b / 1000000), ".", F.floor(b % 1000000 / 100000), " M"))
        .when(b > 10000, _text(F.floor(b / 1000), ".", F.floor(b % 1000 / 100), " K"))
        .otherwise(b.cast("string"))
    )
    letters = [("U", "URG"), ("A", "ACK"), ("P", "PSH"), ("R", "RST"), ("S", "SYN"), ("F", "FIN")]
    dotted = F.concat(*[F.when(flags.contains(name), F.lit(ch)).otherwise(F.lit(".")) for ch, name in letters])
    attack = _by_class(
        {
            2: F.when(F.col("e") % 2 == 0, F.lit("portScan")).otherwise(F.lit("pingScan")),
            3: F.lit(" dos "),
            4: F.lit("bruteForce"),
        },
        F.when(m % 7 == 0, F.lit("unknown")).otherwise(F.lit("---")),
    )
    text = {c: F.col(c).cast("string") for c in ("flow_duration", "src_port", "dst_port", "packet_count", "tos")}
    return base.select(
        F.col("timestamp").alias("Date first seen"),
        F.when(m % 79 == 0, F.lit("-")).otherwise(text["flow_duration"]).alias("Duration"),
        F.lower("protocol").alias("Proto"),
        F.col("src_ip").alias("Src IP Addr"),
        text["src_port"].alias("Src Pt"),
        F.col("dst_ip").alias("Dst IP Addr"),
        F.when(m % 73 == 0, F.lit("8.0")).otherwise(text["dst_port"]).alias("Dst Pt"),
        F.when(m % 71 == 0, F.lit("")).otherwise(text["packet_count"]).alias("Packets"),
        size.alias("Bytes"),
        F.when(m % 67 == 0, F.lit("0x5a"))
        .when(m % 61 == 0, F.lit(" "))
        .when(m % 59 == 0, F.lit("sf"))
        .when(m % 53 == 0, F.lit("01.1.0"))
        .otherwise(dotted)
        .alias("Flags"),
        text["tos"].alias("Tos"),
        F.when(F.col("is_anomaly") == 1, F.lit("attacker")).otherwise(F.lit("normal")).alias("class"),
        attack.alias("attackType"),
    )


def raw_cic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flows in the CIC-IDS2017 layout, all text, blanks in some headers."""
    base = _derived(spark, sf_dir)
    m, flags = F.col("mix"), F.col("tcp_flags")
    pk, b = F.col("packet_count"), F.col("byte_count")

    def half(x: Column) -> Column:
        return F.floor(x / 2)

    label = _by_class(
        {
            0: F.lit("Heartbleed"),
            1: F.lit("Bot"),
            2: F.when(m % 2 == 0, F.lit("PortScan")).otherwise(F.lit("custom port sweep")),
            3: F.when(m % 3 == 0, F.lit(" DoS Hulk ")).when(m % 3 == 1, F.lit("DDoS")).otherwise(F.lit("LDoS variant")),
            4: F.lit("SSH-Patator"),
        },
        F.lit("BENIGN"),
    )
    number = F.when(F.col("protocol") == "TCP", F.lit("6")).when(F.col("protocol") == "UDP", F.lit("17")).otherwise(F.lit("1"))

    def count_of(name: str) -> Column:
        seen = flags.contains(name).cast("int")
        return F.when((m % 43 == 0) & (seen == 1), F.lit("2")).otherwise(seen.cast("string"))

    return base.select(
        F.col("timestamp").alias(" Timestamp"),
        F.when(m % 79 == 0, F.lit("n/a")).otherwise((F.col("dur_ms") * 1000).cast("string")).alias(" Flow Duration"),
        F.col("src_ip").alias("Source IP"),
        F.col("src_port").cast("string").alias(" Source Port"),
        F.col("dst_ip").alias("Destination IP"),
        F.col("dst_port").cast("string").alias("Destination Port"),
        F.when(m % 73 == 0, F.lit("")).when(m % 71 == 0, F.lit("47")).otherwise(number).alias("Protocol"),
        half(pk).cast("string").alias("Total Fwd Packets"),
        (pk - half(pk)).cast("string").alias("Total Backward Packets"),
        half(b).cast("string").alias("Total Length of Fwd Packets"),
        (b - half(b)).cast("string").alias("Total Length of Bwd Packets"),
        *[count_of(x).alias(f"{x} Flag Count") for x in ("FIN", "SYN", "RST", "PSH", "ACK", "URG")],
        label.alias(" Label"),
    )


def scored_surrogate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flows with a score computed from the packet rate alone.

    Every operator downstream of a score takes any score column; this one lets
    SQL compute the same value.
    """
    log_pps = feature_columns()["log_pps"]
    base = stored_view(spark, sf_dir, "flows")
    return base.withColumn("anomaly_score", F.round(F.least(F.lit(1.0), log_pps / F.lit(12.0)), 4))


VIEWS = {
    "flows": flows,
    "flows_with_order_key": flows_with_order_key,
    "flows_dirty": flows_dirty,
    "raw_cidds": raw_cidds,
    "raw_cic": raw_cic,
    "scored_surrogate": scored_surrogate,
}
