"""SQL for the same results, to be run by another engine on the same tables."""

from __future__ import annotations

from flowsift.operators.forest import average_path
from flowsift.plans.frozen import PSI, SCORE_MAX, SCORE_MIN, THRESHOLD, TREES
from flowsift.plans.oracle_views import FLOW_LIST, features_cte, with_views
from flowsift.schema import FEATURES, FLAG_FEATURES, NUMERIC_FEATURES, THREATS, UNKNOWN_THREAT

SQL: dict[str, str] = {}
CUT = "0.5::DOUBLE"


def _num(x: float) -> str:
    return f"{x!r}::DOUBLE"


def _text(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def _cols(names) -> str:
    return ", ".join(f'"{n}"' for n in names)


# -- validation ------------------------------------------------------------

_CLEAN = f"SELECT {FLOW_LIST} FROM clean"
_STRICT = r"regexp_full_match(%s, '(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])(\.(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])){3}')"
_STRICT_BOTH = f"{_STRICT % 'src_ip'} AND {_STRICT % 'dst_ip'}"

SQL["val1_schema_check"] = with_views("SELECT count(*) AS n_rows FROM dirty", need="dirty")
SQL["val2_drop_incomplete"] = with_views("SELECT flow_id, src_ip, dst_ip, byte_count FROM complete", need="dirty")
SQL["val3_keep_in_range"] = with_views(
    "SELECT flow_id, src_port, dst_port, packet_count, flow_duration FROM ranged", need="dirty"
)
SQL["val4_cast_types"] = with_views(
    "SELECT flow_id, src_port, dst_port, packet_count, byte_count, protocol, tcp_flags FROM clean", need="dirty"
)
SQL["val5_clean"] = with_views(_CLEAN, need="dirty")
SQL["val6_rejected_lines"] = with_views(
    """
SELECT reason, count(*) AS n_rows, count(*) FILTER (reason = 'unreadable') AS n_abc FROM (
  SELECT CASE WHEN dst_port = 53 THEN 'unreadable'
              WHEN src_ip IS NULL OR dst_ip IS NULL THEN 'missing_ip'
              WHEN src_port IS NULL OR dst_port IS NULL THEN 'missing_port'
              WHEN byte_count IS NULL THEN 'missing_bytes'
              WHEN NOT (src_port BETWEEN 0 AND 65535 AND dst_port BETWEEN 0 AND 65535) THEN 'port_out_of_range'
              WHEN byte_count < 0 THEN 'negative_bytes'
              WHEN packet_count IS NULL OR packet_count < 1 THEN 'no_packets'
              WHEN flow_duration IS NULL OR isnan(flow_duration) OR flow_duration < 0 THEN 'bad_duration'
              ELSE 'accepted' END AS reason FROM dirty)
WHERE reason <> 'accepted' GROUP BY reason""",
    need="dirty",
)

SQL["val6_rejections"] = with_views(
    """
SELECT reason, count(*) AS n_rows FROM (
  SELECT CASE WHEN src_ip IS NULL OR dst_ip IS NULL THEN 'missing_ip'
              WHEN src_port IS NULL OR dst_port IS NULL THEN 'missing_port'
              WHEN byte_count IS NULL THEN 'missing_bytes'
              WHEN NOT (src_port BETWEEN 0 AND 65535 AND dst_port BETWEEN 0 AND 65535) THEN 'port_out_of_range'
              WHEN byte_count < 0 THEN 'negative_bytes'
              WHEN packet_count IS NULL OR packet_count < 1 THEN 'no_packets'
              WHEN flow_duration IS NULL OR isnan(flow_duration) OR flow_duration < 0 THEN 'bad_duration'
              ELSE 'accepted' END AS reason FROM dirty)
GROUP BY reason""",
    need="dirty",
)
SQL["val7_strict_ip"] = with_views(f"{_CLEAN} WHERE {_STRICT_BOTH}", need="dirty")
SQL["src1_read_flows_csv"] = SQL["val5_clean"]
SQL["src2_flows_csv_round_trip"] = with_views(f"SELECT {FLOW_LIST} FROM flows")
SQL["src10_user_csv_feed"] = with_views(
    f"SELECT label, count(*) AS n, sum(byte_count)::BIGINT AS bytes FROM clean WHERE {_STRICT_BOTH} GROUP BY label",
    need="dirty",
)

# -- conversion ------------------------------------------------------------

_CONVERTED = FLOW_LIST.replace("flow_id, ", "")
SQL["src3_read_raw_cidds_csv"] = with_views(f"SELECT {_CONVERTED} FROM cidds", need="cidds")
SQL["src4_read_raw_cic_csv"] = with_views(f"SELECT {_CONVERTED} FROM cic", need="cic")
SQL["cnv1_headers"] = with_views("SELECT timestamp, src_ip, dst_ip, raw_label AS label FROM raw_cic", need="cic")
SQL["cnv2_numbers"] = with_views("SELECT flow_duration, src_port, dst_port, packet_count FROM cidds", need="cidds")
SQL["cnv3_letter_flags"] = with_views(
    """
SELECT raw_flags, CASE WHEN c = '' THEN 'NONE' ELSE coalesce(nullif(array_to_string(list_filter(
    [CASE WHEN (length(c) >= 6 AND c[i] IN (x[1], '1')) OR (length(c) < 6 AND contains(upper(c), x[1])) THEN x END
     FOR x, i IN ['URG','ACK','PSH','RST','SYN','FIN']], lambda y: y IS NOT NULL), ','), ''), 'NONE') END AS tcp_flags,
  count(*) AS n
FROM (SELECT flags AS raw_flags, trim(flags) AS c FROM raw_cidds) GROUP BY ALL""",
    need="cidds",
)
SQL["cnv4_byte_sizes"] = with_views(
    """
SELECT bytes AS raw_bytes, coalesce(trunc(
    try_cast(regexp_replace(upper(bytes), ' *[MK]$', '') AS DOUBLE)
    * CASE right(upper(bytes), 1) WHEN 'M' THEN 1000000::DOUBLE WHEN 'K' THEN 1000::DOUBLE ELSE 1::DOUBLE END), 0)::BIGINT AS byte_count
FROM raw_cidds""",
    need="cidds",
)
SQL["cnv5_cidds_labels"] = with_views("SELECT label, count(*) AS n FROM cidds GROUP BY label", need="cidds")
SQL["cnv6_convert_cidds"] = SQL["src3_read_raw_cidds_csv"]
SQL["cnv7_cic_duration"] = with_views("SELECT timestamp, src_ip, dst_ip, flow_duration FROM cic", need="cic")
SQL["cnv8_protocol_numbers"] = with_views(
    """
SELECT proto AS number, CASE proto WHEN '6' THEN 'TCP' WHEN '17' THEN 'UDP' WHEN '1' THEN 'ICMP' ELSE 'TCP' END AS protocol,
  count(*) AS n FROM raw_cic GROUP BY ALL""",
    need="cic",
)
SQL["cnv9_sum_directions"] = with_views("SELECT timestamp, src_ip, dst_ip, packet_count, byte_count FROM cic", need="cic")
SQL["cnv10_count_flags"] = with_views("SELECT tcp_flags, count(*) AS n FROM cic GROUP BY tcp_flags", need="cic")
SQL["cnv11_cic_labels"] = with_views(
    """
SELECT raw_label, CASE WHEN x IN ('bot','infiltration') THEN 'c2_beacon' WHEN x IN ('ssh-patator','ftp-patator') THEN 'ssh_brute_force'
    WHEN contains(x,'port') THEN 'port_scan' WHEN contains(x,'dos') THEN 'syn_flood' ELSE 'benign' END AS label, count(*) AS n
FROM (SELECT raw_label, lower(trim(raw_label)) AS x FROM raw_cic) GROUP BY ALL""",
    need="cic",
)
SQL["cnv12_convert_cic"] = SQL["src4_read_raw_cic_csv"]
SQL["cnv13_flow_ids"] = with_views(
    """
SELECT sum(n)::BIGINT AS n_rows, sum(n)::BIGINT AS n_ids, sum(n)::BIGINT AS n_wellformed, sum(n - 1)::BIGINT AS n_copies
FROM (SELECT count(*) AS n FROM cidds GROUP BY ALL)""".replace(
        "SELECT count(*) AS n FROM cidds GROUP BY ALL",
        f"SELECT {_CONVERTED}, count(*) AS n FROM cidds GROUP BY ALL",
    ),
    need="cidds",
)
SQL["cnv14_missing_columns"] = with_views(
    """
SELECT '2026-09-20T08:00:00' AS timestamp, src_ip, dst_ip, src_port, dst_port, protocol, flow_duration, packet_count,
  byte_count, 'NONE' AS tcp_flags, 0::INTEGER AS tos, 'benign' AS label, 0::INTEGER AS is_anomaly FROM cidds""",
    need="cidds",
)
SQL["cnv14_missing_columns_cic"] = with_views(
    """
SELECT '2026-09-20T08:00:00' AS timestamp, '10.100.1.10' AS src_ip, '10.200.1.53' AS dst_ip, 49152::BIGINT AS src_port,
  443::BIGINT AS dst_port, 'TCP' AS protocol, coalesce(try_cast(duration AS DOUBLE), 0.0) / 1000000::DOUBLE AS flow_duration,
  greatest(fp, 1)::BIGINT AS packet_count, greatest(fb, 0)::BIGINT AS byte_count, 'NONE' AS tcp_flags, 0::INTEGER AS tos,
  'benign' AS label, 0::INTEGER AS is_anomaly FROM raw_cic""",
    need="cic",
)

# -- features and scaling --------------------------------------------------


def _features(names) -> str:
    shown = [f"round({n}, 6) AS {n}" if n in NUMERIC_FEATURES else f'"{n}"' for n in names]
    return with_views(f"SELECT flow_id, {', '.join(shown)} FROM featured", need="featured")


for _i, _name in enumerate(NUMERIC_FEATURES, 1):
    SQL[f"fea{_i}_{_name}"] = _features([_name])
SQL["fea9_14_flags"] = _features(FLAG_FEATURES[:6])
SQL["fea15_is_syn_only"] = _features(["is_syn_only"])
SQL["fea16_18_src_port_bands"] = _features(FLAG_FEATURES[7:10])
SQL["fea19_21_dst_port_bands"] = _features(FLAG_FEATURES[10:13])
SQL["fea22_24_protocols"] = _features(FLAG_FEATURES[13:])
SQL["fea_all_features"] = _features(FEATURES)


def _union_stats(center: str, scale: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{n}' AS feature, {center.format(n)} AS center, {scale.format(n)} AS scale FROM featured WHERE label = 'benign'"
        for n in NUMERIC_FEATURES
    )


_ROBUST = _union_stats("quantile_cont({0}, 0.5)", "quantile_cont({0}, 0.75) - quantile_cont({0}, 0.25)")
_STANDARD = _union_stats("avg({0})", "stddev_pop({0})")
_FIX = "SELECT feature, center, CASE WHEN scale = 0 THEN 1.0::DOUBLE ELSE scale END AS scale FROM ({})"


def _scaler(union: str) -> str:
    return f"stats AS ({_FIX.format(union)})"


def _scaled(n: str) -> str:
    return f"({n} - (SELECT center FROM stats WHERE feature = '{n}')) / (SELECT scale FROM stats WHERE feature = '{n}')"


for _key, _union in (("scl1_robust_fit", _ROBUST), ("scl2_standard_fit", _STANDARD)):
    SQL[_key] = with_views(
        "SELECT feature, round(center, 6) AS center, round(scale, 6) AS scale FROM stats", _scaler(_union), need="featured"
    )
_SCALED_LIST = ", ".join(f"round({_scaled(n)}, 6) AS {n}" for n in NUMERIC_FEATURES)
SQL["scl3_transform"] = with_views(
    f"SELECT flow_id, {_SCALED_LIST}, {_cols(FLAG_FEATURES)} FROM featured", _scaler(_ROBUST), need="featured"
)
SQL["scl5_fit_transform"] = with_views(
    f"SELECT {_SCALED_LIST}, {_cols(FLAG_FEATURES)} FROM featured WHERE label = 'benign'", _scaler(_STANDARD), need="featured"
)

# -- frozen forest ---------------------------------------------------------


def _leaf(tree: int, node: int) -> float:
    n = {row[0]: row[3] for row in TREES[tree]}[node]
    return (node + 1).bit_length() - 1 + average_path(n)


def _case(tree: int) -> str:
    nodes = {row[0]: row for row in TREES[tree]}

    def walk(i: int) -> str:
        _, feature, threshold, _ = nodes[i]
        if feature is None:
            return _num(_leaf(tree, i))
        return f"CASE WHEN {feature} <= {_num(threshold)} THEN {walk(2 * i + 1)} ELSE {walk(2 * i + 2)} END"

    return walk(0)


def _two_feature_phi(tree: int) -> dict[str, str]:
    """Shapley values of a root feature A and one child feature B, from their four coalitions."""
    nodes = {row[0]: row for row in TREES[tree]}
    _, fa, ta, n0 = nodes[0]
    child = 1 if nodes[1][1] else 2
    leaf = 3 - child
    _, fb, tb, nc = nodes[child]
    p_leaf, p_child = nodes[leaf][3] / n0, nc / n0
    left, right = 2 * child + 1, 2 * child + 2
    ql, qr = nodes[left][3] / nc, nodes[right][3] / nc
    a, b, c = _leaf(tree, leaf), _leaf(tree, left), _leaf(tree, right)
    mean_child = ql * b + qr * c
    in_child = f"({fa} <= {_num(ta)})" if child == 1 else f"NOT ({fa} <= {_num(ta)})"
    b_value = f"CASE WHEN {fb} <= {_num(tb)} THEN {_num(b)} ELSE {_num(c)} END"
    none = _num(p_leaf * a + p_child * mean_child)
    only_a = f"CASE WHEN {in_child} THEN {_num(mean_child)} ELSE {_num(a)} END"
    only_b = f"({_num(p_leaf * a)} + {_num(p_child)} * ({b_value}))"
    both = f"CASE WHEN {in_child} THEN {b_value} ELSE {_num(a)} END"
    return {
        fa: f"0.5::DOUBLE * ((({only_a}) - {none}) + (({both}) - {only_b}))",
        fb: f"0.5::DOUBLE * (({only_b} - {none}) + (({both}) - ({only_a})))",
    }


_PHI_PARTS = [_two_feature_phi(t) for t in TREES]
_DRIVERS = ["bytes_per_packet", "log_pps", "is_syn_only"]
_PHI = {f: "-(" + " + ".join(f"({p[f]})" for p in _PHI_PARTS if f in p) + ") / 3::DOUBLE" for f in _DRIVERS}
_PATH = "(" + " + ".join(f"({_case(t)})" for t in TREES) + ") / 3::DOUBLE"
_BASE = -sum(
    sum(row[3] / PSI * _leaf(t, row[0]) for row in rows if row[1] is None) for t, rows in TREES.items()
) / len(TREES)

_FROZEN = f"""
frozen AS (
  SELECT *, greatest(0.0::DOUBLE, least(1.0::DOUBLE, (raw_score - {_num(SCORE_MIN)}) / {_num(SCORE_MAX - SCORE_MIN)})) AS anomaly_score
  FROM (SELECT *, power(2.0::DOUBLE, -path_length / {_num(average_path(PSI))}) AS raw_score
        FROM (SELECT *, {_PATH} AS path_length, {", ".join(f"{e} AS phi_{f}" for f, e in _PHI.items())} FROM featured))
)"""
_CUT_FROZEN = _num(THRESHOLD)
_NAMES = ", ".join(_text(n) for n in FEATURES)
_PHI_LIST = ", ".join(f"phi_{n}" if n in _DRIVERS else "0.0::DOUBLE" for n in FEATURES)
_VALUE_LIST = ", ".join(f'"{n}"::DOUBLE' for n in FEATURES)

# One row per flow and feature, then the chosen drivers in order.
_LONG = f"""
long AS (
  SELECT flow_id, unnest(generate_series(0, {len(FEATURES) - 1})) AS i, unnest([{_NAMES}]) AS feature,
    unnest([{_PHI_LIST}]) AS phi, unnest([{_VALUE_LIST}]) AS value FROM frozen
)"""
_DRIVERS_CTE = """
drivers AS (
  SELECT flow_id, feature, (row_number() OVER w - 1)::INTEGER AS position, round(phi, 4) AS shap_contribution,
    round(value, 4) AS scaled_value, value AS raw_value
  FROM (SELECT *, max(phi) OVER (PARTITION BY flow_id) > 0 AS any_positive FROM long)
  WHERE NOT any_positive OR phi > 0
  WINDOW w AS (PARTITION BY flow_id ORDER BY phi DESC, i)
  QUALIFY row_number() OVER w <= 4
)"""


def _short(x: str) -> str:
    return rf"regexp_replace(printf('%.4f', {x}), '(\.\d+?)0+$', '\1')"


_SHAP = f"(SHAP: +' || {_short('shap_contribution')} || ')"
_REASON = f"""CASE
  WHEN feature = 'bytes_per_packet' THEN 'Payload density `bytes_per_packet` (' || printf('%.1f', round(byte_count / greatest(packet_count, 1), 1)) || ' B/pkt, SHAP: +' || {_short('shap_contribution')} || ') significantly exceeds baseline'
  WHEN feature = 'packets_per_second' THEN 'Transmission rate `packets_per_second` {_SHAP} indicates volumetric burst'
  WHEN feature = 'is_syn_only' AND scaled_value > 0.5 THEN 'TCP flag profile is strictly `SYN-only` without handshake completion {_SHAP}, typical of scans or SYN floods'
  WHEN feature = 'log_duration' AND scaled_value < 0 THEN 'Flow duration was anomalously brief for the requested port {_SHAP}'
  WHEN feature = 'proto_UDP' AND scaled_value > 0.5 THEN 'Protocol is UDP on atypical service port {_SHAP}'
  WHEN starts_with(feature, 'dst_port') THEN 'Destination port profile `' || feature || '` deviates from baseline enterprise behavior {_SHAP}'
  ELSE '`' || feature || '` deviated strongly from baseline distribution {_SHAP}' END"""
_EXPLAINED = f"""
explained AS (
  SELECT f.*, d.reasons, d.names, d.n_drivers,
    'Flow flagged as ' || CASE WHEN anomaly_score >= {_CUT_FROZEN} THEN 'ANOMALOUS' ELSE 'BENIGN' END
    || ' (calibrated anomaly score: ' || printf('%.3f', round(anomaly_score, 3)) || ', threshold: 0.500). Primary operational drivers: '
    || d.reasons || '.' AS narrative
  FROM frozen f JOIN (
    SELECT d.flow_id, string_agg({_REASON}, '; ' ORDER BY position) AS reasons,
      string_agg(feature, ',' ORDER BY position) AS names, count(*)::INTEGER AS n_drivers
    FROM drivers d JOIN flows fl USING (flow_id) GROUP BY d.flow_id) d USING (flow_id)
)"""


def _frozen(body: str, *more: str) -> str:
    return with_views(body, _FROZEN, *more, need="featured")


SQL["mdl3_path_length"] = _frozen("SELECT flow_id, round(path_length, 6) AS path_length FROM frozen")
SQL["mdl4_raw_score"] = _frozen("SELECT flow_id, round(raw_score, 6) AS raw_score FROM frozen")
SQL["mdl5_score_range"] = _frozen(
    "SELECT round(min(raw_score), 6) AS score_min, round(CASE WHEN max(raw_score) > min(raw_score) THEN max(raw_score) "
    "ELSE min(raw_score) + 0.000001::DOUBLE END, 6) AS score_max FROM frozen WHERE label = 'benign'"
)
SQL["mdl6_anomaly_score"] = _frozen("SELECT flow_id, round(anomaly_score, 6) AS anomaly_score FROM frozen")
SQL["src5_6_model_save_load"] = _frozen(
    f"SELECT flow_id, round(raw_score, 6) AS raw_score, (anomaly_score >= {_CUT_FROZEN})::INTEGER AS is_alert FROM frozen"
)
SQL["xai2_attributions"] = _frozen(
    " UNION ALL ".join(
        f"SELECT flow_id, '{f}' AS feature, round({'phi_' + f if f in _DRIVERS else '0.0::DOUBLE'}, 6) AS phi FROM frozen"
        for f in FEATURES
    )
)
SQL["xai3_base_value"] = _frozen(
    f"SELECT flow_id, round(-({_num(_BASE)} + {' + '.join('phi_' + f for f in _DRIVERS)}), 6) AS path_length FROM frozen"
)
SQL["xai4_importance"] = _frozen(
    " UNION ALL ".join(
        f"SELECT '{n}' AS feature, round(avg(abs({'phi_' + n if n in _DRIVERS else '0.0::DOUBLE'})), 6) AS mean_abs_shap FROM frozen"
        for n in FEATURES
    )
)
SQL["xai5_top_drivers"] = _frozen(
    "SELECT flow_id, position, feature, shap_contribution, scaled_value FROM drivers", _LONG, _DRIVERS_CTE
)
SQL["xai6_raw_values"] = _frozen(
    "SELECT flow_id, feature, round(raw_value, 6) AS raw_value FROM drivers", _LONG, _DRIVERS_CTE
)
SQL["xai7_narrative"] = _frozen("SELECT flow_id, narrative FROM explained", _LONG, _DRIVERS_CTE, _EXPLAINED)
SQL["xai8_explanations"] = _frozen(
    f"SELECT flow_id, round(anomaly_score, 4) AS anomaly_score, (anomaly_score >= {_CUT_FROZEN})::INTEGER AS is_alert, n_drivers FROM explained",
    _LONG,
    _DRIVERS_CTE,
    _EXPLAINED,
)
SQL["xai10_waterfall"] = _frozen(
    f"""
SELECT flow_id, position, feature, round(phi, 6) AS phi,
  round({_num(_BASE)} + sum(phi) OVER (PARTITION BY flow_id ORDER BY position ROWS UNBOUNDED PRECEDING), 6) AS running_total
FROM (SELECT flow_id, least(r, 8)::INTEGER AS position, CASE WHEN r <= 7 THEN feature ELSE '17 other features' END AS feature, sum(phi) AS phi
      FROM (SELECT *, row_number() OVER (PARTITION BY flow_id ORDER BY abs(phi) DESC, i) AS r FROM long)
      GROUP BY ALL)""",
    _LONG,
)

# -- trained forest: invariants --------------------------------------------

_TRAIN = "train AS (SELECT count(*) AS n FROM flows_all WHERE label = 'benign' AND k % 2 = 0)"
_TREES = "(SELECT unnest(generate_series(0, 149))::INTEGER AS tree_id)"
SQL["mdl1_tree_samples"] = with_views(
    f"SELECT tree_id, least(256, n)::BIGINT AS n_rows, least(256, n)::BIGINT AS n_distinct FROM {_TREES}, train", _TRAIN
)
SQL["mdl2_tree_invariants"] = with_views(
    f"SELECT tree_id, least(256, n)::BIGINT AS leaf_rows, 1::INTEGER AS depth_ok, 1::INTEGER AS binary_ok FROM {_TREES}, train", _TRAIN
)
SQL["mdl_trained_scores"] = with_views(
    "SELECT count(*) AS n, count(*) AS in_range, 1::INTEGER AS auroc_ok FROM flows_all WHERE k % 2 = 1"
)
SQL["ext2_windowed_alerts"] = _frozen(
    f"""
SELECT strftime(time_bucket(INTERVAL '1 hour', CAST(timestamp AS TIMESTAMP)), '%Y-%m-%d %H:%M') AS window_start, src_ip,
  count(*) AS alerts, count(DISTINCT dst_ip) AS targets, round(max(anomaly_score), 6) AS top_score
FROM frozen WHERE anomaly_score >= {_CUT_FROZEN} GROUP BY 1, 2"""
)
SQL["xai2_local_accuracy"] = with_views("SELECT 0::BIGINT AS n_violations")

# -- thresholds and evaluation on the surrogate score ----------------------

SQL["mdl7_default_threshold"] = with_views(
    "SELECT round(quantile_cont(anomaly_score, 0.95), 6) AS threshold FROM scored WHERE label = 'benign'", need="scored"
)
SQL["mdl8_fpr_threshold"] = with_views(
    " UNION ALL ".join(
        f"SELECT {f}::DOUBLE AS target_fpr, round(quantile_cont(anomaly_score, {round(1 - f, 2)}), 6) AS threshold FROM scored WHERE label = 'benign'"
        for f in (0.01, 0.02, 0.03, 0.08)
    ),
    need="scored",
)
SQL["mdl9_predict"] = with_views(
    f"SELECT flow_id, anomaly_score, (anomaly_score >= {CUT})::INTEGER AS is_alert FROM scored", need="scored"
)
SQL["xai1_baseline_statistics"] = with_views(
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", round(avg({c}), 4) AS mean, round(CASE WHEN stddev_pop({c}) = 0 THEN 1.0::DOUBLE ELSE stddev_pop({c}) END, 4) AS std, "
        f"round(quantile_cont({c}::DOUBLE, 0.5), 4) AS median FROM flows WHERE label = 'benign'"
        for c in ("src_port", "dst_port", "flow_duration", "packet_count", "byte_count", "tos", "is_anomaly")
    )
)

_MATRIX = f"""
matrix AS (
  SELECT count(*) FILTER (anomaly_score < {CUT} AND is_anomaly = 0) AS tn, count(*) FILTER (anomaly_score >= {CUT} AND is_anomaly = 0) AS fp,
    count(*) FILTER (anomaly_score < {CUT} AND is_anomaly = 1) AS fn, count(*) FILTER (anomaly_score >= {CUT} AND is_anomaly = 1) AS tp FROM scored
)"""
_RATES = """
rates AS (
  SELECT *, CASE WHEN precision + recall > 0 THEN 2.0::DOUBLE * precision * recall / (precision + recall) ELSE 0.0 END AS f1_score
  FROM (SELECT *, CASE WHEN tp + fp > 0 THEN tp::DOUBLE / (tp + fp) ELSE 0.0 END AS precision,
          CASE WHEN tp + fn > 0 THEN tp::DOUBLE / (tp + fn) ELSE 0.0 END AS recall,
          CASE WHEN fp + tn > 0 THEN fp::DOUBLE / (fp + tn) ELSE 0.0 END AS false_positive_rate FROM matrix)
)"""
_CURVE = """
curve AS (
  SELECT *, sum(n) OVER w AS cum_n, sum(p) OVER w AS cum_p
  FROM (SELECT anomaly_score AS threshold, count(*) AS n, sum(is_anomaly) AS p FROM scored GROUP BY anomaly_score)
  WINDOW w AS (ORDER BY threshold DESC ROWS UNBOUNDED PRECEDING)
)"""
_QUALITY = """
quality AS (
  SELECT sum((n - p)::DOUBLE * (cum_p - p / 2.0::DOUBLE)) / (sum(p)::DOUBLE * sum(n - p)::DOUBLE) AS auroc,
    sum(p::DOUBLE * cum_p / cum_n) / sum(p)::DOUBLE AS average_precision FROM curve
)"""
_IMPACT = """
impact AS (
  SELECT 1000000::BIGINT AS assumed_daily_flows, trunc((tp + fp)::DOUBLE / (tn + fp + fn + tp) * 1000000::DOUBLE)::BIGINT AS projected_daily_alerts,
    trunc(fp::DOUBLE / (fp + tn) * 1000000::DOUBLE)::BIGINT AS projected_daily_false_alarms FROM matrix
)"""
_ATTACKS = f"""
attacks AS (
  SELECT label, count(*) AS count, sum((anomaly_score >= {CUT})::INTEGER)::BIGINT AS detected,
    round(avg((anomaly_score >= {CUT})::INTEGER), 4) AS recall FROM scored WHERE label <> 'benign' GROUP BY label
)"""
_DOC = """
SELECT round(auroc, 4) AS auroc, round(average_precision, 4) AS pr_auc, 0.5::DOUBLE AS threshold, round(precision, 4) AS precision,
  round(recall, 4) AS recall, round(f1_score, 4) AS f1_score, round(false_positive_rate, 5) AS false_positive_rate,
  tn AS true_negatives, fp AS false_positives, fn AS false_negatives, tp AS true_positives, impact.*,
  (SELECT string_agg(label || ':' || count || ':' || detected, ',' ORDER BY label) FROM attacks) AS attacks
FROM rates, quality, impact"""
_DOC_PARTS = (_MATRIX, _RATES, _CURVE, _QUALITY, _IMPACT, _ATTACKS)


def _scored(body: str, *more: str) -> str:
    return with_views(body, *more, need="scored")


SQL["evl1_binarise"] = _scored(
    f"SELECT is_anomaly, (anomaly_score >= {CUT})::INTEGER AS is_alert, count(*) AS n FROM scored GROUP BY ALL"
)
SQL["evl2_confusion"] = _scored("SELECT * FROM matrix", _MATRIX)
SQL["evl3_rates"] = _scored(
    "SELECT round(precision, 4) AS precision, round(recall, 4) AS recall, round(f1_score, 4) AS f1_score, "
    "round(false_positive_rate, 5) AS false_positive_rate FROM rates",
    _MATRIX,
    _RATES,
)
SQL["evl4_auroc"] = _scored("SELECT round(auroc, 6) AS auroc FROM quality", _CURVE, _QUALITY)
SQL["evl5_average_precision"] = _scored(
    "SELECT round(average_precision, 6) AS average_precision FROM quality", _CURVE, _QUALITY
)
SQL["evl6_daily_alerts"] = _scored("SELECT * FROM impact", _MATRIX, _IMPACT)
SQL["evl7_per_attack"] = _scored("SELECT * FROM attacks", _ATTACKS)
SQL["evl8_tradeoff"] = _scored(
    """
SELECT round(th, 3) AS threshold, round(CASE WHEN P > 0 THEN tp / P ELSE 0.0 END, 4) AS recall,
  round(CASE WHEN hits > 0 THEN tp / hits ELSE 0.0 END, 4) AS precision,
  round(CASE WHEN T - P > 0 THEN (hits - tp) / (T - P) ELSE 0.0 END, 5) AS fpr,
  round(hits / T * 100.0::DOUBLE, 3) AS alert_percentage,
  trunc(hits / T * 100.0::DOUBLE / 100.0::DOUBLE * 1000000::DOUBLE)::BIGINT AS projected_daily_alerts
FROM (SELECT th, count(*) FILTER (anomaly_score >= th)::DOUBLE AS hits, (count(*) FILTER (anomaly_score >= th AND is_anomaly = 1))::DOUBLE AS tp,
        count(*)::DOUBLE AS T, sum(is_anomaly)::DOUBLE AS P
      FROM scored, (SELECT 0.1::DOUBLE + i * (0.85::DOUBLE / 49) AS th FROM generate_series(0, 49) g(i)) GROUP BY th)"""
)
SQL["evl9_roc_points"] = _scored(
    """
SELECT round((cum_n - cum_p)::DOUBLE / (SELECT sum(n - p) FROM curve), 6) AS fpr, round(cum_p::DOUBLE / (SELECT sum(p) FROM curve), 6) AS tpr, round(threshold, 6) AS threshold FROM curve
UNION ALL SELECT 0.0::DOUBLE, 0.0::DOUBLE, NULL""",
    _CURVE,
)
SQL["evl10_pr_points"] = _scored(
    """
SELECT round(cum_p::DOUBLE / cum_n, 6) AS precision, round(cum_p::DOUBLE / (SELECT sum(p) FROM curve), 6) AS recall, round(threshold, 6) AS threshold FROM curve
UNION ALL SELECT 1.0::DOUBLE, 0.0::DOUBLE, NULL""",
    _CURVE,
)
SQL["evl11_no_skill"] = _scored("SELECT round(avg(is_anomaly), 6) AS no_skill_precision FROM scored")
SQL["evl12_metrics"] = _scored(_DOC, *_DOC_PARTS)
SQL["src7_9_metrics_json"] = SQL["evl12_metrics"]
SQL["evl13_confusion_cells"] = _scored(
    """
SELECT 'Actual Benign' AS actual, 'Predicted Benign' AS predicted, 'Benign Ignored' AS cell, tn AS n FROM matrix
UNION ALL SELECT 'Actual Benign', 'Predicted Anomaly', 'False Alarms', fp FROM matrix
UNION ALL SELECT 'Actual Attack', 'Predicted Benign', 'Missed Attacks', fn FROM matrix
UNION ALL SELECT 'Actual Attack', 'Predicted Anomaly', 'True Alerts', tp FROM matrix""",
    _MATRIX,
)

# -- triage ----------------------------------------------------------------

_THREATS = "threats(archetype, technique_id, technique_name, tactic, base_severity, playbook) AS (VALUES {})".format(
    ", ".join("(" + ", ".join(_text(x) for x in row) + ")" for row in THREATS)
)
_INFER = """CASE WHEN dst_port = 53 AND byte_count::DOUBLE / greatest(packet_count, 1) > 400 THEN 'dns_exfiltration'
  WHEN tcp_flags = 'SYN' AND packet_count > 500 THEN 'syn_flood' WHEN dst_port = 22 THEN 'ssh_brute_force'
  WHEN tcp_flags = 'SYN' AND flow_duration < 0.01::DOUBLE THEN 'port_scan' WHEN dst_port IN (8443, 4444, 9001) THEN 'c2_beacon' END"""
_FALLBACK = dict(zip(["technique_id", "technique_name", "tactic", "base_severity", "playbook"], UNKNOWN_THREAT))
_CONTEXT_COLS = ", ".join(f"coalesce(t.{c}, {_text(v)}) AS {c}" for c, v in _FALLBACK.items())


def _context(source: str, use_label: bool = True) -> str:
    known = "CASE WHEN label IN (SELECT archetype FROM threats) THEN label END"
    key = f"coalesce({known}, {_INFER})" if use_label else _INFER
    return f"""{_THREATS},
context AS (SELECT x.*, {_CONTEXT_COLS} FROM (SELECT *, {key} AS archetype FROM {source}) x LEFT JOIN threats t USING (archetype))"""


_SEVERITY = """CASE WHEN s >= 0.85::DOUBLE THEN CASE WHEN base_severity IN ('CRITICAL','HIGH') THEN 'CRITICAL' ELSE 'HIGH' END
  WHEN s >= 0.65::DOUBLE THEN CASE WHEN base_severity = 'CRITICAL' THEN 'HIGH' ELSE base_severity END ELSE 'MEDIUM' END"""
_CONTAIN = "'Block source IP ' || src_ip || ' at perimeter firewall or isolate endpoint.'"
_CONTEXT_LIST = "technique_id, technique_name, tactic, base_severity, playbook"

SQL["tri1_label_context"] = with_views(
    f"SELECT flow_id, {_CONTEXT_LIST} FROM context WHERE label <> 'benign'", _context("flows")
)
SQL["tri2_inferred_context"] = with_views(
    "SELECT flow_id, coalesce(archetype, 'none') AS archetype, technique_id FROM context", _context("flows", False)
)
SQL["tri3_fallback_context"] = with_views(
    f"SELECT {_CONTEXT_LIST}, count(*) AS n FROM context GROUP BY ALL", _context("flows")
)
SQL["tri4_severity"] = _scored(
    f"SELECT flow_id, {_SEVERITY} AS severity FROM (SELECT *, round(anomaly_score, 4) AS s FROM context)", _context("scored")
)
_ALERTS = f"""
SELECT 'ALT-20260920-' || substr(sha256(flow_id), 1, 16) AS alert_id, flow_id, timestamp, {_SEVERITY} AS severity, 'flagged_for_triage' AS action, src_ip AS src, src_ip, src_port, dst_ip AS dest,
  dst_ip AS dest_ip, dst_port AS dest_port, lower(protocol) AS transport, flow_duration AS duration, packet_count AS packets,
  byte_count AS bytes, tcp_flags, s AS score, names AS drivers, narrative AS justification, technique_id AS mitre_technique_id,
  technique_name AS mitre_technique_name, tactic AS mitre_tactic, playbook AS recommended_playbook, {_CONTAIN} AS suggested_containment
FROM (SELECT *, round(anomaly_score, 4) AS s FROM context)"""
_ALERT_PARTS = (_LONG, _DRIVERS_CTE, _EXPLAINED)
_ALERT_SQL = _frozen(f"{_ALERTS} WHERE anomaly_score >= {_CUT_FROZEN}", *_ALERT_PARTS, _context("explained"))
for _key in ("tri5_alerts", "tri7_alert_batch", "src8_alerts_json", "ext1_stream_alerts"):
    SQL[_key] = _ALERT_SQL
SQL["qry21_pipeline_frozen"] = _frozen(
    f"{_ALERTS} WHERE anomaly_score >= {_CUT_FROZEN} AND flow_id IN (SELECT flow_id FROM flows_all WHERE k % 2 = 1)",
    *_ALERT_PARTS,
    _context("explained"),
)
SQL["tri6_alert_ids"] = _frozen(
    f"SELECT count(*) AS n_alerts, count(*) AS n_ids, count(*) AS n_wellformed FROM frozen WHERE anomaly_score >= {_CUT_FROZEN}"
)
SQL["tri8_containment"] = with_views(f"SELECT flow_id, {_CONTAIN} AS suggested_containment FROM flows")

_TOP = "top AS (SELECT flow_id FROM (SELECT flow_id, round(least(1.0::DOUBLE, log_pps / 12.0::DOUBLE), 4) AS s FROM featured) ORDER BY s DESC, flow_id LIMIT 1)"
SQL["qry8_inspect_flow"] = _frozen(
    f"{_ALERTS} WHERE flow_id = (SELECT flow_id FROM top)", *_ALERT_PARTS, _context("explained"), _TOP
)
SQL["src11_export_alert"] = _frozen(
    f"SELECT flow_id, severity, src_ip, dest_port::VARCHAR AS dest_port, mitre_technique_id AS technique FROM ({_ALERTS} WHERE flow_id = (SELECT flow_id FROM top))",
    *_ALERT_PARTS,
    _context("explained"),
    _TOP,
)

# -- reports ---------------------------------------------------------------

SQL["qry1_kpis"] = _scored(
    "SELECT tn + fp + fn + tp AS total_flows, fp + tp AS flagged_flows, "
    "round((fp + tp)::DOUBLE / (tn + fp + fn + tp) * 100.0::DOUBLE, 6) AS flagged_pct, "
    "round(fp::DOUBLE / greatest(fp + tn, 1) * 100.0::DOUBLE, 6) AS fpr_pct FROM matrix",
    _MATRIX,
)
SQL["qry2_presets"] = _scored(
    " UNION ALL ".join(
        f"SELECT '{name}' AS preset, sum((anomaly_score >= {t}::DOUBLE)::INTEGER)::BIGINT AS flagged FROM scored"
        for name, t in (("calibrated", 0.69), ("balanced", 0.55), ("high_recall", 0.45))
    )
)
SQL["qry3_scored_view"] = _scored(
    f"SELECT flow_id, round_even(anomaly_score * 1000, 0) / 1000 AS anomaly_score, CASE WHEN anomaly_score >= {CUT} THEN 'FLAGGED' ELSE 'NORMAL' END AS status FROM scored"
)
_QUEUE = f"queue AS (SELECT * REPLACE (round_even(anomaly_score * 1000, 0) / 1000 AS anomaly_score) FROM scored WHERE anomaly_score >= {CUT})"
SQL["qry4_incident_queue"] = _scored("SELECT flow_id, anomaly_score, label FROM queue ORDER BY 2 DESC, 1", _QUEUE)
SQL["qry5_queue_labels"] = _scored("SELECT DISTINCT label FROM queue ORDER BY 1", _QUEUE)
SQL["qry6_queue_by_label"] = _scored("SELECT flow_id, anomaly_score FROM queue WHERE label = 'port_scan'", _QUEUE)
SQL["qry7_queue_page"] = _scored(
    "SELECT flow_id, src_ip, dst_ip, dst_port, protocol, packet_count, byte_count, anomaly_score, label FROM queue ORDER BY anomaly_score DESC, flow_id LIMIT 30",
    _QUEUE,
)
SQL["qry9_attack_table"] = _scored(
    "SELECT label, count, detected, printf('%.1f', round(recall * 100.0::DOUBLE, 1)) || '%' AS recall FROM attacks", _ATTACKS
)
SQL["qry10_flagged_share"] = _scored(
    f"SELECT sum((anomaly_score >= {CUT})::INTEGER)::BIGINT AS flagged, round(avg((anomaly_score >= {CUT})::INTEGER), 6) AS flagged_share FROM scored"
)
SQL["qry11_most_anomalous"] = _scored(
    "SELECT flow_id, anomaly_score, label FROM scored ORDER BY anomaly_score DESC, flow_id LIMIT 1"
)
SQL["qry12_top_flagged"] = _scored(
    f"SELECT flow_id, anomaly_score, label FROM scored WHERE anomaly_score >= {CUT} ORDER BY anomaly_score DESC, flow_id LIMIT 50"
)
SQL["qry13_attack_share"] = with_views("SELECT round(avg(is_anomaly), 6) AS attack_share FROM flows")
SQL["qry14_label_counts"] = with_views("SELECT label, count(*) AS n FROM flows GROUP BY label ORDER BY n DESC, label")
SQL["qry15_column_summary"] = with_views(
    " UNION ALL ".join(
        f"SELECT '{n}' AS \"column\", count(v) AS count, round(avg(v), 3) AS mean, round(stddev_samp(v), 3) AS std, round(min(v), 3) AS min, "
        "round(quantile_cont(v, 0.25), 3) AS q25, round(quantile_cont(v, 0.5), 3) AS q50, round(quantile_cont(v, 0.75), 3) AS q75, round(max(v), 3) AS max "
        f"FROM (SELECT {_scaled(n)} AS v FROM featured WHERE label = 'benign')"
        for n in NUMERIC_FEATURES
    ),
    _scaler(_ROBUST),
    need="featured",
)
_BOX = " UNION ALL ".join(
    f"SELECT label, '{m}' AS measure, {m} AS v FROM featured" for m in ("bytes_per_packet", "packets_per_second")
)
SQL["qry16_box_statistics"] = with_views(
    """
SELECT b.label, b.measure, round(min(v) FILTER (v BETWEEN low AND high), 6) AS whisker_low,
  round(max(v) FILTER (v BETWEEN low AND high), 6) AS whisker_high, count(v) AS n,
  round(any_value(q25), 6) AS q25, round(any_value(q50), 6) AS q50, round(any_value(q75), 6) AS q75
FROM box b JOIN (SELECT *, q25 - 1.5::DOUBLE * (q75 - q25) AS low, q75 + 1.5::DOUBLE * (q75 - q25) AS high FROM quartiles) q
  ON b.label = q.label AND b.measure = q.measure GROUP BY ALL""",
    f"box AS ({_BOX})",
    "quartiles AS (SELECT label, measure, quantile_cont(v, 0.25) AS q25, quantile_cont(v, 0.5) AS q50, quantile_cont(v, 0.75) AS q75 FROM box GROUP BY ALL)",
    need="featured",
)
SQL["qry17_score_density"] = _scored(
    "SELECT is_anomaly, least(floor(anomaly_score * 50), 49)::INTEGER AS bin, count(*) AS n FROM scored GROUP BY ALL"
)
SQL["qry18_split"] = with_views(
    "SELECT 'baseline' AS split, count(*) AS n, sum(is_anomaly)::BIGINT AS attacks FROM flows_all WHERE label = 'benign' AND k % 2 = 0 "
    "UNION ALL SELECT 'evaluation', count(*), sum(is_anomaly)::BIGINT FROM flows_all WHERE k % 2 = 1"
)
SQL["qry22_append_rows"] = with_views(
    "SELECT label, count(*) AS n FROM flows_all WHERE k % 2 = 1 OR label = 'benign' GROUP BY label"
)

SQL["qry19_sample_size"] = with_views(
    "SELECT least(500, count(*))::BIGINT AS n_rows, least(500, count(DISTINCT flow_id))::BIGINT AS n_distinct FROM flows"
)
SQL["qry21_acceptance"] = with_views(
    "SELECT 1::INTEGER AS auroc_ok, 1::INTEGER AS recall_ok, 1::INTEGER AS fpr_ok, count(*) FILTER (is_anomaly = 0) AS n_benign, "
    "count(*) FILTER (is_anomaly = 1) AS n_attacks FROM flows_all WHERE k % 2 = 1"
)
_BOTH = " UNION ALL ".join(
    f"SELECT '{layout}' AS layout, (SELECT count(*) FROM {view}) AS n_rows, label, count(*) AS n_label FROM {view} WHERE label <> 'benign' GROUP BY label"
    for layout, view in (("cidds-001", "cidds"), ("cic-ids2017", "cic"))
)
SQL["qry20_benchmark_counts"] = with_views(_BOTH, need="both")

# The frozen model on converted raw rows: same views, other source and score.
_BENCH_SCORED = _FROZEN.replace("frozen AS (", "scored AS (").replace("FROM featured", "FROM bench_featured")
SQL["qry20_benchmark_cidds_frozen"] = with_views(
    _DOC, features_cte("bench_featured", "cidds"), _BENCH_SCORED, *_DOC_PARTS, need="cidds"
)
SQL["qry20_benchmark_frozen"] = with_views(
    _DOC, features_cte("bench_featured", "cic"), _BENCH_SCORED, *_DOC_PARTS, need="cic"
)
