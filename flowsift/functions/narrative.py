"""Numbers as text and the analyst narrative, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# Below this size a number of up to 4 decimals fits the decimals that Spark keeps in a machine word.
_WORD = 1e13


def _rounded_text(value: Column, digits: int) -> Column:
    """``value`` rounded half up on the decimal text, with all its decimals.

    A decimal prints several times faster than a format; what does not fit one (null, NaN,
    infinite or huge) is formatted.
    """
    slow = F.format_string(f"%.{digits}f", F.round(value, digits))
    if not 0 < digits <= 4:
        return slow
    fast = F.round(value, digits).cast(f"decimal(18,{digits})").cast("string")
    return F.when(F.abs(value) < _WORD, fast).otherwise(slow)


def short_number(value: Column, digits: int = 4) -> Column:
    """``0.5`` not ``0.5000``, ``0.0001`` not ``1.0E-4``."""
    text = _rounded_text(value, digits)
    if digits < 1:
        return F.regexp_replace(text, r"(\.\d+?)0+$", "$1")

    def shorten(t: Column) -> Column:
        """Without the zeros at the end, but for the first decimal."""
        cut = F.rtrim(t, F.lit("0"))
        cut = F.when(cut.endswith("."), F.concat(cut, F.lit("0"))).otherwise(cut)
        return F.when(t.contains(".") & t.endswith("0"), cut).otherwise(t)

    # Behind an array of one, so that the number is printed once and not per use.
    return F.transform(F.array(text), shorten)[0]


def fixed_number(value: Column, digits: int) -> Column:
    """Fixed number of decimals, rounded half up on the decimal text."""
    return _rounded_text(value, digits)


def _reason(driver: Column, density: Column) -> Column:
    """Sentence for one driver. The sentences are fixed values."""
    feature, value = driver["feature"], driver["scaled_value"]
    shap = F.concat(F.lit("(SHAP: +"), short_number(driver["shap_contribution"]), F.lit(")"))
    name = F.concat(F.lit("`"), feature, F.lit("`"))
    return (
        F.when(
            feature == "bytes_per_packet",
            F.concat(
                F.lit("Payload density "),
                name,
                F.lit(" ("),
                density,
                F.lit(", SHAP: +"),
                short_number(driver["shap_contribution"]),
                F.lit(") significantly exceeds baseline"),
            ),
        )
        .when(
            feature == "packets_per_second",
            F.concat(F.lit("Transmission rate "), name, F.lit(" "), shap, F.lit(" indicates volumetric burst")),
        )
        .when(
            (feature == "is_syn_only") & (value > 0.5),
            F.concat(
                F.lit("TCP flag profile is strictly `SYN-only` without handshake completion "),
                shap,
                F.lit(", typical of scans or SYN floods"),
            ),
        )
        .when(
            (feature == "log_duration") & (value < 0.0),
            F.concat(F.lit("Flow duration was anomalously brief for the requested port "), shap),
        )
        .when(
            (feature == "proto_UDP") & (value > 0.5),
            F.concat(F.lit("Protocol is UDP on atypical service port "), shap),
        )
        .when(
            feature.startswith("dst_port"),
            F.concat(
                F.lit("Destination port profile "), name, F.lit(" deviates from baseline enterprise behavior "), shap
            ),
        )
        .otherwise(F.concat(name, F.lit(" deviated strongly from baseline distribution "), shap))
    )


def payload_density(byte_count: Column, packet_count: Column) -> Column:
    """``840.0 B/pkt``."""
    ratio = byte_count / F.greatest(packet_count, F.lit(1))
    return F.concat(fixed_number(ratio, 1), F.lit(" B/pkt"))


def narrative(score: Column, threshold: float, drivers: Column, density: Column) -> Column:
    """Why a flow was (not) flagged; the sentences are fixed values."""
    status = F.when(score >= F.lit(threshold), F.lit("ANOMALOUS")).otherwise(F.lit("BENIGN"))
    joined = F.array_join(F.transform(drivers, lambda d: _reason(d, density)), "; ")
    # Behind an array of one, so that the text is made once and not per use.
    reasons = F.transform(
        F.array(joined), lambda r: F.when(r == "", F.lit("no single dominant outlier attribute")).otherwise(r)
    )[0]
    return F.concat(
        F.lit("Flow flagged as "),
        status,
        F.lit(" (calibrated anomaly score: "),
        fixed_number(score, 3),
        F.lit(", threshold: "),
        fixed_number(F.lit(float(threshold)), 3),
        F.lit("). Primary operational drivers: "),
        reasons,
        F.lit("."),
    )
