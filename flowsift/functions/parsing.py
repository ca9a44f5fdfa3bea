"""Text parsing of raw flow layouts, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Flag names by letter position (CIDDS-001) and by output order
# (CIC-IDS2017), protocol numbers, byte suffixes.
CIDDS_FLAGS = ["URG", "ACK", "PSH", "RST", "SYN", "FIN"]
CIC_FLAGS = ["FIN", "SYN", "RST", "PSH", "ACK", "URG"]
PROTOCOL_NUMBERS = {6: "TCP", 17: "UDP", 1: "ICMP"}
BYTE_SUFFIXES = {"M": 1_000_000.0, "K": 1_000.0}

# Java's number parser also takes "1.0f" or "0x1p3"; those are not numbers here.
_NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def strip(text: Column) -> Column:
    """Without white space at both ends, tabs and line ends included."""
    return F.btrim(text.cast("string"), F.lit(" \t\n\r\x0b\x0c"))


def to_number(text: Column) -> Column:
    """Double value of a text, null if it is no plain number.

    A whole number that prints as it is written, as most counts do, needs no pattern.
    """
    whole, clean = text.cast("string").try_cast("bigint"), strip(text)
    plain = F.when(whole.cast("string") == text.cast("string"), whole.cast("double"))
    return F.coalesce(plain, F.when(clean.rlike(_NUMBER), clean.try_cast("double")))


def to_whole(text: Column, default: int) -> Column:
    """Number cut to a whole bigint, ``default`` where it is missing."""
    return F.coalesce(to_number(text), F.lit(float(default))).try_cast("bigint")


def parse_byte_size(text: Column) -> Column:
    """``8.5 K`` -> 8500; missing or unreadable text -> 0.

    The product is taken in double and then cut, so ``1.001 K`` may lose one
    byte exactly as binary arithmetic does.
    """
    clean = F.upper(strip(text))
    suffix = F.right(clean, F.lit(1))
    body = to_number(F.substring(clean, F.lit(1), F.length(clean) - 1))
    value = to_number(clean)
    for letter, factor in BYTE_SUFFIXES.items():
        value = F.when(suffix == letter, body * F.lit(factor)).otherwise(value)
    return F.coalesce(value.try_cast("bigint"), F.lit(0).cast("bigint"))


def _joined(items: list[Column]) -> Column:
    """Comma list of the non-null items, ``NONE`` if there is none."""
    text = F.array_join(F.array(*items), ",")
    return F.when(text == "", F.lit("NONE")).otherwise(text)


def parse_letter_flags(text: Column) -> Column:
    """``.AP.SF`` -> ``ACK,PSH,SYN,FIN``.

    Six or more characters are read by position; a shorter text sets every flag
    whose first letter occurs anywhere in it.
    """
    clean = strip(text)
    upper = F.upper(clean)
    by_position = [
        F.when(F.substring(clean, i + 1, 1).isin(name[0], "1"), F.lit(name)) for i, name in enumerate(CIDDS_FLAGS)
    ]
    by_letter = [F.when(upper.contains(name[0]), F.lit(name)) for name in CIDDS_FLAGS]
    return F.when(clean.isNull() | (clean == ""), F.lit("NONE")).otherwise(
        F.when(F.length(clean) >= 6, _joined(by_position)).otherwise(_joined(by_letter))
    )


def flags_from_counts(counts: dict[str, Column]) -> Column:
    """Flag list from per-flag counters; a flag is set when its count equals 1."""
    return _joined([F.when(to_number(counts[name]) == 1, F.lit(name)) for name in CIC_FLAGS if name in counts])


def protocol_name(number: Column) -> Column:
    """Protocol text of an IP protocol number, TCP for any other number."""
    expr = F.lit("TCP")
    for value, name in PROTOCOL_NUMBERS.items():
        expr = F.when(number == value, F.lit(name)).otherwise(expr)
    return expr


def lookup(mapping: dict[str, str], key: Column) -> Column:
    """Value of ``key`` in a small constant map, null if absent."""
    pairs = [F.lit(x) for item in mapping.items() for x in item]
    return F.try_element_at(F.create_map(*pairs), key)
