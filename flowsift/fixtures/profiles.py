"""Traffic classes of the derived flows, as SQL text that every engine reads alike.

The given tables hold no network flows, so each line of ``lineitem`` becomes one. What a
class looks like is a row of ``PROFILES``; shares, ranges, ports and address blocks are
this package's own (addresses lie in blocks reserved for documentation and private use).
Letters stand for whole numbers of a line: ``k`` order, ``p`` part, ``s`` supplier, ``n`` line
number, ``e`` price, ``q`` quantity.
"""

from __future__ import annotations

from dataclasses import dataclass

# What triage rules look for; see ``operators.triage``.
BEACON = "CASE e % 3 WHEN 0 THEN 8443 WHEN 1 THEN 4444 ELSE 9001 END"


@dataclass(frozen=True)
class Profile:
    """One class: its share of a thousand lines and its columns as SQL text."""

    share: int
    label: str
    millis: str
    packets: str
    packet_bytes: str
    port: str
    protocol: str = "TCP"
    flags: str = "'NONE'"
    source: str = "inside"
    target: str = "server"


_WHOLE = "'SYN,ACK,PSH,FIN'"

# The five attacks share the first lines of each thousand evenly.
PROFILES = [
    Profile(28, "dns_exfiltration", "20000 + e % 30000", "400 + e % 500", "1150 + e % 200", "53", "UDP", target="outside"),
    Profile(28, "c2_beacon", "300000 + e % 200000", "3 + e % 4", "70 + q", BEACON, flags=_WHOLE, target="outside"),
    Profile(28, "port_scan", "1 + e % 2", "1", "40", "20 + (7 * e) % 1000", flags="CASE WHEN e % 4 = 0 THEN 'RST' ELSE 'SYN' END", source="outside"),
    Profile(28, "syn_flood", "200 + e % 800", "20000 + e % 60000", "60", "80", flags="'SYN'", source="outside"),
    Profile(28, "ssh_brute_force", "90 + e % 60", "120 + e % 80", "100 + q", "22", flags=_WHOLE, source="outside"),
    Profile(380, "benign", "120 + (e + 13 * q) % 5000", "9 + (e + 5 * q) % 90", "350 + e % 620", "CASE WHEN e % 3 = 0 THEN 80 ELSE 443 END", flags=_WHOLE, target="web"),
    Profile(180, "benign", "3 + e % 45", "2 + 2 * (e % 2)", "70 + e % 180", "53", "UDP"),
    Profile(160, "benign", "400 + e % 9000", "15 + (e + 3 * q) % 160", "500 + e % 450", "CASE WHEN e % 2 = 0 THEN 25 ELSE 587 END", flags=_WHOLE),
    Profile(100, "benign", "2000 + e % 20000", "60 + (e + q) % 700", "900 + e % 500", "873", flags="'SYN,ACK,PSH'"),
    Profile(40, "benign", "1 + e % 30", "1 + e % 3", "64 + 8 * (q % 4)", "0", "ICMP"),
]

ADDRESSES = {
    "inside": "'172.20.' || (1 + s % 7) || '.' || (20 + p % 60)",
    "server": "'172.21.' || (1 + p % 4) || '.' || (5 + s % 30)",
    "outside": "'198.51.100.' || (1 + (p + s) % 250)",
    "web": "'203.0.113.' || (1 + (3 * p + s) % 250)",
}


def per_class(text) -> str:
    """A CASE over the class code ``a`` with the text of each profile."""
    branches = " ".join(f"WHEN {code} THEN {text(profile)}" for code, profile in enumerate(PROFILES))
    return f"CASE a {branches} END"


def class_code() -> str:
    """The class of a line, by its number ``h`` from 0 to 999."""
    attacks = [p for p in PROFILES if p.label != "benign"]
    reach = sum(p.share for p in attacks)
    branches = [f"WHEN h < {reach} THEN (p + 2 * s + n) % {len(attacks)}"]
    for code, profile in list(enumerate(PROFILES))[len(attacks) : -1]:
        reach += profile.share
        branches.append(f"WHEN h < {reach} THEN {code}")
    return f"CASE {' '.join(branches)} ELSE {len(PROFILES) - 1} END"


# Steps of the derivation: each sees the columns of those before.
KEYS = {
    "k": "l_orderkey",
    "p": "l_partkey",
    "s": "l_suppkey",
    "n": "CAST(l_linenumber AS BIGINT)",
    "e": "CAST(floor(l_extendedprice) AS BIGINT)",
    "q": "CAST(floor(l_quantity) AS BIGINT)",
    "timestamp": "CAST(l_shipdate AS STRING)",
}
MIX = {"mix": "29 * k + 13 * n + 5 * p + 11 * s + e"}
SLOT = {"h": "mix % 1000"}
CODE = {"a": f"CAST({class_code()} AS INT)"}
SIZES = {
    "packet_count": f"CAST({per_class(lambda x: x.packets)} AS BIGINT)",
    "dur_ms": f"CAST({per_class(lambda x: x.millis)} AS BIGINT)",
}
FLOW = {
    "flow_id": "'L' || k || '-' || p || '-' || s || '-' || n || '-' || e",
    "byte_count": f"CAST(packet_count * ({per_class(lambda x: x.packet_bytes)}) AS BIGINT)",
    "src_ip": per_class(lambda x: ADDRESSES[x.source]),
    "dst_ip": per_class(lambda x: ADDRESSES[x.target]),
    "src_port": "CAST(49152 + (11 * k + 5 * n + e) % 16000 AS INT)",
    "dst_port": f"CAST({per_class(lambda x: x.port)} AS INT)",
    "protocol": per_class(lambda x: f"'{x.protocol}'"),
    "flow_duration": "CAST(dur_ms AS DOUBLE) / CAST(1000 AS DOUBLE)",
    "tcp_flags": per_class(lambda x: x.flags),
    "tos": "CAST(CASE WHEN a = 8 THEN 8 ELSE 0 END AS INT)",
    "label": per_class(lambda x: f"'{x.label}'"),
    "is_anomaly": "CAST(CASE WHEN a < 5 THEN 1 ELSE 0 END AS INT)",
}
STEPS = [KEYS, MIX, SLOT, CODE, SIZES, FLOW]
