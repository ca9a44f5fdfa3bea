import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from check_oracle import compare
from flowsift.llm import merkle
from flowsift.llm.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, more=0):
    row = [*row[:3], row[3] + more if row[3] is not None else None, row[4]]
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def climb(level, at):
    """Root over ``level``, siblings of place ``at`` and their sides."""
    siblings = []
    while len(level) > 1:
        other = at ^ 1
        siblings.append((at % 2, level[other] if other < len(level) else None))
        level = [H(*level[i : i + 2]) for i in range(0, len(level), 2)]
        at //= 2
    return level[0], siblings


def brute(rows):
    order = lambda v: (v is not None, v.encode() if isinstance(v, str) else v)
    langs = sorted({r[2] for r in rows}, key=order)
    trees = [sorted((r for r in rows if r[2] == lang), key=lambda r: (order(r[0]), leaf(r))) for lang in langs]
    subroots = [climb([leaf(r) for r in t], 0)[0] for t in trees]
    out = []
    for k, tree in enumerate(trees):
        level = [leaf(r) for r in tree]
        for i, row in enumerate(tree):
            subroot, below = climb(level, i)
            root, above = climb(subroots, k)
            hit = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0
            now = leaf(row, 1 if hit else 0)
            for side, other in below + above:
                now = H(now) if other is None else H(other, now) if side else H(now, other)
            proof = H(*[o for _, o in below + above if o is not None])
            out.append((row[0], level[i], subroot, root, proof, now, now == root))
    return sorted(out, key=repr)


def found(docs):
    got = merkle.check(docs).select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
    return sorted(map(tuple, got.collect()), key=repr)


def make(n, lang):
    return [(i * 7 % 1000, f"s{i % 3}", lang, i, f"text {i}") for i in range(n)]


@pytest.mark.parametrize("bits", [2, 10])
def test_trees_of_many_sizes(spark, stored, monkeypatch, bits):
    monkeypatch.setattr(merkle, "BLOCK_BITS", bits)
    rows = make(70, "a") + make(1, "b") + make(2, None) + make(33, "É") + make(4, "") + make(17, "z") + make(5, "zz")
    assert found(stored(rows, SCHEMA)) == brute(rows)


@pytest.mark.parametrize("n", [1, 3, 16])
def test_single_group(stored, n):
    rows = make(n, "en")
    assert found(stored(rows, SCHEMA)) == brute(rows)


def test_odd_rows(spark, stored):
    rows = [
        (None, None, None, None, None),
        (None, None, None, None, None),
        (1, "", "", 0, ""),
        (1, "", "", 0, ""),
        (1, "s", "en", None, "é\U0001f600\n"),
        (1, "s", "en", 5, "x" * 300_000),
        (-3, "s", "en", 2**63 - 1, "big"),
        (7, None, "en", 3, None),
    ]
    assert found(stored(rows, SCHEMA)) == brute(rows)
    assert found(stored([], SCHEMA)) == []


def test_hot_group_of_repeated_rows(stored):
    rows = [(5, "s", "en", 4, "same")] * 300 + make(20, "de")
    assert found(stored(rows, SCHEMA)) == brute(rows)


def test_steps_double(spark, stored):
    """Every path has one step a level, so its length tells the depth of both trees."""
    rows = make(70, "a") + make(3, "b")
    got = merkle.check(stored(rows, SCHEMA)).select(F.octet_length("path") / merkle.STEP_BYTES).collect()
    assert sorted(r[0] for r in got) == [3.0] * 3 + [8.0] * 70


def test_query_equals_sql(spark, con):
    result = compare("op11", spark, con, SF, QUERIES["op11_merkle_manifest"], SQL["op11_merkle_manifest"])
    assert result.startswith("ok") and "TYPES" not in result, result
