"""Rows keep their numbers when a later scan of the table is split otherwise."""

from collections import Counter

import pytest

from flowsift.llm import exact_dedup, mixing, near_dedup
from flowsift.storage import materialize

ROWS = [(i, " ".join(f"w{i % 20}x{k}" for k in range(30)), "en", f"s{i % 3}") for i in range(60)]


@pytest.fixture
def split_anew(spark, monkeypatch):
    """After the first stored intermediate table scans are split smaller, as with other executors."""
    small = {"spark.sql.files.maxPartitionBytes": "1500", "spark.sql.files.openCostInBytes": "1"}
    old = {k: spark.conf.get(k) for k in small}

    def store(df, name):
        out = materialize(df, name)
        for k, v in small.items():
            spark.conf.set(k, v)
        return out

    for module in (exact_dedup, mixing, near_dedup):
        monkeypatch.setattr(module, "materialize", store)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def test_exact_copies(stored, split_anew):
    kept = exact_dedup.drop_duplicates(stored(ROWS)).collect()
    assert sorted(r.doc_id for r in kept) == list(range(40, 60))


def test_near_copies(stored, split_anew):
    rows = [(i, f"{t} end{i}", lang, source) for i, t, lang, source in ROWS]
    kept = near_dedup.drop_near_duplicates(stored(rows)).collect()
    assert sorted(r.doc_id for r in kept) == list(range(20))
    found = near_dedup.find_groups(stored(rows)).collect()
    assert {r.doc_id: r.component_id for r in found} == {i: i % 20 for i in range(60)}


def test_mix(stored, split_anew):
    rows = [(i, " ".join(f"w{i}x{k * k}" for k in range(5 * i + 1)), "en", f"s{i % 3}") for i in range(60)]
    docs = stored(rows)
    want = {r.doc_id: r.taken for r in mixing.taken_per_document(docs, block_tokens=16).collect()}
    got = Counter()
    for r in mixing.mixed_documents(docs, block_tokens=16).collect():
        got[r.doc_id] += len(r.text.split())
    assert got == Counter({k: v for k, v in want.items() if v})
