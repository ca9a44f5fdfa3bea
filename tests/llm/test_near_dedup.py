import random
import re

import pytest

from flowsift.llm import near_dedup as n
from flowsift.llm.common import read_table
from flowsift.llm.components import connected_components

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingle_set(text, length):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not w:
        return frozenset()
    if len(w) < length:
        return frozenset([tuple(w)])
    return frozenset(zip(*[w[k:] for k in range(length)], strict=False))


def brute(rows, length, percent):
    """(id, set size, smallest id of the component) of every row, by all pairs."""
    sets = [shingle_set(t, length) for _, t in rows]
    group = list(range(len(rows)))

    def top(x):
        while group[x] != x:
            x = group[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                group[top(a)] = top(b)
    out = []
    for a, (i, _) in enumerate(rows):
        ids = [rows[b][0] for b in range(len(rows)) if top(b) == top(a) and rows[b][0] is not None]
        out.append((i, len(sets[a]), min(ids, default=None) if sets[a] else i))
    return out


def check(df, rows, length, percent):
    key = lambda r: tuple((x is None, x or 0) for x in r)
    got = n.find_groups(df, length=length, percent=percent).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got), key=key) == sorted(brute(rows, length, percent), key=key)


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"e{rng.randrange(10**9)}"
    return words


def crowd():
    """Near copies of one text with few to many edits, texts around one passage, and a chain of versions."""
    rng = random.Random(11)
    base = [f"b{rng.randrange(5000)}" for _ in range(260)]
    rows = [" ".join(edited(rng, base, rng.randrange(2, 22))) for _ in range(90)]
    passage = [f"p{k}" for k in range(120)]
    for _ in range(40):
        rows.append(" ".join([f"u{rng.randrange(10**9)}" for _ in range(rng.choice([3, 8, 60, 120]))] + passage))
    version = [f"v{k}" for k in range(200)]
    for _ in range(12):
        version = edited(rng, version, 4)
        rows.append(" ".join(version))
    return [(500 + k, t) for k, t in enumerate(rows)]


ODD = [(1, None), (2, ""), (3, " \n"), (4, "one two"), (5, "ONE two"), (6, "one"), (None, "one two"), (7, "a b c d e f g h"),
       (7, "a b c d e f g h"), (8, "x " * 3000), (9, "É b c"), (10, "é b c")]


@pytest.mark.parametrize("length,percent", [(3, 85), (5, 80)])
def test_groups_equal_all_pairs(spark, stored, length, percent):
    rows = crowd() + ODD
    check(stored([(i, t, "en", "s") for i, t in rows]), rows, length, percent)


def test_given_documents(spark):
    docs = read_table(spark, SF, "documents")
    check(docs, [(r.doc_id, r.text) for r in docs.collect()], 3, 85)


def test_one_of_each_group_stays(spark, stored):
    docs = stored([(i, t, "en", "s") for i, t in ODD])
    kept = n.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    ids = sorted((r.doc_id for r in kept.collect()), key=lambda x: (x is None, x))
    assert ids == [1, 2, 3, 4, 6, 7, 8, 9, 10]
    assert n.find_groups(stored([])).count() == 0


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(60)] + [(100, 101)], "a long, b long")
    found = {r.node: r.comp for r in connected_components(edges).collect()}
    assert len({found[k] for k in range(61)}) == 1 and found[100] == found[101] != found[0]


def test_bounds():
    low = n._least_overlap(64, 85)
    assert low[10] == 9 and low[54] == 46 and 0 < low[64] < 46
    assert n._binomial_low(10, 0.5, 0.0) == 0
