import zlib

import numpy as np

from flowsift.llm import quality_votes as q
from flowsift.llm.common import read_table

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs, labels = read_table(spark, SF, "documents"), read_table(spark, SF, "labels")
    got = {r.doc_id: r for r in q.score(docs, labels).collect()}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items())
    truth = {r.doc_id: r.quality for r in labels.collect() if got[r.doc_id].held_out}
    assert np.mean([got[i].predicted == y for i, y in truth.items()]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= q.CUT) for r in got.values())


def test_votes_are_those_of_all_cosines():
    texts = [f"{w} text number {k} " * (k % 4 + 1) for k, w in enumerate("### $$ the of and !! some other word".split())]
    buckets = q._buckets()
    rng = np.random.default_rng(1)
    v = q.Voters(np.ones(q.TERMS, np.float32), rng.normal(size=(q.TERMS, 6)).astype(np.float32), q._unit(rng.normal(size=(90, 6)).astype(np.float32)),
                 rng.integers(0, 2, 90).astype(float))
    got = v.score(texts, buckets)
    for t, g in zip(texts, got, strict=True):
        x = v.project([t], buckets)[0].astype(float)
        c = sorted(((float(x @ u), y) for u, y in zip(v.vectors.astype(float), v.labels, strict=True)), reverse=True)[: q.NEIGHBOURS]
        w = [np.exp(q.SHARPNESS * (a - 1)) for a, _ in c]
        assert abs(g - sum(a * y for a, (_, y) in zip(w, c, strict=True)) / sum(w)) < 1e-3


def test_odd_rows(spark, stored):
    rows = [(k, f"good plain words in a row {k}", "en", "s") for k in range(20)] + [(None, "x", None, None), (30, None, "en", "s"), (31, "", "en", "s"),
            (5, "good plain words in a row 5", "en", "s")]
    docs = stored(rows)
    labels = spark.createDataFrame([(k, k % 2) for k in range(20)] + [(3, None), (None, 1)], "doc_id long, quality int")
    got = q.score(docs, labels).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in q.score(docs, none).collect()} == {0.5}
    assert q.score(stored([]), labels).count() == 0
