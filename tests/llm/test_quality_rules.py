import math
import re

import pytest
import xxhash

from flowsift.llm import quality_rules as q
from flowsift.llm.common import read_table

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def signed(n):
    return n - (1 << 64) if n >= 1 << 63 else n


def hash_long(n, seed):
    return xxhash.xxh64_intdigest((n & (1 << 64) - 1).to_bytes(8, "little"), seed)


def grams(words):
    h = [signed(xxhash.xxh64_intdigest(w.encode(), 42)) for w in words]
    pairs = [signed(hash_long(b, hash_long(a, 42))) for a, b in zip(h, h[1:], strict=False)]
    return [x % q.BUCKETS for x in h + pairs]


def statistics(text):
    w = WORD.findall(text)
    windows = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    seen = {x for x in windows if windows.count(x) > 1}
    covered = {i + k for i, x in enumerate(windows) if x in seen for k in range(5)}
    lines, dups, old = [x for x in text.split("\n") if WORD.search(x)], 0, set()
    for x in lines:
        dups += x in old
        old.add(x)
    return len(w), len("".join(w)), len(re.findall(r"[#*$%&|<>]", text)), dups, len(covered)


def brute(docs, trusted):
    raw, good = [0] * q.BUCKETS, [0] * q.BUCKETS
    for i, text in docs:
        for b in grams(WORD.findall(text or "")):
            raw[b] += 1
            good[b] += i in trusted
    share = sum(good) / sum(raw) if sum(good) else 1
    ratio = [math.log((g / share + q.SMOOTHING) / (r + q.SMOOTHING)) if sum(good) else 0 for g, r in zip(good, raw, strict=True)]
    out = []
    for i, text in docs:
        s = statistics(text or "")
        g = grams(WORD.findall(text or ""))
        llr = sum(ratio[b] for b in g) / len(g) if g else 0
        failed = s[0] < 10 or 100 * s[4] > 20 * s[0]
        out.append((i, *s, llr, failed, not failed and llr >= q.THRESHOLD))
    return out


def check(df, docs, trusted):
    key = lambda r: tuple((x is None, x or 0) for x in r[:6])
    got = sorted((tuple(r) for r in df.collect()), key=key)
    want = sorted(brute(docs, trusted), key=key)
    assert len(got) == len(want)
    for g, w in zip(got, want, strict=True):
        assert g[:6] == w[:6] and g[7:] == w[7:]
        assert g[6] == pytest.approx(w[6], abs=1e-9)


def test_given_documents(spark):
    docs, labels = read_table(spark, SF, "documents"), read_table(spark, SF, "labels")
    trusted = {r.doc_id for r in labels.where("quality = 1").collect()}
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    check(q.judge(docs, labels), texts, trusted)


def test_odd_rows(spark, stored):
    run = " ".join(f"w{i}" for i in range(12))
    texts = [(1, run), (1, run), (2, None), (3, ""), (4, " \n "), (None, run + " #|"), (5, f"{run}\n{run}\n\n{run}"),
             (6, "x " * 40), (7, "a b c d e f g a b c d e"), (8, "é ü " * 15)]
    docs = stored([(i, t, "en", "s") for i, t in texts])
    labels = spark.createDataFrame([(1, 1), (3, 0), (99, 1), (None, 1)], "doc_id long, quality int")
    check(q.judge(docs, labels), texts, {1})
    kept = q.keep_good(docs, labels)
    assert kept.columns == docs.columns
    none = spark.createDataFrame([], "doc_id long, quality int")
    check(q.judge(docs, none), texts, set())
    assert q.judge(stored([]), labels).count() == 0


def test_every_good_label_is_trusted(spark):
    n = 20_100
    labels = spark.range(n).selectExpr("id AS doc_id", "1 AS quality")
    assert q.trusted_ids(labels).count() == n
    docs = labels.selectExpr("doc_id", "concat('w', doc_id % 7) AS text")
    assert not q.fit_ratios(docs, labels).any()
