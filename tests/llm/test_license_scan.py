import random

import numpy as np

from flowsift.llm.license_scan import TEMPLATES, WORD, LicenseIndex, align, scan, winnowed


def test_whole_and_changed_notices(spark, stored):
    mit = TEMPLATES["MIT"].replace("free of charge", "gratis")
    texts = [f"İ start\n{mit} end", "Released under the MIT License.", "license of the software", None, "",
             f"{TEMPLATES['ISC']} and {TEMPLATES['ISC']}"]
    docs = stored([(k, t, "en", "s") for k, t in enumerate(texts)] + [(1, texts[1], "en", "s"), (None, texts[1], None, None)])
    got = scan(docs).collect()
    assert sorted((str(r.doc_id), r.template) for r in got) == [
        ("0", "MIT"), ("1", "MIT statement"), ("1", "MIT statement"), ("5", "ISC"), ("5", "ISC"), ("None", "MIT statement")]
    for r in got:
        if r.template == "MIT statement":
            assert (r.start, r.end, r.coverage) == (0, 30, 1.0)
    assert scan(stored([])).count() == 0


def test_alignment_equals_the_full_table():
    rng = random.Random(8)
    for _ in range(200):
        t, d = [[rng.randint(0, 4) for _ in range(rng.randint(1, 12))] for _ in range(2)]
        best, row = 0, [0] * (len(d) + 1)
        for x in t:
            new = [0]
            for j, y in enumerate(d):
                new.append(max(0, row[j] + (2 if x == y else -1), row[j + 1] - 1, new[j] - 1))
            row = new
            best = max(best, *row)
        pairs = align(t, d, 0, 12)
        assert all(t[i] == d[j] for i, j in pairs)
        assert all(a < c and b < e for (a, b), (c, e) in zip(pairs, pairs[1:], strict=False))
        gaps = sum(max(c - a, e - b) - 1 for (a, b), (c, e) in zip(pairs, pairs[1:], strict=False))
        assert 2 * len(pairs) - gaps >= best if pairs else best == 0


def test_five_shared_words_always_meet():
    rng = random.Random(3)
    for _ in range(300):
        run = [rng.randint(0, 9) for _ in range(5)]
        a = [rng.randint(-1, 9) for _ in range(8)] + run + [rng.randint(-1, 9) for _ in range(8)]
        b = [rng.randint(0, 9) for _ in range(3)] + run + [rng.randint(0, 9) for _ in range(3)]
        assert set(winnowed(np.array(a), 10).values()) & set(winnowed(np.array(b), 10).values())


def test_candidates_hold_every_template():
    index = LicenseIndex(TEMPLATES)
    for name, text in TEMPLATES.items():
        assert name in {m[0] for m in index.scan("x y z " + text + " x")}
        assert len(WORD.findall(text)) == len(index.templates[name])


def full_alignment(t, d):
    """Most matched words of any best local alignment, over the whole table."""
    best, row = (0, 0), [(0, 0)] * (len(d) + 1)
    for x in t:
        new = [(0, 0)]
        for j, y in enumerate(d):
            step = (row[j][0] + 2, row[j][1] + 1) if x == y else (row[j][0] - 1, row[j][1])
            gaps = [(row[j + 1][0] - 1, row[j + 1][1]), (new[j][0] - 1, new[j][1])]
            new.append(max((0, 0), step, *gaps))
        row = new
        best = max(best, *row)
    return best[1]


def test_query_finds_what_the_whole_table_finds(spark, stored):
    """Notices with a few changed words among other words, one per text, and texts without."""
    rng = random.Random(5)
    other = [f"w{k}" for k in range(300)]
    texts = []
    for name, text in TEMPLATES.items():
        for changes in (0, 0.02, 0.08, 0.5):
            words = [rng.choice(other) if rng.random() < changes else w for w in text.split()]
            texts.append(" ".join(rng.choices(other, k=40) + words + rng.choices(other, k=40)))
    texts += [" ".join(rng.choices(other, k=90)) for _ in range(5)]
    texts.append(" ".join(rng.choices(other, k=200_000)) + " " + TEMPLATES["ISC"])
    got = scan(stored([(k, t, "en", "s") for k, t in enumerate(texts)])).collect()
    found = {r.doc_id for r in got}
    words = {n: [w.lower() for w in WORD.findall(t)] for n, t in TEMPLATES.items()}
    for k, text in enumerate(texts[:-1]):
        d = [w.lower() for w in WORD.findall(text)]
        similar = [t for t in words.values() if full_alignment(t, d) >= 0.8 * len(t)]
        assert similar or k not in found, text
        # Winnowing promises a hit only where five words in a row are shared.
        runs = {tuple(d[i : i + 5]) for i in range(len(d))}
        assert k in found or not any(tuple(t[i : i + 5]) in runs for t in similar for i in range(len(t) - 4)), text
    assert len(texts) - 1 in found


def test_one_pass_over_the_texts(spark, stored):
    plan = scan(stored([(1, "x", "en", "s")]))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "ArrowEvalPython" not in plan
