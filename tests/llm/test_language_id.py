import math
import random
import re
from collections import Counter

import pytest

from flowsift.llm import language_id
from flowsift.llm.common import read_table
from flowsift.llm.queries import op8_language_id

SF = "/root/testdata/sf0.001"
SCHEMA = "page_id long, url string, html string"


def test_given_pages(spark):
    got = op8_language_id(spark, SF).collect()
    assert len(got) == read_table(spark, SF, "pages").count()
    assert sum(r.lang == r.declared for r in got) >= 0.98 * len(got)


def test_evidence_beyond_the_text(spark, stored):
    docs = stored([(1, "the house and the garden of the king", "en", "s"), (2, "das haus und der garten des königs", "DE", "s"), (3, "zzz", None, "s")])
    english = "<html lang='en'><article>the king and the garden</article></html>"
    german = "<html lang='de-AT'><article>der garten des königs und das haus</article></html>"
    rows = [(k, f"http://a.example.org/{k}", english) for k in range(30)] + [(k, f"http://b.beispiel.de/{k}", german) for k in range(30, 60)]
    rows += [
        (100, "http://b.beispiel.de/x", None),
        (101, None, "<html lang='de'><article></article></html>"),
        (102, "http://a.example.org/y", ""),
        (103, None, None),
        (104, "http://b.beispiel.de/q", english),
        (0, "http://a.example.org/0", english),
    ]
    got = {r.page_id: r for r in language_id.identify(stored(rows, SCHEMA), docs).collect()}
    assert [got[k].lang for k in (0, 30, 100, 101, 102)] == ["en", "de", "de", "de", "en"]
    assert got[104].text_lang == "en" and got[101].declared == "de" and got[103].lang in ("de", "en")
    assert all(0 < r.probability <= 1 for r in got.values())
    assert language_id.identify(stored([], SCHEMA), docs).count() == 0
    assert {r.lang for r in language_id.identify(stored(rows, SCHEMA), stored([])).collect()} == {None}


def brute(rows, docs):
    """Language and probability per row, by the formulas in plain Python."""
    letters = lambda t: [ord(chr(b).lower()) if b < 128 and chr(b).isalpha() else b if b >= 128 else 32 for b in t.encode()]

    def grams(text):
        raw = letters(text or "")
        codes = [(a << 16) | (b << 8) | c for a, b, c in zip(raw, raw[1:], raw[2:], strict=False)]
        return [(c * 0x9E3779B1 >> 12) % language_id.BUCKETS for c in codes if c != 0x202020]

    langs = sorted({d[2].lower() for d in docs if d[2]})
    counts = {x: Counter(g for d in docs if d[2] and d[2].lower() == x for g in grams(d[1])) for x in langs}
    sums = {x: sum(c.values()) + language_id.SMOOTHING * language_id.BUCKETS for x, c in counts.items()}

    def normal(logs):
        up = [math.exp(x - max(logs)) for x in logs]
        return [x / sum(up) for x in up]

    pages = []
    for _, url, html in rows:
        host = (url or "").split("//")[-1].split("/")[0].lower()
        text = " ".join(re.sub("<[^>]*>", "", x) for x in re.findall("<article>(.*?)</article>", html or ""))
        at = grams(text)
        weight = min(1, language_id.TEXT_EVIDENCE / max(1, len(at)))
        fit = [weight * sum(math.log((counts[x][g] + language_id.SMOOTHING) / sums[x]) for g in at) for x in langs]
        said = re.search("lang='([A-Za-z]+)", html or "")
        keys = (host or None, ".".join(host.split(".")[-2:]) if "." in host else None, host.split(".")[-1] or None,
                said and said.group(1).lower())
        pages.append((fit, normal(fit), keys))
    k = range(len(langs))
    total = [sum(p[1][i] for p in pages) for i in k]
    shares = [(t + 1 / len(langs)) / (sum(total) + 1) for t in total]
    pull = language_id.PRIOR_PAGES

    def pulled(at, key, prior):
        own = [p[1] for p in pages if key is not None and p[2][at] == key]
        of = [sum(p[i] for p in own) for i in k]
        return [(of[i] + pull * prior[i]) / (sum(of) + pull) for i in k] if own else prior

    out = []
    for fit, _, keys in pages:
        prior = pulled(0, keys[0], pulled(1, keys[1], shares))
        says = [[math.log(x / s) for x, s in zip(pulled(at, keys[at], shares), shares, strict=True)] for at in (2, 3)]
        p = normal([fit[i] + math.log(prior[i]) + says[0][i] + says[1][i] for i in k])
        out.append((langs[p.index(max(p))], max(p)))
    return out


def test_equal_to_plain_python_with_a_heavy_host(spark, stored):
    words = {"en": "the house and garden of king".split(), "de": "das haus und der garten des königs".split(), "fr": "la maison et le jardin du roi".split()}
    rng = random.Random(4)
    say = lambda x, n: " ".join(rng.choices(words[x], k=n))
    docs = [(k, say(x, 30), x.upper() if k % 2 else x, "s") for k, x in enumerate(list(words) * 6)] + [(99, None, "en", None), (98, "zz", None, "s")]
    rows = []
    for k in range(200):
        x = rng.choice(list(words))
        host = "big.example.org" if k % 2 else f"h{k % 9}.{rng.choice(['beispiel.de', 'exemple.fr', 'example.org'])}"
        said = rng.choice([f" lang='{x}'", "", " lang='en'"])
        rows.append((k, f"http://{host}/{k}", f"<html{said}><article>{say(x, rng.choice([0, 1, 3, 400]))}</article></html>"))
    rows += [(200, None, rows[0][2]), (201, "", None), (202, "http://big.example.org/", "<html><article>" + say("fr", 50_000) + "</article></html>"), rows[1]]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        for limit in (before, "-1"):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
            got = language_id.identify(stored(rows, SCHEMA), stored(docs)).collect()
            assert len(got) == len(rows)
            expected = dict(zip([r[0] for r in rows], brute(rows, docs), strict=True))
            for r in got:
                lang, p = expected[r.page_id]
                assert abs(r.probability - p) < 1e-4 and (r.lang == lang or abs(p - 0.5) < 1e-4), r
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_labels_that_are_no_codes_are_refused(spark, stored):
    docs = stored([(k, "x", f"l{k}", "s") for k in range(5)])
    with pytest.raises(ValueError, match="max_langs"):
        language_id.identify(stored([], SCHEMA), docs, max_langs=4)
