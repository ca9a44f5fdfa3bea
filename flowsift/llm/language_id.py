"""Language of web pages by fusing four kinds of evidence with Bayes' rule.

* Text: hashed byte trigrams of the main text under one multinomial per language,
  counted over all labelled documents. Trigrams of a text depend on each other, so a
  text counts as ``TEXT_EVIDENCE`` independent ones at most.
* Declared language of the markup: how often a declaration goes with a language.
* Address suffix: the same for the last label of the host.
* Host prior: language shares of the host, drawn to those of its parent domain and
  these to those of all pages, each with the weight of ``PRIOR_PAGES`` pages.

The counts behind the last three are grouped sums, over all pages, of what the text
alone says, stored and joined back on their keys. A key with more pages than an even
partition holds is heavy: heavy keys are fewer than the session's shuffle partitions, so
their counts are broadcast, and their pages are dealt out by row number, not by key. Each
page ships a few numbers, never its text.

Edge cases: null or empty html has no text and no declaration, a null url no host and
no suffix; missing evidence is left out, and without any the shares of all pages
decide. Documents without language are not learnt from. Without any labelled document
there is no language to choose and the result is null. Labels are language codes, of which
there may be ``max_langs``; more are refused, as the model holds a row per label. Ties go to the first language
in code-point order. Repeated rows get equal results; an empty table gives none. Other
columns are not looked at, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowsift.llm.common import stored_rows, text_of
from flowsift.llm.html_text import page_lines
from flowsift.storage import materialize

BUCKETS = 32_768
TEXT_EVIDENCE = 100
PRIOR_PAGES = 5.0
SMOOTHING = 0.5
MAX_LANGS = 200
DECLARED = re.compile(r"<html\b[^>]*?\b(?:xml:)?lang\s*=\s*[\"']?\s*([A-Za-z]{2,8})", re.IGNORECASE)


def _letters() -> np.ndarray:
    """ASCII letters lower-cased and bytes of other letters; all else becomes a space."""
    table = np.full(256, 32, np.int64)
    for b in range(256):
        if b >= 128 or chr(b).isalpha():
            table[b] = ord(chr(b).lower()) if b < 128 else b
    return table


def trigrams(text: str | None, letters: np.ndarray) -> np.ndarray:
    """Bucket of every three bytes in a row that are not all spaces."""
    raw = letters[np.frombuffer((text or "").encode("utf-8", "replace"), np.uint8)]
    if len(raw) < 3:
        return np.zeros(0, np.int64)
    code = (raw[:-2] << 16) | (raw[1:-1] << 8) | raw[2:]
    code = code[code != 0x202020]
    return (code * 0x9E3779B1 >> 12) % BUCKETS


def fit_text(docs: DataFrame, text_col: str = "text", lang_col: str = "lang",
             max_langs: int = MAX_LANGS) -> tuple[list[str], np.ndarray]:
    """Languages and the log shares of their trigrams.

    Tasks send sums per language and bucket; the driver gets one array of fixed width per
    language, of which there are ``max_langs`` at most.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        letters, found = _letters(), {}
        for batch in batches:
            for lang, text in zip(batch["lang"], batch["t"], strict=True):
                sums = found.setdefault(lang, np.zeros(BUCKETS, np.int64))
                sums += np.bincount(trigrams(text, letters), minlength=BUCKETS)
        for lang, sums in found.items():
            at = np.flatnonzero(sums)
            yield pd.DataFrame({"lang": lang, "b": at, "n": sums[at]})

    known = docs.select(F.lower(F.col(f"`{lang_col}`").cast("string")).alias("lang"), text_of(f"`{text_col}`").alias("t"))
    known = known.where("lang IS NOT NULL")
    langs = sorted(r.lang for r in known.select("lang").distinct().limit(max_langs + 1).collect())
    if len(langs) > max_langs:
        raise ValueError(f"{lang_col} has more than max_langs = {max_langs} values; are they language codes?")
    sums = known.mapInPandas(count, "lang string, b long, n long").groupBy("lang", "b").agg(F.sum("n").alias("n"))
    counts = np.full((len(langs), BUCKETS), SMOOTHING)
    for row in sums.groupBy("lang").agg(F.collect_list("b").alias("b"), F.collect_list("n").alias("n")).toLocalIterator():
        counts[langs.index(row.lang), row.b] += row.n
    return langs, np.log(counts / counts.sum(1, keepdims=True)).astype(np.float32)


def _read(html: Column, model: np.ndarray, spark) -> Column:
    """Declared language and the text's log likelihood per language, of a page."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("struct<declared string, text array<double>>")
    def read(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        letters, logs = _letters(), shared.value
        for pages in batches:
            out = []
            for html in pages:
                lines = page_lines(html)
                text = " ".join(t for r, t in lines if r == "main") or " ".join(t for r, t in lines if r == "open")
                at = trigrams(text, letters)
                fit = logs[:, at].sum(1, dtype=np.float64) * min(1.0, TEXT_EVIDENCE / max(1, len(at)))
                said = DECLARED.search(html or "")
                out.append((said.group(1).lower() if said else None, fit.tolist()))
            yield pd.DataFrame(out, columns=["declared", "text"])

    return read(html)


def _normal(logs: Column) -> Column:
    """Probabilities of log weights."""
    top = F.array_max(logs)
    up = F.transform(logs, lambda x: F.exp(x - top))
    return F.transform(up, lambda x: x / F.aggregate(up, F.lit(0.0), lambda a, b: a + b))


def _summed(rows: DataFrame, key: str, n: int) -> DataFrame:
    """Pages, and expected pages per language as one array, for every value of a key."""
    sums = [F.sum(F.get("p", F.lit(k))).alias(f"s{k}") for k in range(n)]
    found = rows.where(F.col(key).isNotNull()).groupBy(F.col(key).alias(f"k_{key}")).agg(F.count("*").alias("pages"), *sums)
    return found.select(f"k_{key}", "pages", F.array(*[f"s{k}" for k in range(n)]).alias(f"c_{key}"))


def _with_counts(rows: DataFrame, keyed: DataFrame, key: str, n: int, size: int, row_no: str) -> DataFrame:
    """``rows`` with the counts of their key (from all of ``keyed``), null without a key."""
    counts = materialize(_summed(keyed, key, n), f"counts_{key}")
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    is_heavy = F.col("pages") * parts > size
    heavy = counts.where(is_heavy).select(F.col(f"k_{key}").alias("heavy_key"), F.col(f"c_{key}").alias("heavy_c"))
    light = counts.where(~is_heavy).select(F.col(f"k_{key}").alias("light_key"), F.lit(0).cast("long").alias("light_no"),
                                           F.col(f"c_{key}").alias("light_c"))
    out = rows.join(F.broadcast(heavy), F.col(key) == F.col("heavy_key"), "left")
    # Pages of heavy keys and pages without a key meet nothing here; their number spreads them.
    waits = F.col(key).isNotNull() & F.col("heavy_key").isNull()
    out = out.withColumn("wait_key", F.when(waits, F.col(key)).otherwise(F.lit("")))
    out = out.withColumn("wait_no", F.when(waits, F.lit(0).cast("long")).otherwise(F.col(row_no) + 1))
    out = out.join(light, (F.col("wait_key") == F.col("light_key")) & (F.col("wait_no") == F.col("light_no")), "left")
    return out.select(*rows.columns, F.coalesce("heavy_c", "light_c").alias(f"c_{key}"))


def identify(pages: DataFrame, docs: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
             max_langs: int = MAX_LANGS) -> DataFrame:
    """``page_id, url, lang, probability, text_lang, declared`` of every page."""
    langs, model = fit_text(docs, max_langs=max_langs)
    n = len(langs)
    url = F.col(f"`{url_col}`").cast("string")
    host = F.lower(F.regexp_extract(url, r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1))
    rows = pages.select(
        F.col(f"`{id_col}`").alias("page_id"), F.col(f"`{url_col}`").alias("url"), host.alias("host"), text_of(f"`{html_col}`").alias("html")
    )
    if not n:
        nothing = F.lit(None).cast("string")
        return rows.select("page_id", "url", nothing.alias("lang"), F.lit(None).cast("double").alias("probability"),
                           nothing.alias("text_lang"), nothing.alias("declared"))
    rows = rows.withColumn("r", _read(F.col("html"), model, pages.sparkSession))
    some = lambda c: F.when(F.length(c) > 0, c)
    rows = rows.select(
        "page_id",
        "url",
        some(F.col("host")).alias("host"),
        some(F.regexp_extract("host", r"([^.]+\.[^.]+)$", 1)).alias("domain"),
        some(F.regexp_extract("host", r"([^.]+)$", 1)).alias("suffix"),
        F.col("r.declared").alias("declared"),
        F.col("r.text").alias("text"),
        _normal(F.col("r.text")).alias("p"),
    )
    rows, row_no = stored_rows(rows, "page_evidence")

    # Sums over everything: one row.
    whole = rows.agg(*[F.sum(F.get("p", F.lit(k))).alias(f"s{k}") for k in range(n)], F.count("*").alias("pages")).first()
    total = [float(whole[f"s{k}"] or 0.0) for k in range(n)]
    size = sum(total)
    shares = [(t + 1 / n) / (size + 1) for t in total]

    out = rows
    for key in ("host", "domain", "suffix", "declared"):
        out = _with_counts(out, rows, key, n, whole["pages"], row_no)

    def pulled(counts: Column, prior: Column) -> Column:
        """Shares of counts with the prior as ``PRIOR_PAGES`` more pages."""
        of = F.aggregate(counts, F.lit(0.0), lambda a, b: a + b)
        mixed = F.transform(counts, lambda c, k: (c + PRIOR_PAGES * F.get(prior, k)) / (of + PRIOR_PAGES))
        return F.when(counts.isNull(), prior).otherwise(mixed)

    base = F.array(*[F.lit(s) for s in shares])
    out = out.withColumn("prior", pulled(F.col("c_domain"), base))
    out = out.withColumn("prior", pulled(F.col("c_host"), F.col("prior")))

    def given(counts: Column) -> Column:
        """Log of how much likelier the key is with a language than at all."""
        of = F.aggregate(counts, F.lit(0.0), lambda a, b: a + b)
        b = F.array(*[F.lit(s) for s in shares])
        return F.transform(counts, lambda c, k: F.log((c + PRIOR_PAGES * F.get(b, k)) / (of + PRIOR_PAGES) / F.get(b, k)))

    zero = F.array(*[F.lit(0.0)] * n)
    out = out.withColumn("declares", F.coalesce(given(F.col("c_declared")), zero))
    out = out.withColumn("ends", F.coalesce(given(F.col("c_suffix")), zero))
    logs = F.transform("text", lambda t, k: t + F.log(F.get("prior", k)) + F.get("declares", k) + F.get("ends", k))
    out = out.withColumn("logs", logs).withColumn("all", _normal(F.col("logs")))
    names = F.array(*[F.lit(x) for x in langs])
    best = lambda c: F.element_at(names, F.array_position(c, F.array_max(c)).cast("int"))
    return out.select(
        "page_id",
        "url",
        best(F.col("all")).alias("lang"),
        F.array_max("all").alias("probability"),
        best(F.col("text")).alias("text_lang"),
        "declared",
    )
