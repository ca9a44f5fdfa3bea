"""Quality rules: base statistics and a hashed n-gram log-likelihood ratio.

Words and word pairs are hashed into a fixed number of buckets. Two multinomials are
counted over the buckets, one from all documents and one from trusted ones (rows
labelled as good quality), and a document's score is the mean over its n-grams of
``log p_trusted - log p_raw``. The mean makes scores of short and long documents
comparable. Whoever stays below the threshold goes; nothing is drawn at random.

Everything is built-in expressions: one pass over the corpus counts buckets (a task
ships at most ``BUCKETS`` partial sums), a second one scores. Arrays of a row are
folded inside the row. For the counts each text moves once, to the flag of its id: all
documents labelled as good are trusted, so their ids grow with the corpus and are not
broadcast. The flags are hashed per task, so texts are not sorted.

Edge cases: a null text has no words, and like an empty one fails the base rules. Its
score is 0. Rows whose id is null or not labelled count as raw only. Without any
trusted row all scores are 0 and only the base rules decide. Repeated rows count as
often as they occur and get equal verdicts. An empty table gives no rows. Other
columns are not looked at and, in ``keep_good``, kept whatever their names are.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowsift.llm.common import let, text_of, words_of

BUCKETS = 32_768
# Raw n-grams that every bucket holds beforehand, with the trusted share among them; it
# draws the ratios of rare buckets to 0, so small corpora do not punish rare words.
SMOOTHING = 20.0
THRESHOLD = -0.1
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
WINDOW = 5
# Fixed value: the characters that count as symbols.
SYMBOLS = "[#*$%&|<>]"


def base_statistics(text: Column, words: Column, hashes: Column) -> dict[str, Column]:
    """The base columns of a text; ``words`` and ``hashes`` are arrays that are at hand."""
    return {
        "n_words": F.size(words).cast("long"),
        "word_chars": F.char_length(F.array_join(words, "")).cast("long"),
        "n_symbols": (F.char_length(text) - F.char_length(F.regexp_replace(text, SYMBOLS, ""))).cast("long"),
        "n_dup_lines": let(
            F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")),
            lambda lines: F.size(lines) - F.size(F.array_distinct(lines)),
        ).cast("long"),
        "n_repeat_words": repeated_words(hashes).cast("long"),
    }


def repeated_words(hashes: Column, window: int = WINDOW) -> Column:
    """How many words lie in a window of words that the text holds twice or more.

    Windows are compared by a 64-bit hash. Most texts repeat none, which a distinct
    count tells; otherwise windows are sorted, those equal to a neighbour give their
    positions, and one pass over the sorted positions adds up what they cover.
    """
    at = [lambda i, k=k: F.element_at(hashes, i + k) for k in range(window)]
    windows = F.transform(F.sequence(F.lit(1), F.size(hashes) - (window - 1)), lambda i: F.xxhash64(*[f(i) for f in at]))

    def covered(found: Column) -> Column:
        placed = F.array_sort(F.transform(found, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return let(placed, lambda s: _length(_repeated_positions(s), window))

    return F.when(F.size(hashes) < window, 0).otherwise(
        let(windows, lambda w: F.when(F.size(F.array_distinct(w)) == F.size(w), 0).otherwise(covered(w)))
    )


def _repeated_positions(s: Column) -> Column:
    before = lambda i: (i > 0) & (F.get(s, i - 1)["h"] == F.get(s, i)["h"])
    after = lambda i: (i + 1 < F.size(s)) & (F.get(s, i + 1)["h"] == F.get(s, i)["h"])
    return F.array_sort(F.transform(F.filter(s, lambda _, i: before(i) | after(i)), lambda x: x["i"]))


def _length(positions: Column, window: int) -> Column:
    start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))

    def add(acc: Column, i: Column) -> Column:
        return F.struct((acc["n"] + i + window - F.greatest(i, acc["end"])).alias("n"), (i + window).alias("end"))

    return F.aggregate(positions, start, add, lambda acc: acc["n"])


def _buckets(hashes: Column) -> Column:
    """Bucket numbers of all words and word pairs."""
    pair = F.transform(
        F.sequence(F.lit(1), F.size(hashes) - 1),
        lambda i: F.pmod(F.xxhash64(F.element_at(hashes, i), F.element_at(hashes, i + 1)), F.lit(BUCKETS)).cast("int"),
    )
    single = F.transform(hashes, lambda h: F.pmod(h, F.lit(BUCKETS)).cast("int"))
    return F.when(F.size(hashes) < 2, single).otherwise(F.concat(single, pair))


def _hashes(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def trusted_ids(labels: DataFrame) -> DataFrame:
    """Ids of all rows labelled as good."""
    return labels.where("quality = 1 AND doc_id IS NOT NULL").select(F.col("doc_id").alias("trusted_id")).distinct()


def fit_ratios(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> np.ndarray:
    """Log ratio per bucket. The driver gets ``BUCKETS`` sums, whatever the input."""
    trusted = trusted_ids(labels).hint("shuffle_hash")
    rows = docs.select(F.col(f"`{id_col}`").alias("_id"), text_of(f"`{text_col}`").alias("_text"))
    rows = rows.join(trusted, F.col("_id") == F.col("trusted_id"), "left")
    found = rows.select(
        F.col("trusted_id").isNotNull().cast("int").alias("t"),
        F.explode(let(_hashes(words_of(F.col("_text"))), _buckets)).alias("b"),
    )
    sums = found.groupBy("b").agg(F.count("*").alias("raw"), F.sum("t").alias("trusted")).collect()
    raw, good = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for r in sums:
        raw[r["b"]], good[r["b"]] = r["raw"], r["trusted"]
    if not good.sum():
        return np.zeros(BUCKETS)

    share = good.sum() / raw.sum()
    return np.log((good / share + SMOOTHING) / (raw + SMOOTHING))


def mean_ratio(buckets: Column, ratios: np.ndarray) -> Column:
    """Mean log ratio of a text's n-grams; the ratios are a constant of fixed size."""
    table = F.lit(ratios)
    total = F.aggregate(buckets, F.lit(0.0), lambda acc, b: acc + F.get(table, b))
    return F.when(F.size(buckets) == 0, 0.0).otherwise(total / F.size(buckets))


def verdict(text: Column, ratios: np.ndarray, threshold: float) -> Column:
    """Statistics, score and verdict of a text as one struct.

    Words and hashes are bound inside the expression, so a filter on the verdict, which
    the optimizer moves to the scan, does not multiply what they cost.
    """

    def of(words: Column, hashes: Column) -> Column:
        stats = base_statistics(text, words, hashes)
        score = let(_buckets(hashes), lambda b: mean_ratio(b, ratios))
        return F.struct(*[c.alias(n) for n, c in stats.items()], score.alias("llr"))

    def judged(q: Column) -> Column:
        failed = (q["n_words"] < MIN_WORDS) | (100 * q["n_repeat_words"] > MAX_REPEAT_PERCENT * q["n_words"])
        return q.withField("base_failed", failed).withField("kept", ~failed & (q["llr"] >= threshold))

    return let(let(words_of(text), lambda w: let(_hashes(w), lambda h: of(w, h))), judged)


def judge(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document its statistics, score and verdict."""
    ratios = fit_ratios(docs, labels, id_col, text_col)
    judged = verdict(text_of(f"`{text_col}`"), ratios, threshold)
    return docs.select(F.col(f"`{id_col}`").alias("doc_id"), judged.alias("q")).select("doc_id", "q.*")


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that pass, with all their columns."""
    ratios = fit_ratios(docs, labels, id_col, text_col)
    return docs.where(verdict(text_of(f"`{text_col}`"), ratios, threshold)["kept"])
