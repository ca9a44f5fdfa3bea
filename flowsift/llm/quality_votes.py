"""Quality scores by voting of the nearest labelled documents in a latent space.

Terms are pairs of neighbouring bytes, hashed, and immediate repetitions of a word. A
document is the square roots of its term shares times inverse document frequencies
(counted over all documents), projected on the leading singular vectors of the
labelled sample. The labelled vectors are broadcast; each block of documents is
multiplied with all of them, which gives exact cosines, and the ``NEIGHBOURS`` nearest
vote with weights that fall off with the angle.

Labels are learnt from rows whose CRC-32 of the id, modulo 5, is not 0, and of those
from at most ``MAX_LABELLED``, the first by hash: the bound of the broadcast and of the
fit. Everything else covers all documents.

Edge cases: a null or empty text, or one without a term, has no direction and gets the
share of label 1 in the sample. Without labelled rows every score is 0.5. Null ids are
scored and count as not held out, but are never learnt from. Of several labels of an
id the largest counts; repeated rows get equal scores. An empty table gives no rows.
Other columns are not looked at, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowsift.llm.common import text_of

TERMS = 2048
LATENT = 48
MAX_LABELLED = 4000
NEIGHBOURS = 25
SHARPNESS = 30.0
CUT = 0.3
BLOCK = 1024
# How many byte pairs one immediate repetition of a word counts for.
REPEAT_WEIGHT = 4


def _buckets() -> np.ndarray:
    """Bucket of each byte pair; the last bucket is left to repetitions."""
    pairs = np.arange(65536, dtype=np.uint64)
    return ((pairs * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)).astype(np.int64) % (TERMS - 1)


def term_counts(text: str | None, buckets: np.ndarray) -> np.ndarray:
    raw = np.frombuffer((text or "").encode("utf-8", "replace"), dtype=np.uint8).astype(np.int64)
    counts = np.bincount(buckets[raw[:-1] * 256 + raw[1:]], minlength=TERMS) if len(raw) > 1 else np.zeros(TERMS, np.int64)
    words = (text or "").split()
    counts[-1] = REPEAT_WEIGHT * sum(map(str.__eq__, words, words[1:]))
    return counts


def _shares(texts: list[str | None], buckets: np.ndarray) -> np.ndarray:
    found = np.empty((len(texts), TERMS), np.float32)
    for k, t in enumerate(texts):
        counts = term_counts(t, buckets)
        found[k] = np.sqrt(counts / max(1, counts.sum()))
    return found


def _unit(rows: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(rows, axis=1, keepdims=True)
    return np.divide(rows, length, out=np.zeros_like(rows), where=length > 1e-12)


@dataclass
class Voters:
    """What scoring needs; its size is bounded by the constants above."""

    idf: np.ndarray
    axes: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray

    def project(self, texts: list[str | None], buckets: np.ndarray) -> np.ndarray:
        return _unit((_shares(texts, buckets) * self.idf) @ self.axes)

    def score(self, texts: list[str | None], buckets: np.ndarray) -> np.ndarray:
        if not len(self.labels):
            return np.full(len(texts), 0.5)
        rows = self.project(texts, buckets)
        cosines = rows @ self.vectors.T
        k = min(NEIGHBOURS, len(self.labels))
        near = np.argpartition(-cosines, k - 1, axis=1)[:, :k]
        weight = np.exp(SHARPNESS * (np.take_along_axis(cosines, near, 1).astype(np.float64) - 1))
        votes = (weight * self.labels[near]).sum(1) / weight.sum(1)
        return np.where(np.abs(rows).sum(1) > 0, votes, self.labels.mean())


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def document_frequencies(docs: DataFrame, text_col: str = "text") -> tuple[np.ndarray, int]:
    """In how many documents each term occurs, and the number of documents.

    A task sends one row per term, summed before the shuffle; the driver gets
    ``TERMS`` sums.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        buckets, found, n = _buckets(), np.zeros(TERMS, np.int64), 0
        for batch in batches:
            for t in batch["t"]:
                found += term_counts(t, buckets) > 0
                n += 1
        yield pd.DataFrame({"term": np.arange(TERMS + 1), "n": np.append(found, n)})

    texts = docs.select(text_of(f"`{text_col}`").alias("t"))
    sums = texts.mapInPandas(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    found = np.zeros(TERMS + 1, np.int64)
    for r in sums:
        found[r["term"]] = r["n"]
    return found[:-1], int(found[-1])


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Voters:
    frequency, n = document_frequencies(docs, text_col)
    idf = (np.log((1 + n) / (1 + frequency)) + 1).astype(np.float32)
    known = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").where(~held_out(F.col("doc_id")))
    known = known.groupBy(F.col("doc_id").alias("known_id")).agg(F.max("quality").alias("label"))
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), text_of(f"`{text_col}`").alias("t"))

    def vectors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        buckets = _buckets()
        for batch in batches:
            found = _shares(list(batch["t"]), buckets)
            yield pd.DataFrame({"id": batch["id"], "label": batch["label"], "v": [r.tobytes() for r in found]})

    # The ids of the sample are broadcast, MAX_LABELLED at most.
    first = F.broadcast(known.orderBy(F.xxhash64("known_id"), "known_id").limit(MAX_LABELLED))
    chosen = rows.join(first, F.col("id") == F.col("known_id")).select("id", F.col("label").cast("double"), "t")
    sample = chosen.mapInPandas(vectors, "id long, label double, v binary")
    # Repeated rows of an id count once, so the sample keeps its bound.
    sample = sample.groupBy("id").agg(F.max("label").alias("label"), F.max("v").alias("v")).orderBy("id").collect()
    if not sample:
        return Voters(idf, np.zeros((TERMS, 1), np.float32), np.zeros((0, 1), np.float32), np.zeros(0))
    shares = np.stack([np.frombuffer(r["v"], np.float32) for r in sample])
    weighted = _unit(shares * idf)
    values, axes = np.linalg.eigh((weighted.T @ weighted).astype(np.float64))
    axes = axes[:, np.argsort(values)[::-1][: min(LATENT, len(sample))]].astype(np.float32)
    return Voters(idf, axes, _unit((shares * idf) @ axes), np.array([r["label"] for r in sample]))


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", cut: float = CUT) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document."""
    fitted = fit(docs, labels, id_col, text_col)
    # Plain arrays, so that workers need no import to read them.
    shared = docs.sparkSession.sparkContext.broadcast((fitted.idf, fitted.axes, fitted.vectors, fitted.labels))

    @F.pandas_udf("double")
    def vote(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        voters, buckets = Voters(*shared.value), _buckets()
        for texts in batches:
            texts = list(texts)
            blocks = [voters.score(texts[k : k + BLOCK], buckets) for k in range(0, len(texts), BLOCK)]
            yield pd.Series(np.concatenate(blocks) if blocks else [], dtype="float64")

    id_ = F.col(f"`{id_col}`")
    out = docs.select(id_.alias("doc_id"), held_out(id_).alias("held_out"), vote(text_of(f"`{text_col}`")).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= cut).cast("int"))
