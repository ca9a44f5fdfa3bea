"""Encoding and decoding with a public SentencePiece model, as a relational lattice.

A text becomes words: runs of the space mark with what follows, no piece reaches over
their borders. For the distinct words of the corpus every substring of up to the
longest piece's length is a row; an equi-join with the piece table leaves the edges of
each word's lattice; edges are grouped by word and folded with ``aggregate``.

The fold depends on the kind of model. For unigram models it is Viterbi: best sum of
scores up to each position. The public model is a BPE model, whose scores are merge
ranks and not log probabilities; the best sum differs from the library's result. There
the fold applies edges in rank order to the set of symbol borders (bits of a number):
an edge joins two symbols if both its ends are borders and exactly one lies between.
One pass over the edges is exact unless a piece can also be put together from pieces
of later rank; words with such an edge take one pass per symbol.

Words of more than ``FOLD_CHARS`` characters, of which a text can consist as a whole,
are merged by heap and linked list in ``n log n`` instead.

Ids come back to documents by blocks of neighbouring rows (``encode_by_join``, which the
pipeline uses): distinct words with the blocks that hold them are joined with their pieces,
sorted in front of each block's documents, and looked up while these stream by. A task holds
the words of one block. Texts move once, and documents keep their order.

``encode`` looks words up and merges them inside the task that reads the document, with a
bounded memory of words seen; it gives the same ids, shuffles nothing, and is what the
query uses. ``encode_words`` gives the pieces of a vocabulary.

Edge cases: a null or empty text has no pieces. Characters without a piece become one
piece per byte. The space mark itself decodes to a space, as in the library. Repeated
rows get equal results; an empty table gives none; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Callable, Iterator
from functools import cached_property, lru_cache
from itertools import pairwise

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2 as model_pb

from flowsift.llm.common import let, placed_rows, text_of
from flowsift.storage import materialize

MARK = "▁"
FOLD_CHARS = 60
SCAN_CHARS = 24
MEMO = 200_000
# Documents of a task that are held as ids at a time.
ROWS = 500
# Documents that share a list of words in the relational form, as a power of two.
BLOCK_BITS = 11
# Distinct words whose edges a task sorts.
WORDS_TASK = 20_000
# Distinct words of a block that a task holds before it hands them on.
WORDS_HELD = 500_000
# Piece types of the model format, and the id of byte 0.
NORMAL, BYTE = 1, 6
WORDS = rf"[\n\t\r]|{MARK}*[^{MARK}\n\t\r]+|{MARK}+"


class PieceTable:
    """Pieces of a model file: ``text -> (rank, id)``, in merge order."""

    def __init__(self, path: str):
        proto = model_pb.ModelProto()
        with open(path, "rb") as f:
            proto.ParseFromString(f.read())
        self.is_bpe = proto.trainer_spec.model_type == model_pb.TrainerSpec.BPE
        self.pieces = {p.piece: (-p.score, k) for k, p in enumerate(proto.pieces) if p.type == NORMAL}
        self.ranks = {p: r for p, (r, _) in self.pieces.items()}
        self.bytes = {int(p.piece[3:5], 16): k for k, p in enumerate(proto.pieces) if p.type == BYTE}
        # Byte pieces as characters that UTF-8 turns back into the byte.
        self.names = [p.piece.replace(MARK, " ") for p in proto.pieces]
        for b, k in self.bytes.items():
            self.names[k] = chr(b) if b < 128 else chr(0xDC00 + b)
        self.longest = max(map(len, self.pieces))

    @cached_property
    def late(self) -> set[str]:
        """Pieces that pieces of later rank can make."""
        return {p for p in self.pieces if self._is_late(p)}

    def _is_late(self, piece: str) -> bool:
        """Whether two pieces of later rank can make it."""
        rank = self.pieces[piece][0]
        for k in range(1, len(piece)):
            parts = piece[:k], piece[k:]
            if all(len(x) == 1 or x in self.pieces for x in parts):
                if any(len(x) > 1 and self.pieces[x][0] >= rank for x in parts):
                    return True
        return False

    def frame(self, spark: SparkSession) -> DataFrame:
        """The table as rows; its size is that of the model file."""
        rows = [(p, float(r), k, p in self.late) for p, (r, k) in self.pieces.items()]
        return spark.createDataFrame(rows, "piece string, rank double, id int, late boolean")

    def symbols(self, word: str) -> list[str]:
        """Pieces of a word by merging the best-ranked neighbours, leftmost first."""
        return self._scanned(word) if len(word) <= SCAN_CHARS else self._heaped(word)

    def _scanned(self, word: str) -> list[str]:
        """For short words: look at all neighbours before each merge."""
        parts, ranks, none = list(word), self.ranks, float("inf")
        costs = [ranks.get(a + b, none) for a, b in zip(parts, parts[1:], strict=False)]
        while costs:
            best = min(costs)
            if best == none:
                break
            i = costs.index(best)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del costs[i]
            if i:
                costs[i - 1] = ranks.get(parts[i - 1] + parts[i], none)
            if i < len(costs):
                costs[i] = ranks.get(parts[i] + parts[i + 1], none)
        return parts

    def _heaped(self, word: str) -> list[str]:
        """The same in ``n log n``."""
        parts, n = list(word), len(word)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap: list[tuple[float, int, str]] = []

        def offer(i: int, j: int) -> None:
            both = parts[i] + parts[j]
            if both in self.pieces:
                heapq.heappush(heap, (self.pieces[both][0], i, both))

        for i in range(n - 1):
            offer(i, i + 1)
        while heap:
            _, i, both = heapq.heappop(heap)
            j = after[i]
            if not parts[i] or j >= n or parts[i] + parts[j] != both:
                continue
            parts[i], parts[j] = both, ""
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
                offer(i, after[i])
            if before[i] >= 0:
                offer(before[i], i)
        return [p for p in parts if p]

    def word_ids(self, word: str) -> list[int]:
        ids: list[int] = []
        for s in self.symbols(word):
            if s in self.pieces:
                ids.append(self.pieces[s][1])
            else:
                ids.extend(self.bytes[b] for b in s.encode("utf-8", "replace"))
        return ids

    def decode(self, ids: list[int]) -> str:
        """The text of a piece sequence, without the space in front."""
        text = "".join(map(self.names.__getitem__, ids)).encode("utf-8", "surrogateescape").decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


class _Memo(dict):
    """Ids of words seen by a task, as 32-bit numbers in bytes; when full it forgets all."""

    def __init__(self, table: PieceTable):
        self.table = table
        self.words = re.compile(WORDS)

    def __missing__(self, word: str) -> bytes:
        ids = np.array(self.table.word_ids(word), np.int32).tobytes()
        if len(word) <= FOLD_CHARS:
            if len(self) >= MEMO:
                self.clear()
            self[word] = ids
        return ids

    def encode(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, self.words.findall(_marked(text))))


@lru_cache(2)
def table(path: str) -> PieceTable:
    return PieceTable(path)


def _lattice(words: DataFrame, pieces: DataFrame, longest: int) -> DataFrame:
    """``word, edges``: all pieces that lie in a word, by rank and place."""
    n = F.length("word")
    start = words.select("word", F.explode(F.sequence(F.lit(1), n)).alias("s"))
    ends = F.sequence(F.col("s"), F.least(F.length("word"), F.col("s") + (longest - 1)))
    spans = start.select("word", "s", F.explode(ends).alias("t"))
    spans = spans.select("word", (F.col("s") - 1).alias("s"), F.col("t").alias("e"), F.expr("substring(word, s, t - s + 1)").alias("piece"))
    # The piece table has the fixed size of the model. A word without any piece keeps its first span, which is no edge.
    found = spans.join(F.broadcast(pieces), "piece", "left").where("id IS NOT NULL OR s = 0 AND e = 1")
    edge = F.when(F.col("id").isNotNull(), F.struct("rank", "s", "e", "id", "late"))
    return found.groupBy("word").agg(F.array_sort(F.collect_list(edge)).alias("edges"))


def _bit(i: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), i)


def _merged(word: Column, edges: Column) -> Column:
    """Borders that are left when edges are applied in rank order, as bits."""
    every = _bit(F.length(word) + 1) - 1
    inner = lambda e: _bit(e["e"]) - _bit(e["s"] + 1)

    def fits(mask: Column, e: Column) -> Column:
        ends = _bit(e["s"]).bitwiseOR(_bit(e["e"]))
        return (mask.bitwiseAND(ends) == ends) & (F.bit_count(mask.bitwiseAND(inner(e))) == 1)

    def apply(mask: Column, e: Column) -> Column:
        return mask.bitwiseAND(F.bitwise_not(inner(e)))

    once = F.aggregate(edges, every, lambda mask, e: F.when(fits(mask, e), apply(mask, e)).otherwise(mask))

    def step(mask: Column, _: Column) -> Column:
        best = F.get(F.filter(edges, lambda e: fits(mask, e)), F.lit(0))
        return let(best, lambda e: F.when(e.isNull(), mask).otherwise(apply(mask, e)))

    slow = F.aggregate(F.sequence(F.lit(1), F.length(word)), every, step)
    return F.when(F.exists(edges, lambda e: e["late"]), slow).otherwise(once)


def _best_sum(word: Column, edges: Column) -> Column:
    """Borders of the path with the best sum of scores, as bits: Viterbi over positions.

    A character that no piece covers is an edge that costs more than any piece.
    """
    missing = F.lit(1e9)
    first = F.array(F.struct(F.lit(0.0).alias("cost"), F.lit(1).cast("long").alias("mask")))

    def step(best: Column, end: Column) -> Column:
        alone = let(F.element_at(best, -1), lambda b: F.struct((b["cost"] + missing).alias("cost"), b["mask"].bitwiseOR(_bit(end)).alias("mask")))
        through = F.transform(
            F.filter(edges, lambda e: e["e"] == end),
            lambda e: let(
                F.get(best, e["s"]),
                lambda b: F.struct((b["cost"] + e["rank"]).alias("cost"), b["mask"].bitwiseOR(_bit(end)).alias("mask")),
            ),
        )
        return F.concat(best, F.array(F.array_min(F.concat(F.array(alone), through))))

    return F.element_at(F.aggregate(F.sequence(F.lit(1), F.length(word)), first, step), -1)["mask"]


def _ids(word: Column, edges: Column, mask: Column, first_byte: int) -> Column:
    """Piece ids between the borders; a character without a piece gives its bytes."""
    borders = F.filter(F.sequence(F.lit(0), F.length(word)), lambda i: mask.bitwiseAND(_bit(i)) != 0)

    def of(b: Column) -> Column:
        def one(k: Column) -> Column:
            s, e = F.get(b, k), F.get(b, k + 1)
            hexes = F.hex(F.encode(F.substring(word, s + 1, F.lit(1)), "UTF-8"))
            raw = F.transform(
                F.sequence(F.lit(0), (F.length(hexes) / 2 - 1).cast("int")),
                lambda x: F.conv(F.substring(hexes, x * 2 + 1, F.lit(2)), 16, 10).cast("int") + first_byte,
            )
            hit = F.filter(edges, lambda x: (x["s"] == s) & (x["e"] == e))
            return let(hit, lambda h: F.when(F.size(h) > 0, F.transform(h, lambda x: x["id"])).otherwise(raw))

        return F.flatten(F.transform(F.sequence(F.lit(0), F.size(b) - 2), one))

    return let(borders, of)


def encode_words(words: DataFrame, path: str) -> DataFrame:
    """``word, ids`` of distinct words."""
    spark, t = words.sparkSession, table(path)
    # Dealt out by word before the spans are made, so that spans and edges are not shuffled, in parts that fit into memory.
    short = words.where(F.length("word") <= FOLD_CHARS).repartition(words.count() // WORDS_TASK + 1, "word")
    lattice = _lattice(short, t.frame(spark), t.longest)
    fold = _merged if t.is_bpe else _best_sum
    mask = fold(F.col("word"), F.col("edges"))
    ids = let(mask, lambda m: _ids(F.col("word"), F.col("edges"), m, t.bytes[0]))
    long = words.where(F.length("word") > FOLD_CHARS)
    return lattice.select("word", ids.alias("ids")).unionByName(long.select("word", _merge_udf(path)(F.col("word")).alias("ids")))


def _merge_udf(path: str):
    @F.pandas_udf("array<int>")
    def merge(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        t = PieceTable(path)
        for words in batches:
            yield pd.Series([t.word_ids(w) for w in words], dtype=object)

    return merge


def encode_by_join(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", stored: bool = False) -> DataFrame:
    """``doc_id, ids`` of every document, relationally, in the order of ``docs``.

    ``stored=True`` states that ``docs`` reads Parquet files, as for ``placed_rows``.
    """
    docs, [row_no] = placed_rows(docs.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`")), "piece_rows", stored)
    rows = docs.select(
        F.shiftright(F.col(row_no), BLOCK_BITS).alias("block"),
        F.col(row_no).alias("row_no"),
        F.col(f"`{id_col}`").alias("doc_id"),
        text_of(f"`{text_col}`").alias("text"),
    )
    used = rows.select("block", "text").mapInArrow(_block_words, "block long, words array<string>")
    used = used.select("block", F.explode("words").alias("word"))
    words = materialize(used.groupBy("word").agg(F.collect_list("block").alias("blocks")), "words")
    known = materialize(encode_words(words.select("word"), path), "word_pieces")
    doc_id = rows.schema["doc_id"].dataType
    # Words come before the documents of their block: they have no row number.
    entries = words.join(known, "word").select(
        F.explode("blocks").alias("block"),
        F.lit(None).cast("long").alias("row_no"),
        F.lit(None).cast(doc_id).alias("doc_id"),
        F.col("word").alias("text"),
        "ids",
    )
    both = entries.unionByName(rows.withColumn("ids", F.lit(None).cast("array<int>")))
    both = both.repartitionByRange("block").sortWithinPartitions("block", F.asc_nulls_first("row_no"))
    return both.mapInArrow(_look_up, f"doc_id {doc_id.simpleString()}, ids array<int>")


def _block_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``block, words`` of neighbouring documents; a block in several tasks, or of very many words, has several rows."""
    cut = re.compile(WORDS)
    block, seen = None, set()

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"block": pa.array([block], pa.int64()), "words": pa.array([list(seen)], pa.list_(pa.string()))})

    for batch in batches:
        for b, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if seen and (b != block or len(seen) > WORDS_HELD):
                yield row()
                seen = set()
            block = b
            seen.update(cut.findall(_marked(text)))
    if seen:
        yield row()


def _look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``doc_id, ids`` of documents from the words of their block, which come first."""
    cut = re.compile(WORDS)
    block, known = None, {}
    for batch in batches:
        blocks, is_doc = batch.column(0).to_numpy(), batch.column(1).is_valid().to_numpy(zero_copy_only=False)
        borders = np.flatnonzero((np.diff(blocks) != 0) | (is_doc[1:] != is_doc[:-1])) + 1
        for start, end in pairwise([0, *borders.tolist(), batch.num_rows]):
            if start == end:
                continue
            if blocks[start] != block:
                block, known = blocks[start], {}
            if not is_doc[start]:
                ids = batch.column(4).slice(start, end - start)
                ends = np.cumsum([0, *ids.value_lengths().to_pylist()]) * 4
                flat = ids.flatten().to_numpy().astype(np.int32).tobytes()
                known.update((w, flat[i:j]) for w, (i, j) in zip(batch.column(3).slice(start, end - start).to_pylist(), pairwise(ends.tolist()), strict=True))
                continue
            for k in range(start, end, ROWS):
                part = batch.slice(k, min(ROWS, end - k))
                found = [b"".join(map(known.__getitem__, cut.findall(_marked(t)))) for t in part.column(3).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(2), _id_lists(found)], ["doc_id", "ids"])


def _marked(text: str) -> str:
    """The text in the model's notation."""
    return MARK + text.replace(" ", MARK) if text else ""


def _id_lists(found: list[bytes]) -> pa.Array:
    ends = np.cumsum([0, *(len(x) // 4 for x in found)], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(found), np.int32)))


def _in_task(docs: DataFrame, path: str, fields: str, columns: Callable, id_col: str, text_col: str) -> DataFrame:
    """``doc_id`` and the columns that ``columns(memo, texts)`` makes, a few rows at a time."""
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), text_of(f"`{text_col}`").alias("text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = _Memo(PieceTable(path))
        for batch in batches:
            for k in range(0, batch.num_rows, ROWS):
                part = batch.slice(k, ROWS)
                made = columns(memo, part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), *made.values()], ["doc_id", *made])

    return rows.mapInArrow(work, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, {fields}")


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, ids`` of every document, without a shuffle."""

    def columns(memo: _Memo, texts: list[str]) -> dict[str, pa.Array]:
        return {"ids": _id_lists([memo.encode(t) for t in texts])}

    return _in_task(docs, path, "ids array<int>", columns, id_col, text_col)


def decode(ids: Column, path: str) -> Column:
    """The texts of piece sequences."""

    @F.pandas_udf("string")
    def text(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        t = PieceTable(path)
        for rows in batches:
            yield pd.Series([t.decode(list(r)) for r in rows], dtype=object)

    return text(ids)


def checked(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: ``n_pieces``, a digest of its ids and whether decoding gives the text.

    The digest is the SHA-256 of the ids as little-endian 32-bit numbers. The model has
    one mark for spaces, so a mark in the text comes back as a space.
    """

    def columns(memo: _Memo, texts: list[str]) -> dict[str, pa.Array]:
        found = [memo.encode(t) for t in texts]
        back = [memo.table.decode(np.frombuffer(x, "<i4").tolist()) for x in found]
        return {
            "n_pieces": pa.array([len(x) // 4 for x in found], pa.int64()),
            "ids_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in found], pa.string()),
            "round_trip": pa.array([b == t.replace(MARK, " ") for b, t in zip(back, texts, strict=True)], pa.bool_()),
        }

    return _in_task(docs, path, "n_pieces bigint, ids_sha256 string, round_trip boolean", columns, id_col, text_col)
