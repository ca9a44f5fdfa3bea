"""Token counts of byte-level byte-pair encoding, without producing identifiers.

A text is cut by the special strings of the vocabulary and then by the pattern of
byte-level encoders. Each piece starts as one symbol per byte in a linked list; a
heap holds the adjacent pairs that have a merge, lowest rank first and leftmost
first among equals. Every pop that is still valid joins two symbols, so the count is
the number of bytes minus the number of merges.

The text never leaves its task, and nothing is shuffled. Pieces repeat, so each
worker remembers the counts of up to ``MEMO`` short pieces and forgets all when full:
memory is bounded and results do not depend on it.

Edge cases: a null or empty text has 0 bytes and 0 tokens. A very long piece costs
``n log n``. Repeated rows give repeated results, an empty table none; other columns
are not looked at, whatever their names.
"""

from __future__ import annotations

import heapq
import json
import re
import sys
from collections.abc import Callable, Iterator
from functools import lru_cache

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from tokenizers import Regex
from tokenizers.pre_tokenizers import Split

from flowsift.llm.common import text_of

MEMO = 300_000
MEMO_CHARS = 40


def merges_of(symbols: list[str], ranks: dict[tuple[str, str], int]) -> int:
    """How many merges byte-pair encoding makes, by heap and linked list."""
    symbols = list(symbols)
    n = len(symbols)
    after = list(range(1, n + 1))
    before = list(range(-1, n - 1))
    heap = []
    for i in range(n - 1):
        rank = ranks.get((symbols[i], symbols[i + 1]))
        if rank is not None:
            heap.append((rank, i, symbols[i], symbols[i + 1]))
    heapq.heapify(heap)
    done = 0
    while heap:
        _, i, left, right = heapq.heappop(heap)
        j = after[i]
        # A pair is stale when one of its symbols has been joined meanwhile.
        if symbols[i] != left or j >= n or symbols[j] != right:
            continue
        done += 1
        symbols[i] = left + right
        symbols[j] = ""
        k = after[i] = after[j]
        if k < n:
            before[k] = i
            rank = ranks.get((symbols[i], symbols[k]))
            if rank is not None:
                heapq.heappush(heap, (rank, i, symbols[i], symbols[k]))
        h = before[i]
        if h >= 0:
            rank = ranks.get((symbols[h], symbols[i]))
            if rank is not None:
                heapq.heappush(heap, (rank, h, symbols[h], symbols[i]))
    return done


def _classes(name: str) -> str:
    """Body of a character class with the characters of a Unicode property.

    Asked of the tokenizer library, so that both sides know the same Unicode version.
    """
    every = "".join(chr(c) for c in range(sys.maxunicode + 1) if not 0xD800 <= c < 0xE000)
    runs = Split(Regex(rf"\p{{{name}}}+"), "isolated").pre_tokenize_str(every)
    has = regex.compile(rf"\p{{{name}}}")
    # Runs with and without the property take turns.
    first = 0 if has.match(runs[0][0][0]) else 1
    return "".join(f"\\U{ord(run[0]):08x}-\\U{ord(run[-1]):08x}" for run, _ in runs[first::2])


@lru_cache(1)
def byte_level_pattern() -> str:
    """The cut of byte-level encoders, for Python's own and faster engine.

    English clitics, letters, numbers and other signs each with a space before, white
    space. Made once on the driver.
    """
    letter, number = _classes("L"), _classes("N")
    # Fixed value: characters with the property White_Space.
    space = r"\t-\r \x85\xa0  -     　"
    return (
        rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{letter}]+| ?[{number}]+| ?[^{space}{letter}{number}]+|[{space}]+(?![^{space}])|[{space}]+"
    )


def byte_letters() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level vocabularies.

    Bytes that print in Latin-1 stand for themselves; the others take the code points
    from 256 on, in order.
    """
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    odd = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(odd)}


class _Memo(dict):
    def __init__(self, count: Callable[[str], int]):
        self.count = count

    def __missing__(self, piece: str) -> int:
        n = self.count(piece)
        if len(piece) <= MEMO_CHARS:
            if len(self) >= MEMO:
                self.clear()
            self[piece] = n
        return n


class ByteTokenCounter:
    """Counts of one vocabulary file in the JSON format with a byte-level BPE model."""

    def __init__(self, path: str, pattern: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pairs = (tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"])
        self.ranks = {pair: rank for rank, pair in enumerate(pairs)}
        self.letters = {chr(b): c for b, c in byte_letters().items()}
        self.table = str.maketrans(self.letters)
        special = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        self.pattern = re.compile(pattern)
        self.memo = _Memo(self.count_piece)

    def count_piece(self, piece: str) -> int:
        symbols = piece.encode("utf-8", "surrogatepass").decode("latin-1").translate(self.table)
        return len(symbols) - merges_of(list(symbols), self.ranks)

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        parts = self.special.split(text) if self.special else [text]
        known = self.memo.__getitem__
        return len(parts) - 1 + sum(sum(map(known, self.pattern.findall(part))) for part in parts)


@lru_cache(2)
def counter(path: str, pattern: str) -> ByteTokenCounter:
    """One per worker process and vocabulary."""
    return ByteTokenCounter(path, pattern)


def n_tokens(text: Column, path: str) -> Column:
    pattern = byte_level_pattern()

    @F.pandas_udf("long")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        of = counter(path, pattern)
        for texts in batches:
            yield pd.Series([of.count(t) for t in texts], dtype="int64")

    return count(text)


def count_tokens(docs: DataFrame, path: str, limit: int = 512, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: its id, bytes in UTF-8, tokens, and whether they exceed ``limit``.

    ``path`` is the vocabulary file, at the same place on every machine.
    """
    text = text_of(f"`{text_col}`")
    return docs.select(
        F.col(f"`{id_col}`").alias("doc_id"),
        F.octet_length(text).cast("long").alias("n_bytes"),
        n_tokens(text, path).alias("n_tokens"),
    ).withColumn("over_limit", F.col("n_tokens") > limit)
