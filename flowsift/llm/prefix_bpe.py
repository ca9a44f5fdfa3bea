"""Byte-level BPE encoding by a dynamic program over prefixes, and decoding.

A text is cut by the pattern of the encoding; each piece is encoded by itself. For
every prefix of a piece the program stores the last token of that prefix's encoding.
A token sequence is an encoding exactly when each neighbouring pair is one, so among
the vocabulary's tokens that end at a place only one fits the last token stored for
the place where it starts. Walking back along the stored tokens gives the encoding.

Because a stored token depends on the bytes before it alone, bytes can be appended
without looking at the old ones again (``PrefixTable.append``), and after an edit the
program stops as soon as the stored tokens agree with the old ones over the length of
the longest token (``PrefixTable.edit``). ``EncodedText.edit`` does the same for texts,
where cuts agree again soon after the edit.

Whether two tokens may stand side by side follows from how each of them grows: while
merges happen in rank order, the last symbol of the left one and the first symbol of
the right one change at known ranks, and the pair holds if no merge across the border
comes first.

Texts are encoded where they are read; nothing is shuffled. Workers remember pieces,
pairs and growth in tables of limited size that are emptied when full, so memory is
bounded and results do not depend on them.

Edge cases: a null or empty text has no tokens, and its digests are those of nothing.
A piece that is a token as a whole is that token. Very long pieces cost time in
proportion to their bytes. Lone surrogates, which UTF-8 cannot hold, become U+FFFD.
Repeated rows give repeated results, an empty table none; other columns are not
looked at, whatever their names.
"""

from __future__ import annotations

import base64
import hashlib
import sys
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import pandas as pd
import regex
import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowsift.llm.common import text_of

MEMO = 300_000
MEMO_CHARS = 40
START_BYTES = 12
_NEVER = sys.maxsize


def read_ranks(path: str) -> dict[bytes, int]:
    """Tokens and their ranks from a file with one base64 token and its rank a line."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


class Vocabulary:
    """Tokens of one encoding and what the program asks about them."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.longest = max(map(len, ranks))
        self._growth: dict[int, tuple | None] = {}
        # Every ending of every token: a run of bytes that is none cannot grow into a token.
        # The value is the token of just these bytes, -1 if merges give none.
        self.endings = {token[i:]: -1 for token in ranks for i in range(len(token))}
        self.endings.update({token: rank for token, rank in ranks.items() if self.growth(rank)})
        # The same endings from their last byte backwards: byte -> [token or -1, bytes before].
        self.backwards: dict[int, list] = {}
        for token in ranks:
            node = self.backwards
            for byte in reversed(token):
                hit = node.setdefault(byte, [-1, {}])
                node = hit[1]
            if token:
                hit[0] = self.endings[token]
        self.pairs: dict[int, bool] = {}
        # Last tokens of short prefixes, which many pieces share.
        self.starts: dict[bytes, int] = {}

    def growth(self, token: int) -> tuple | None:
        """((last symbol, rank that changes it), ...) and the same for the first symbol; None if merges never give the token."""
        if token not in self._growth:
            self._growth[token] = self._grow(self.tokens[token])
        return self._growth[token]

    def _grow(self, token: bytes) -> tuple | None:
        symbols = [token[i : i + 1] for i in range(len(token))]
        first, last = [], []
        head, tail = symbols[0], symbols[-1]
        while len(symbols) > 1:
            rank, at = min((self.ranks.get(symbols[i] + symbols[i + 1], _NEVER), i) for i in range(len(symbols) - 1))
            if rank == _NEVER:
                return None
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
            if symbols[0] != head:
                first.append((head, rank))
                head = symbols[0]
            if symbols[-1] != tail:
                last.append((tail, rank))
                tail = symbols[-1]
        return (*last, (tail, _NEVER)), (*first, (head, _NEVER))

    def fits(self, left: int, right: int) -> bool:
        """Whether the encoding of both tokens' bytes is just these two tokens."""
        if len(self.pairs) >= 4 * MEMO:
            self.pairs.clear()
        known = self.pairs[left << 32 | right] = self._apart(self.growth(left)[0], self.growth(right)[1])
        return known

    def step(self, piece: bytes, last: list[int], end: int) -> int:
        """The last token of the prefix that ends at ``end``, from the last tokens of shorter ones."""
        endings, pairs = self.endings, self.pairs
        found, at = [], end
        while at:
            token = endings.get(piece[at - 1 : end])
            if token is None:
                break
            at -= 1
            if token >= 0:
                found.append((at, token))
        for at, token in reversed(found):
            if not at:
                return token
            fits = pairs.get(last[at] << 32 | token)
            if fits or (fits is None and self.fits(last[at], token)):
                return token
        raise ValueError(f"no token for byte {piece[end - 1]}")

    def _apart(self, lasts: tuple, firsts: tuple) -> bool:
        i = j = 0
        while True:
            a, left_rank = lasts[i]
            b, right_rank = firsts[j]
            across = self.ranks.get(a + b, _NEVER)
            # Of equal ranks the leftmost merge comes first.
            if across < left_rank and across <= right_rank and across != _NEVER:
                return False
            if left_rank == right_rank == _NEVER:
                return True
            if left_rank <= right_rank:
                i += 1
            else:
                j += 1


class PrefixTable:
    """Bytes of one piece with the last token of every prefix."""

    def __init__(self, vocabulary: Vocabulary, piece: bytes = b""):
        self.vocabulary = vocabulary
        self.piece = b""
        self.last: list[int] = [-1]
        self.append(piece)

    def append(self, more: bytes) -> None:
        """Go on behind the last byte; what is stored stays."""
        end = len(self.piece)
        self.piece += more
        piece, last, v = self.piece, self.last, self.vocabulary
        while end < min(len(piece), START_BYTES):
            known = v.starts.get(piece[: end + 1])
            if known is None:
                break
            last.append(known)
            end += 1
        # ``Vocabulary.step`` for every place, written out because most of the time is spent here.
        backwards, pairs = v.backwards, v.pairs.get
        for end in range(end + 1, len(piece) + 1):
            at, node, found, places = end, backwards, [], []
            while at:
                hit = node.get(piece[at - 1])
                if hit is None:
                    break
                at -= 1
                token, node = hit
                if token >= 0:
                    found.append(token)
                    places.append(at)
            while found:
                token, at = found.pop(), places.pop()
                if not at:
                    break
                left = last[at]
                fits = pairs(left << 32 | token)
                if fits or (fits is None and v.fits(left, token)):
                    break
            else:
                raise ValueError(f"no token for byte {piece[end - 1]}")
            last.append(token)
            if end <= START_BYTES:
                if len(v.starts) >= MEMO:
                    v.starts.clear()
                v.starts[piece[:end]] = token

    def edit(self, start: int, end: int, new: bytes) -> int:
        """Replace bytes ``start:end``; returns how many places were computed anew."""
        piece = self.piece[:start] + new + self.piece[end:]
        shift = len(piece) - len(self.piece)
        last, agreed, steps = self.last[: start + 1], 0, 0
        for place in range(start + 1, len(piece) + 1):
            if agreed >= self.vocabulary.longest:
                last += self.last[place - shift :]
                break
            token = self.vocabulary.step(piece, last, place)
            steps += 1
            last.append(token)
            agreed = agreed + 1 if place > start + len(new) and self.last[place - shift] == token else 0
        self.piece, self.last = piece, last
        return steps

    def tokens(self) -> list[int]:
        found, end = [], len(self.piece)
        while end:
            token = self.last[end]
            found.append(token)
            end -= len(self.vocabulary.tokens[token])
        return found[::-1]


class _Pieces(dict):
    """Tokens of pieces, remembered; when full, pieces used since the last time stay for one more."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.older: dict[str, tuple[int, ...]] = {}

    def __missing__(self, piece: str) -> tuple[int, ...]:
        found = self.older.get(piece)
        if found is None:
            data = piece.encode("utf-8", "replace")
            whole = self.vocabulary.ranks.get(data)
            found = (whole,) if whole is not None else tuple(PrefixTable(self.vocabulary, data).tokens())
        if len(piece) <= MEMO_CHARS:
            if len(self) >= MEMO:
                self.older = dict(self)
                self.clear()
            self[piece] = found
        return found


class ByteEncoder:
    """Encodes and decodes texts with one vocabulary and pattern."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, library: tuple[str, str]):
        self.vocabulary = Vocabulary(ranks)
        self.plain, self.exact = regex.compile(pattern), regex.compile(library[0])
        self.odd = frozenset(library[1])
        self.high = regex.compile(f"[{min(self.odd)}-\\U0010ffff]") if self.odd else regex.compile("(?!)")
        self.pieces = _Pieces(self.vocabulary)

    def cutter(self, text: str) -> regex.Pattern:
        """The engine's own classes, unless the text has a character that the library classes otherwise."""
        return self.plain if self.odd.isdisjoint(self.high.findall(text)) else self.exact

    def cut(self, text: str) -> list[str]:
        return self.cutter(text).findall(text)

    def encode(self, text: str | None) -> list[int]:
        return list(chain.from_iterable(map(self.pieces.__getitem__, self.cut(text)))) if text else []

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.vocabulary.tokens.__getitem__, ids))


class EncodedText:
    """A text with the tokens of its pieces, which follows edits."""

    # No alternative of the pattern looks further than this beyond the end of its match.
    LOOKS_AHEAD = 3

    def __init__(self, encoder: ByteEncoder, text: str):
        self.encoder, self.text = encoder, text
        self.cuts = encoder.cut(text)

    def edit(self, start: int, end: int, new: str) -> int:
        """Replace characters ``start:end``; returns how many pieces were cut anew."""
        text = self.text[:start] + new + self.text[end:]
        keep, at = 0, 0
        while keep < len(self.cuts) and at + len(self.cuts[keep]) + self.LOOKS_AHEAD <= start:
            at += len(self.cuts[keep])
            keep += 1
        old, place = {}, at
        shift = len(text) - len(self.text)
        for i in range(keep, len(self.cuts)):
            if place >= end:
                old[place + shift] = i
            place += len(self.cuts[i])
        fresh, tail = [], []
        # A cut behind the edit where an old cut was: what follows is cut as before.
        for found in self.encoder.cutter(text).finditer(text, at):
            if found.start() in old and found.start() >= start + len(new):
                tail = self.cuts[old[found.start()] :]
                break
            fresh.append(found[0])
        self.text, self.cuts = text, self.cuts[:keep] + fresh + tail
        return len(fresh)

    def ids(self) -> list[int]:
        return list(chain.from_iterable(map(self.encoder.pieces.__getitem__, self.cuts)))


@lru_cache(4)
def library_pattern(pattern: str) -> tuple[str, str]:
    r"""The pattern with the library's letters, numbers and spaces spelled out, and the characters that the regex engine classes otherwise.

    Engines follow different Unicode versions. The library is asked which code points it
    takes for ``\p{L}``, ``\p{N}`` and ``\s``. Texts without such characters are cut by the
    engine's own classes, which are faster.
    """
    every = "".join(chr(c) for c in range(sys.maxunicode + 1) if not 0xD800 <= c < 0xE000)
    singles = {bytes([b]): b for b in range(256)}
    odd = set()
    for name in (r"\p{L}", r"\p{N}", r"\s"):
        asks = tiktoken.Encoding("class", pat_str=f"{name}+", mergeable_ranks=singles, special_tokens={})
        theirs = bytes(asks.encode_ordinary(every)).decode()
        odd |= set(theirs) ^ set("".join(regex.findall(f"{name}+", every)))
        body, run = [], None
        for c in map(ord, theirs):
            if run and c == run[1] + 1:
                run[1] = c
            else:
                run = [c, c]
                body.append(run)
        chars = "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in body)
        pattern = _spelled(pattern, name, chars)
    return pattern, "".join(sorted(odd))


def _spelled(pattern: str, name: str, chars: str) -> str:
    """``name`` as a class, inside brackets without brackets of its own."""
    if name == r"\s":
        outside = f"[^{chars}]"
        pattern = pattern.replace(r"\S", outside)
    out, inside, i = [], False, 0
    while i < len(pattern):
        if pattern.startswith(name, i):
            out.append(chars if inside else f"[{chars}]")
            i += len(name)
            continue
        if pattern[i] == "\\":
            out.append(pattern[i : i + 2])
            i += 2
            continue
        if pattern[i] in "[]":
            inside = pattern[i] == "["
        out.append(pattern[i])
        i += 1
    return "".join(out)


@lru_cache(2)
def encoder(path: str, pattern: str, library: tuple[str, str]) -> ByteEncoder:
    """One per worker process and vocabulary."""
    return ByteEncoder(read_ranks(path), pattern, library)


def token_ids(text: Column, path: str, pattern: str) -> Column:
    """Token ids of every text, as an array."""
    own = library_pattern(pattern)

    @F.pandas_udf("array<int>")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        of = encoder(path, pattern, own)
        for texts in batches:
            yield pd.Series([of.encode(t) for t in texts], dtype=object)

    return encode(text)


def decoded(ids: Column, path: str, pattern: str) -> Column:
    """The bytes that token ids stand for."""
    own = library_pattern(pattern)

    @F.pandas_udf("binary")
    def decode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        of = encoder(path, pattern, own)
        for rows in batches:
            yield pd.Series([of.decode([] if r is None else r) for r in rows], dtype=object)

    return decode(ids)


def round_trip(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: number of tokens, digest of the ids as decimals, digest of the decoded bytes.

    Ids are encoded and decoded in the task that reads the text, so only digests leave it.
    ``path`` is the vocabulary file, at the same place on every machine.
    """
    own = library_pattern(pattern)

    @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def digests(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        of = encoder(path, pattern, own)
        names = {token: str(token) for token in of.vocabulary.tokens}
        for texts in batches:
            rows = []
            for text in texts:
                ids = of.encode(text)
                listed = ",".join(map(names.__getitem__, ids)).encode()
                rows.append((len(ids), hashlib.sha256(listed).hexdigest(), hashlib.sha256(of.decode(ids)).hexdigest()))
            yield pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    found = docs.select(F.col(f"`{id_col}`").alias("doc_id"), digests(text_of(f"`{text_col}`")).alias("found"))
    return found.select("doc_id", "found.*")
