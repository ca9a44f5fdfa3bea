import hashlib
import random

import public_tokenizers as P
import pytest
import tiktoken

from flowsift.llm import prefix_bpe as m
from flowsift.llm.common import read_table
from flowsift.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
PATH = P.path("byte_bpe_multi_50k.tiktoken")
LETTERS = "ab  \n\t'’éß中՘Ḁ\U0001f600\x1c\x85 1²½sreTHE,.!-–"


@pytest.fixture(scope="module")
def encoder():
    return m.encoder(PATH, P.PATTERN, m.library_pattern(P.PATTERN))


@pytest.fixture(scope="module")
def library(encoder):
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=encoder.vocabulary.ranks, special_tokens={})


def noise(r, n):
    return "".join(r.choice(LETTERS) for _ in range(n))


def want(library, text):
    ids = library.encode_ordinary(text or "")
    listed = ",".join(map(str, ids)).encode()
    return len(ids), hashlib.sha256(listed).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()


def test_encoding_equals_the_library(encoder, library):
    r = random.Random(1)
    for _ in range(2000):
        text = noise(r, r.randint(0, 60))
        ids = encoder.encode(text)
        assert ids == library.encode_ordinary(text), text
        assert encoder.decode(ids) == text.encode()


def test_other_unicode_versions_cut_like_the_library(encoder, library):
    for code in (*encoder.odd, "՘", "࢏"):
        text = f"a{code} {code}{code}1 x"
        assert encoder.encode(text) == library.encode_ordinary(text), text


def test_small_vocabularies_against_plain_merging():
    r = random.Random(2)
    for _ in range(60):
        ranks = {bytes([b]): b for b in b"abc"}
        ranks = {k: i for i, k in enumerate(ranks)}
        while len(ranks) < 25:
            a, b = r.choice(list(ranks)), r.choice(list(ranks))
            if a + b not in ranks and merged(a + b, ranks) == [a, b]:
                ranks[a + b] = len(ranks)
        v = m.Vocabulary(ranks)
        for _ in range(40):
            piece = bytes(r.choice(b"abc") for _ in range(r.randint(1, 20)))
            table = m.PrefixTable(v, piece)
            assert [v.tokens[t] for t in table.tokens()] == merged(piece, ranks)
            for end in range(1, len(piece) + 1):
                assert v.tokens[table.last[end]] == merged(piece[:end], ranks)[-1]


def merged(piece, ranks):
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while True:
        found = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
        if not found:
            return parts
        _, i = min(found)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]


def test_append_and_edit_of_pieces(encoder):
    r = random.Random(3)
    v = encoder.vocabulary
    for _ in range(200):
        piece = noise(r, 80).encode()
        table = m.PrefixTable(v, piece[:30])
        table.append(piece[30:])
        assert table.last == m.PrefixTable(v, piece).last
        start = r.randint(0, len(piece))
        end = r.randint(start, min(len(piece), start + 6))
        new = noise(r, r.randint(0, 4)).encode()
        table.edit(start, end, new)
        whole = m.PrefixTable(v, piece[:start] + new + piece[end:])
        assert (table.piece, table.last) == (whole.piece, whole.last)
    long = m.PrefixTable(v, b"the" * 5000)
    assert long.edit(100, 101, b"x") < 200


def test_edit_of_texts(encoder, library):
    r = random.Random(4)
    for _ in range(300):
        text = noise(r, 120)
        held = m.EncodedText(encoder, text)
        for _ in range(4):
            start = r.randint(0, len(held.text))
            end = r.randint(start, min(len(held.text), start + 5))
            held.edit(start, end, noise(r, r.randint(0, 5)))
            assert held.ids() == library.encode_ordinary(held.text), held.text
    long = m.EncodedText(encoder, "some words here. " * 3000)
    assert long.edit(2000, 2001, "xy") < 10


def test_query_equals_the_library(spark, library):
    docs = {r.doc_id: r.text for r in read_table(spark, SF, "documents").collect()}
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in QUERIES["op13_byte_bpe"](spark, SF).collect()}
    assert got == {i: want(library, t) for i, t in docs.items()}


def test_odd_rows(spark, stored, library):
    rows = [(1, None), (2, ""), (None, "a"), (3, "x" * 300_000), (3, "x" * 300_000), (4, " \n\n " * 999), (5, "<|endoftext|>é\U0001f600")]
    docs = stored([(i, t, None, None) for i, t in rows])
    got = sorted(map(tuple, m.round_trip(docs, PATH, P.PATTERN).collect()), key=repr)
    assert got == sorted([(i, *want(library, t)) for i, t in rows], key=repr)
    ids = docs.select("doc_id", m.token_ids(m.text_of("text"), PATH, P.PATTERN).alias("ids"))
    back = ids.select("doc_id", m.decoded("ids", PATH, P.PATTERN).alias("b")).collect()
    assert sorted(((r.doc_id, bytes(r.b).decode()) for r in back), key=repr) == sorted(((i, t or "") for i, t in rows), key=repr)
    assert m.round_trip(stored([]), PATH, P.PATTERN).count() == 0


def test_a_full_memory_keeps_the_pieces_in_use(encoder, monkeypatch):
    want = tuple(encoder.encode("zqxjzqxj"))
    monkeypatch.setattr(m, "MEMO", 50)
    pieces, made = m._Pieces(encoder.vocabulary), []
    table = m.PrefixTable
    monkeypatch.setattr(m, "PrefixTable", lambda v, data: made.append(data) or table(v, data))
    for k in range(300):
        assert pieces["zqxjzqxj"] == want
        pieces[f"zqxj{k}q"]
    assert made.count(b"zqxjzqxj") == 1 and len(pieces) <= 50 and len(pieces.older) <= 50
