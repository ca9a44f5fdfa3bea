import random

import public_tokenizers
from tokenizers import Tokenizer

from flowsift.llm.token_counts import byte_level_pattern, count_tokens, merges_of

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = ["", " ", "a  <|endoftext|>  b", "<|endoftext", "don't I'll 'S", "é" * 50, "   \n\n  x  ", "日本語 １２３ ²³ Ⅷ", "\x1c\x85​x", "a" * 3000]


def test_counts_equal_the_library(spark, stored):
    rng = random.Random(5)
    signs = ["a", "B", "1", " ", "  ", "\n", "'s", "é", "日", "😀", "!", "<|endoftext|>", " ", "_"]
    texts = ODD + ["".join(rng.choices(signs, k=rng.randint(1, 30))) for _ in range(300)]
    rows = [(k, t, "en", "s") for k, t in enumerate(texts)] + [(None, None, None, None), (0, texts[0], "en", "s")]
    got = count_tokens(stored(rows), PATH).collect()
    library = Tokenizer.from_file(PATH)
    assert len(got) == len(rows)
    for r in got:
        text = texts[r.doc_id] if r.doc_id is not None else ""
        n = len(library.encode(text, add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(text.encode()), n, n > 512)


def test_merges_leftmost_first_among_equals():
    assert merges_of(list("aaa"), {("a", "a"): 0, ("a", "aa"): 1}) == 1
    assert merges_of(list("abc"), {("b", "c"): 0, ("a", "b"): 1}) == 1
    assert merges_of([], {}) == 0


def test_empty_table(spark, stored):
    assert count_tokens(stored([]), PATH).count() == 0
    assert byte_level_pattern().startswith("'s")
