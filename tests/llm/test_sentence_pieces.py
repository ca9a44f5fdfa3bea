import random
import re

import public_tokenizers
import sentencepiece
from pyspark.sql import functions as F

from flowsift.llm import sentence_pieces as s

PATH = public_tokenizers.path("piece_bpe_32k.model")
ODD = ["", " ", "\n", "  a  b ", "▁x", "<s>hi</s><0x0A>", "日本語", "\x00\t\r", "😀é", "x" * 500, "ab" * 400, "é ﬁ １"]


def texts():
    rng = random.Random(4)
    signs = ["a", "B", "1", " ", "  ", "\n", "the", "é", "日", "😀", "ing", "in", "er", "#", "▁"]
    return ODD + ["".join(rng.choices(signs, k=rng.randint(1, 40))) for _ in range(250)]


def test_ids_equal_the_library_and_decode(spark, stored):
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    all_texts = texts()
    rows = [(k, t, "en", "s") for k, t in enumerate(all_texts)] + [(None, None, None, None), (3, all_texts[3], "en", "s")]
    docs = stored(rows)
    for encode in (s.encode, s.encode_by_join):
        got = encode(docs, PATH).withColumn("back", s.decode(F.col("ids"), PATH)).collect()
        assert len(got) == len(rows)
        for r in got:
            text = all_texts[r.doc_id] if r.doc_id is not None else ""
            assert list(r.ids) == library.encode(text)
            assert r.back == library.decode(library.encode(text)) == text.replace("▁", " ")
    assert all(r.round_trip for r in s.checked(docs, PATH).collect())
    assert s.encode(stored([]), PATH).count() == 0 and s.encode_by_join(stored([]), PATH).count() == 0


def test_words_hold_the_whole_text():
    for t in texts():
        marked = "▁" + t.replace(" ", "▁")
        assert "".join(re.findall(s.WORDS, marked)) == marked


def lattice_of(spark, pieces, words):
    table = spark.createDataFrame([(p, c, k, late) for k, (p, c, late) in enumerate(pieces)], "piece string, rank double, id int, late boolean")
    return s._lattice(spark.createDataFrame([(w,) for w in words], "word string"), table, 4)


def borders(word, mask):
    return [i for i in range(len(word) + 1) if mask >> i & 1]


def test_relational_lattice_with_best_sums(spark):
    """Viterbi over the lattice against all segmentations."""
    pieces = [("a", 2.0, False), ("b", 2.5, False), ("ab", 3.0, False), ("ba", 1.0, False), ("aba", 4.5, False), ("bb", 9.0, False)]
    cost = {p: c for p, c, _ in pieces}
    words = ["abab", "bbaab", "abba", "a", "bbbb"]
    got = lattice_of(spark, pieces, words).select("word", s._best_sum(F.col("word"), F.col("edges")).alias("m")).collect()

    def best(word):
        if not word:
            return 0.0
        return min(cost[word[:k]] + best(word[k:]) for k in range(1, len(word) + 1) if word[:k] in cost)

    assert len(got) == len(words)
    for r in got:
        b = borders(r.word, r.m)
        assert sum(cost[r.word[x:y]] for x, y in zip(b, b[1:], strict=False)) == best(r.word)


def test_relational_lattice_in_merge_order(spark):
    """A piece that later pieces can make too needs the slow fold."""
    pieces = [("xa", 1.0, False), ("abc", 2.0, True), ("ab", 3.0, False), ("bc", 4.0, False)]
    got = lattice_of(spark, pieces, ["xabc", "abc"]).select("word", s._merged(F.col("word"), F.col("edges")).alias("m")).collect()
    assert {r.word: borders(r.word, r.m) for r in got} == {"xabc": [0, 2, 4], "abc": [0, 3]}
