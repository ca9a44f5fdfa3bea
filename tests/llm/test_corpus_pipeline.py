import importlib.util
import os

import public_tokenizers
import sentencepiece
from pyspark.sql import functions as F
from test_near_dedup import brute
from test_quality_rules import brute as judged

import corpus_pipeline as c
from flowsift.llm.common import read_table

SF = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark):
    docs = read_table(spark, SF, "documents")
    columns = docs.columns
    trusted = {r.doc_id for r in read_table(spark, SF, "labels").where("quality = 1").collect()}
    rows = {r.doc_id: r for r in docs.collect()}
    after = {}
    for name, stage in c.STAGES:
        docs = c.materialize(stage(spark, docs, SF), name)
        after[name] = docs
        assert name == c.STAGES[-1][0] or docs.columns == columns

    good = {r[0] for r in judged([(i, r.text) for i, r in rows.items()], trusted) if r[-1]}
    assert {r.doc_id for r in after["quality_rules"].collect()} == good
    low = lambda t: "".join(x.lower() if x.isascii() else x for x in t)
    last = {low(rows[i].text): i for i in sorted(good)}
    assert sorted(r.doc_id for r in after["exact_dedup"].collect()) == sorted(last.values())
    near = brute([(i, rows[i].text) for i in last.values()], 5, 80)
    near = sorted({r[2] for r in near})
    assert sorted(r.doc_id for r in after["near_dedup"].collect()) == near
    mixed = after["mixing"].collect()
    assert {r.doc_id for r in mixed} <= set(near)
    assert all(r.n_chars == len(r.text) for r in mixed)
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(c.MODEL))
    want = sorted((r.doc_id, library.encode(r.text)) for r in mixed)
    assert sorted((r.doc_id, list(r.ids)) for r in after["sentence_pieces"].collect()) == want


ODD = [
    (1, None, "en", "s1"),
    (None, "", None, None),
    (2, "Only a few words here, but not enough.", "en", None),
    *[(10 + k, " ".join(f"word{k}x{j}" for j in range(40)), "en", f"s{k % 3}") for k in range(12)],
    *[(10, " ".join(f"word0x{j}" for j in range(40)), "en", "s0")] * 3,
    (None, " ".join(f"word1X{j}" for j in range(40)), "en", None),
    (40, " ".join(f"word2x{j}" for j in range(39)) + " other", "en", "s2"),
    (41, " ".join(f"long{j}" for j in range(30_000)), "en", "s1"),
]


def test_odd_rows_through_all_stages(spark, stored):
    docs = stored(ODD)
    before = docs.withColumn("n_chars", F.length("text").cast("long"))
    ids = {}
    for name, stage in c.STAGES:
        after = c.materialize(stage(spark, c.materialize(before, "in"), SF), name)
        assert name == c.STAGES[-1][0] or after.columns == before.columns
        ids[name] = sorted(r.doc_id or 0 for r in after.collect())
        before = after
    good = ids["quality_rules"]
    assert good and not {1, 2} & set(good) and set(good) <= {r[0] or 0 for r in ODD}
    copies = {0: 11} if 11 in good else {}
    assert ids["exact_dedup"] == sorted({copies.get(i, i) for i in good})
    near = {40: 12} if 12 in good else {}
    assert ids["near_dedup"] == sorted({near.get(i, i) for i in ids["exact_dedup"]})
    # The mix may leave out documents of a source that is larger than its target.
    assert set(ids["sentence_pieces"]) == set(ids["mixing"]) <= set(ids["near_dedup"])
    empty = stored([]).withColumn("n_chars", F.lit(0).cast("long"))
    for name, stage in c.STAGES:
        empty = c.materialize(stage(spark, c.materialize(empty, "in"), SF), name)
        assert empty.count() == 0


def test_stages_remove_what_the_one_before_wrote(spark, stored):
    docs = stored(ODD).withColumn("n_chars", F.length("text").cast("long"))
    app = spark.sparkContext.applicationId
    first = c.materialize(c.drop_copies(spark, c.materialize(docs, "in"), SF), "first")
    written = list(c._IN_BETWEEN[app])
    second = c.drop_near_copies(spark, first, SF)
    assert written and not any(map(os.path.exists, written)) and first.count() > 0
    assert second.count() > 0 and all(map(os.path.exists, c._IN_BETWEEN[app]))


def test_entry_registers_every_operator(spark):
    entry = importlib.util.spec_from_file_location("entry", os.path.join(os.path.dirname(c.__file__), "__spark_entry__.py"))
    module = importlib.util.module_from_spec(entry)
    entry.loader.exec_module(module)
    names = module.queries()
    assert all(any(q.startswith(f"op{k}_") for q in names) for k in range(1, 14)) and "pipeline" in names


def test_pieces_come_from_the_lattice_in_the_order_of_the_mix(spark, stored, monkeypatch):
    rows = [(k, f"w{k % 7} w{k} both\n{'' if k % 5 else 'x' * 70}", "en", "s") for k in range(700)]
    rows += [(1000, "", "en", "s"), (1001, None, "en", "s"), (1, "w1 w1 both\n", "en", "s")]
    docs = stored(rows, parts=1).select("doc_id", "text", "lang", "source")
    folded = []
    of_words = c.sentence_pieces.encode_words

    def encode_words(words, path):
        folded.append(sorted(r.word for r in words.collect()))
        return of_words(words, path)

    monkeypatch.setattr(c.sentence_pieces, "encode_words", encode_words)
    got = c.to_pieces(spark, docs, SF).collect()
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(c.MODEL))
    read = docs.collect()
    assert [(r.doc_id, list(r.ids)) for r in got] == [(r.doc_id, library.encode(r.text or "")) for r in read]
    assert all(r.n_pieces == len(r.ids) for r in got)
    # Every distinct word once.
    marked = {w for r in read if r.text for w in ("\u2581" + r.text.replace(" ", "\u2581")).replace("\n", "\u2581").split("\u2581")}
    assert len(folded) == 1 and {w.strip("\u2581\n") for w in folded[0]} == marked and len(folded[0]) == len(set(folded[0]))
