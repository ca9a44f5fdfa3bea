import hashlib
import re

from flowsift.llm.exact_dedup import DigestIndex, drop_duplicates, find_duplicates


def low(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


ROWS = [(1, "Same"), (5, "sAME"), (3, "SAME"), (2, "É"), (4, "é"), (6, None), (7, ""), (None, "alone"), (None, "same"),
        (8, "twice"), (8, "twice"), (9, "x" * 200_000)]


def test_groups(spark, stored):
    docs = stored([(i, t, "en", "s") for i, t in ROWS])
    got = find_duplicates(docs).collect()
    assert len(got) == len(ROWS)
    for r in got:
        group = [i for i, t in ROWS if hashlib.sha256(low(t).encode()).hexdigest() == r.text_sha256]
        ids = [i for i in group if i is not None]
        assert r.group_size == len(group) and r.keep_id == max(ids, default=None)
    assert sum(r.kept for r in got) == len({low(t) for _, t in ROWS})
    assert all(r.kept <= (r.doc_id == r.keep_id) for r in got)
    assert find_duplicates(stored([])).count() == 0


def test_index_remembers_earlier_batches(spark, stored, tmp_path):
    path = f"{tmp_path}/index"
    first = stored([(1, "a", "en", "s"), (2, "b", "en", "s"), (3, "A", "en", "s")])
    second = stored([(4, "b", "en", "s"), (5, "c", "en", "s")])
    index = DigestIndex(spark, path, buckets=4)
    assert {r.doc_id for r in drop_duplicates(first, index).collect()} == {2, 3}
    again = DigestIndex(spark, path, buckets=4)
    kept = drop_duplicates(second, again)
    assert kept.columns == second.columns
    assert {r.doc_id for r in kept.collect()} == {5}
    found = {r.doc_id: (r.keep_id, r.kept) for r in find_duplicates(second, again).collect()}
    assert found == {4: (2, False), 5: (5, False)}
    assert index.rows().count() == 3


def test_index_is_read_without_a_shuffle(spark, stored):
    index = DigestIndex(spark, buckets=4)
    groups = spark.createDataFrame([("x", 1)], "text_sha256 string, keep_id long").repartition(4, "text_sha256")
    plan = groups.join(index.rows().hint("merge"), "text_sha256", "left_anti")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "SortMergeJoin" in plan


def test_interrupted_batch_is_kept_by_its_rerun(spark, stored):
    docs = stored([(1, "a", "en", "s"), (2, "b", "en", "s"), (3, "A", "en", "s")])
    index = DigestIndex(spark, buckets=4)
    assert {r.doc_id for r in drop_duplicates(stored([(9, "b", "en", "s")]), index, batch="monday").collect()} == {9}
    first = drop_duplicates(docs, index, batch="tuesday")
    # The job dies before it reads its result; under the same name the rerun keeps the same rows.
    del first
    assert {r.doc_id for r in drop_duplicates(docs, index, batch="tuesday").collect()} == {3}
    assert index.rows().count() == 2
    # A batch that was appended in part is completed.
    more = docs.unionByName(stored([(5, "c", "en", "s")]))
    assert {r.doc_id for r in drop_duplicates(more, index, batch="tuesday").collect()} == {3, 5}
    assert index.rows().count() == 3
    assert drop_duplicates(docs, index, batch="wednesday").count() == 0


def test_own_index_leaves_no_table(spark, stored):
    before = {t.name for t in spark.catalog.listTables()}
    find_duplicates(stored([(1, "a", "en", "s")])).collect()
    assert {t.name for t in spark.catalog.listTables()} == before


def test_rows_of_a_stored_table_need_no_copy(stored):
    docs = stored([(i, t, "en", "s") for i, t in ROWS])
    for kept in (drop_duplicates(docs, stored=True), drop_duplicates(docs.where("lang = 'en'"), stored=True)):
        assert sorted(map(str, kept.collect())) == sorted(map(str, drop_duplicates(docs).collect()))
        assert kept.columns == docs.columns
