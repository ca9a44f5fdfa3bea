from collections import Counter

from check_oracle import compare
from flowsift.llm import mixing
from flowsift.llm.queries import OP9_SQL, op9_mixing

SF = "/root/testdata/sf0.001"


def test_given_documents_equal_sql(spark, con):
    assert compare("op9", spark, con, SF, op9_mixing, OP9_SQL).startswith("ok 200")


def rows():
    out = [(i, "w " * (i % 70 + 1), "en", f"s{i % 4}") for i in range(300)]
    return out + [(1000, "w " * 9000, "en", "big"), (1001, None, "en", "s1"), (1002, "", "en", "none"), (None, "a b", "en", None),
                  (7, "w " * 8, "en", "s3"), (7, "w " * 8, "en", "s3")]


def test_targets_and_limits(spark, stored):
    got = mixing.taken_per_document(stored(rows()), block_tokens=16).collect()
    assert len(got) == len(rows())
    taken, target, size = Counter(), {}, Counter()
    for r in got:
        taken[r.source] += r.taken
        size[r.source] += r["size"]
        target[r.source] = r.target
        assert 0 <= r.taken <= 3 * r["size"] and r.source_size >= r["size"]
    assert all(taken[s] == int(target[s]) for s in target)
    order = sorted((s for s in target if s is not None)) + [None]
    weight = {s: k % 3 + 1 for k, s in enumerate(order)}
    # Repeated sharing, as a reader would do it.
    goal, left, free = {}, float(sum(size.values())), set(order)
    while True:
        level = left / sum(weight[s] for s in free)
        over = {s for s in free if weight[s] * level > 3 * size[s]}
        if not over:
            break
        for s in over:
            goal[s] = 3.0 * size[s]
            left -= goal[s]
        free -= over
    goal |= {s: weight[s] * level for s in free}
    assert all(abs(goal[s] - target[s]) < 1e-6 for s in order)


def test_schedule_is_even_and_reruns_agree(spark, stored):
    docs = stored(rows())
    all_rows, goal, uses = mixing.mix(docs, block_tokens=16)
    share = {r.source: r.x_to - r.x_from for r in goal.collect()}
    slots = [r.source for r in mixing.schedule(goal, 16).where("slot IS NOT NULL").orderBy("slot").collect()]
    half = Counter(slots[: len(slots) // 2])
    assert all(abs(half[s] - share[s] * len(slots) / 2) < 12 for s in share)
    a = sorted(map(tuple, mixing.taken_per_document(docs).select("doc_id", "size", "taken").na.fill(-1).collect()))
    b = sorted(map(tuple, mixing.taken_per_document(docs).select("doc_id", "size", "taken").na.fill(-1).collect()))
    assert a == b


def test_mixed_documents_hold_the_words_taken(spark, stored):
    docs = stored(rows())
    mixed = mixing.mixed_documents(docs, block_tokens=16)
    assert mixed.columns == docs.columns
    words = Counter()
    for r in mixed.collect():
        words[r.source] += len((r.text or "").split())
    taken = Counter()
    for r in mixing.taken_per_document(docs, block_tokens=16).collect():
        taken[r.source] += r.taken
    assert +words == +taken
    assert mixing.taken_per_document(stored([])).count() == 0


def test_every_stretch_of_the_mix_holds_the_shares(spark, stored):
    docs = stored([(i, f"{i} " + "w " * (i % 40 + 1), "en", f"s{i % 4}") for i in range(1200)])
    goal = {r.source: r.target for r in mixing.mix(docs, block_tokens=16)[1].collect()}
    mixed = mixing.mixed_documents(docs, block_tokens=16, stored=True).collect()
    assert len(mixed) > 1200
    whole, seen, total = sum(goal.values()), Counter(), 0
    for k, r in enumerate(mixed):
        seen[r.source] += len(r.text.split())
        total += len(r.text.split())
        if k % 50 == 49:
            # A document stands where it begins, so a source is off by a few documents and blocks at most.
            assert all(abs(seen[s] - goal[s] / whole * total) < 250 for s in goal)
    found = mixing.taken_per_document(docs, block_tokens=16).collect()
    assert all((r.taken > 0) == (r.first_slot is not None) == (r.n_slots > 0) for r in found)
    assert all(r.n_slots >= -(-r.taken // 16) for r in found)


def test_null_ids_do_not_share_a_bucket(spark, stored):
    docs = stored([(None, "w " * (k % 30 + 1), "en", "one") for k in range(600)], parts=8)
    rows = mixing.bucketed(mixing.mix(docs, block_tokens=16)[0].where("size > 0"))
    assert rows.groupBy("bucket").count().agg({"count": "max"}).first()[0] < 100
    assert sum(r.taken for r in mixing.taken_per_document(docs, block_tokens=16).collect()) > 0
