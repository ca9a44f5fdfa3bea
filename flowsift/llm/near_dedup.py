"""Near duplicates by bottom-k sketches of word shingles, verified exactly.

One hash function maps the shingles of a document to 64-bit numbers. The sorted
distinct numbers are its set, the ``SKETCH`` smallest its sketch.

1. Documents with equal sets form a class; only one of each goes on.
2. Inverted lists of retained values. Two linked sets share so many sketch values
   (``_least_overlap``; the chance to miss a link is below 1e-9, and none for sets
   that fit into a sketch) that each has a shared one among its first values in the
   order of list length. A set that shares too few values altogether has no partner
   and goes. Passages that thousands of documents share come last in this order, so
   their lists matter only to documents that consist of little else.
3. For the sets left, the shingles that no other candidate has are counted. A set
   with too many of them has no partner and goes.
4. Each list has a hub, the member with the smallest share of such shingles. All
   members are compared with the hub of their lists on full sets. What is linked to it
   is one component, whatever the size of the group, after one comparison per member.
5. What a member shares with the hub, and what it shares with nobody, bound its
   similarity to any other member from above (``_possible``). Members outside the hub's
   component are compared with those of other components of their list for which the
   bound allows a link, in the first list both share. Steps 4 and 5 together miss no
   link between different components.
6. Such a pair passes the estimate from the sketch of the union and then the exact
   count on full sets. Components of the links are the groups.

No list is cut and no pair of one component is made again.

Edge cases: words are split at the six ASCII spaces after A-Z is lower-cased. A text
with fewer words than a shingle has its whole sequence as one shingle; a null text and
one without words has none, is linked with nothing and stays. Repeated rows have equal
sets and form a group; of a group the row with the smallest id stays in
``drop_near_duplicates`` (null ids last, then the first of the table). An empty table
gives no rows. Other columns are not looked at, whatever their names.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowsift.llm.common import ascii_lower, let, placed_rows, text_of, words_of
from flowsift.llm.components import connected_components
from flowsift.storage import materialize

SKETCH = 64
SHINGLE = 5
PERCENT = 80
MISS = 1e-9


def shingles(text: Column, length: int) -> Column:
    """Sorted distinct hashes of a text's word shingles."""

    def of(h: Column) -> Column:
        at = [lambda i, k=k: F.element_at(h, i + k) for k in range(length)]
        every = F.transform(F.sequence(F.lit(1), F.size(h) - (length - 1)), lambda i: F.xxhash64(*[f(i) for f in at]))
        return (
            F.when(F.size(h) == 0, F.expr("array()").cast("array<bigint>"))
            .when(F.size(h) < length, F.array(F.xxhash64(h)))
            .otherwise(F.sort_array(F.array_distinct(every)))
        )

    return let(F.transform(words_of(ascii_lower(text)), lambda w: F.xxhash64(w)), of)


def _binomial_low(n: int, p: float, miss: float) -> int:
    """The largest m such that fewer than m of n hits have a chance of at most ``miss``."""
    total, m = 0.0, 0
    while m <= n:
        total += math.comb(n, m) * p**m * (1 - p) ** (n - m)
        if total > miss:
            break
        m += 1
    return m


def _least_overlap(sketch: int, percent: int) -> list[int]:
    """By sketch size from 0: how many values the sketch of any linked set shares with it.

    If the union fits into a sketch, the sketches are the sets and the bound is exact.
    Otherwise the smallest ``sketch`` values of the union are a random sample of it, of
    which a linked pair shares ``percent`` on average.
    """
    exact = [-(-percent * s // 100) for s in range(sketch + 1)]
    low = _binomial_low(sketch, percent / 100, MISS)
    return [e if s * 100 <= percent * sketch else min(e, low) for s, e in enumerate(exact)]


def _lookup(values: list[int], index: Column) -> Column:
    return F.get(F.lit(values), index)


def _possible(percent: int, a: str, b: str) -> Column:
    """Whether two members of a list can be similar enough.

    Of their ``n`` shingles ``c`` are the hub's and ``u`` nobody else's. What both have
    is at most the smaller ``c`` and, outside the hub, the smaller rest.
    """
    of = lambda t, x: F.col(f"{t}.{x}")
    rest = lambda t: of(t, "n") - of(t, "c") - of(t, "u")
    both = F.least(of(a, "c"), of(b, "c")) + F.least(rest(a), rest(b))
    return 100 * both >= percent * (of(a, "n") + of(b, "n") - both)


def _lists(reps: DataFrame, sketch: int, percent: int) -> DataFrame:
    """``node, keys``: per set the retained values whose lists hold every linked set."""
    values = reps.select("node", F.explode("sketch").alias("v"))
    shared = values.groupBy("v").agg(F.count("*").alias("df")).where("df > 1")
    seen = values.join(shared, "v").groupBy("node").agg(F.collect_list(F.struct("df", "v")).alias("found"))
    need = _lookup(_least_overlap(sketch, percent), F.least(F.col("n"), F.lit(sketch)).cast("int"))
    seen = seen.join(reps.select("node", "n"), "node").withColumn("need", need).where(F.size("found") >= F.col("need"))
    first = F.slice(F.array_sort("found"), F.lit(1), (F.size("found") - F.col("need") + 1).cast("int"))
    return seen.select("node", "n", F.transform(first, lambda x: x["v"]).alias("keys"))


def _verified(pairs: DataFrame, sets: DataFrame, sketch: int, percent: int) -> DataFrame:
    """The pairs ``a, b`` that are linked: sketch estimate first, then full sets."""
    slim = sets.select("node", F.slice("items", 1, sketch).alias("s"))
    p = pairs.join(slim.toDF("a", "sa"), "a").join(slim.toDF("b", "sb"), "b")
    union = F.slice(F.sort_array(F.array_union("sa", "sb")), 1, sketch)
    low = [_binomial_low(s, percent / 100, MISS) for s in range(sketch + 1)]
    p = p.withColumn("union", union).where(
        F.size(F.array_intersect("union", F.array_intersect("sa", "sb"))) >= _lookup(low, F.size("union"))
    )
    return _similar(_counted(materialize(p.select("a", "b"), "estimated"), sets), percent)


def _counted(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs with the sum of their set sizes and the exact size of the intersection."""
    full = sets.select("node", "items")
    p = pairs.join(full.toDF("a", "ia"), "a").join(full.toDF("b", "ib"), "b")
    return p.select("a", "b", (F.size("ia") + F.size("ib")).alias("both"), F.size(F.array_intersect("ia", "ib")).alias("common"))


def _similar(counted: DataFrame, percent: int) -> DataFrame:
    return counted.where(100 * F.col("common") >= percent * (F.col("both") - F.col("common"))).select("a", "b")


def _links(texts: DataFrame, reps: DataFrame, length: int, percent: int, sketch: int) -> DataFrame:
    """Labels ``node, comp`` of all sets that have a link; ``texts`` holds ``node, text``."""
    lists = materialize(_lists(reps, sketch, percent), "lists")
    by_value = lists.select("node", F.explode("keys").alias("v"))
    crowd = by_value.groupBy("v").agg(F.count("*").alias("c")).where("c > 1").select("v")
    candidates = by_value.join(crowd, "v").select("node").distinct()
    sets = texts.join(materialize(candidates, "candidates"), "node", "left_semi")
    sets = materialize(sets.select("node", shingles(F.col("text"), length).alias("items")), "sets")

    # Shingles of one candidate only cannot be shared.
    items = sets.select("node", F.explode("items").alias("v"))
    alone = items.groupBy("v").agg(F.count("*").alias("c"), F.min("node").alias("node")).where("c = 1")
    alone = alone.groupBy("node").agg(F.count("*").alias("u"))
    known = lists.join(sets.select("node"), "node").join(alone, "node", "left").withColumn("u", F.coalesce("u", F.lit(0)))
    known = known.where(100 * (F.col("n") - F.col("u")) >= percent * F.col("n"))
    share = F.col("u") / F.col("n")
    member = F.struct(share.alias("share"), F.col("node"))
    members = known.select("node", "n", "u", "keys", F.explode("keys").alias("v"))
    hubs = members.groupBy("v").agg(F.min(member).alias("hub"), F.count("*").alias("c")).where("c > 1")
    members = materialize(members.join(hubs.select("v", F.col("hub.node").alias("hub")), "v"), "members")

    to_hub = members.where("node <> hub").select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct()
    counted = materialize(_counted(to_hub, sets), "hub_overlaps")
    first = materialize(_similar(counted, percent), "hub_links")
    overlap = counted.select(F.col("a").alias("hub"), F.col("b").alias("node"), F.col("common").alias("c"))
    members = members.join(overlap, ["hub", "node"], "left").withColumn("c", F.coalesce("c", "n"))
    members = materialize(members, "placed_members")
    labels = connected_components(first)

    labelled = materialize(_labelled(members, labels), "labelled")
    left, right = labelled.where("comp <> core").alias("l"), labelled.alias("r")
    rest = left.join(right, F.col("l.v") == F.col("r.v")).where(
        (F.col("l.comp") != F.col("r.comp"))
        & _possible(percent, "l", "r")
        & ((F.col("r.comp") == F.col("r.core")) | (F.col("l.node") < F.col("r.node")))
        & (F.col("l.node") != F.col("l.hub"))
        & (F.col("r.node") != F.col("r.hub"))
        & (F.col("l.v") == F.array_min(F.array_intersect("l.keys", "r.keys")))
    )
    rest = rest.select(F.least("l.node", "r.node").alias("a"), F.greatest("l.node", "r.node").alias("b")).distinct()
    second = materialize(_verified(materialize(rest, "pairs"), sets, sketch, percent), "more_links")
    if second.isEmpty():
        return labels
    return connected_components(first.unionByName(second))


def _labelled(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Members of lists with their component and that of the list's hub."""
    out = members.join(labels, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    core = labels.select(F.col("node").alias("h"), F.col("comp").alias("core"))
    return out.join(core, F.col("hub") == F.col("h"), "left").withColumn("core", F.coalesce("core", "hub")).drop("h")


def find_groups(docs: DataFrame, length: int = SHINGLE, percent: int = PERCENT, sketch: int = SKETCH,
                id_col: str = "doc_id", text_col: str = "text", row_col: str | None = None,
                stored: bool = False) -> DataFrame:
    """One row per document: ``row_no, doc_id, n_shingles, component_id, kept``.

    ``component_id`` is the smallest id that links reach; ``kept`` is true for the row that
    stays of the group. Texts are read twice, so rows are told apart by ``row_col``, or by
    the number that ``placed_rows`` gives them.
    """
    if row_col is None:
        docs, (row_col,) = placed_rows(docs.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`")), "near_rows", stored)
    rows = docs.select(
        F.col(row_col).alias("row_no"),
        F.col(f"`{id_col}`").alias("doc_id"),
        shingles(text_of(f"`{text_col}`"), length).alias("items"),
    )
    key = F.concat(F.hex(F.xxhash64("items")), F.lit("-"), F.hex(F.xxhash64(F.lit(1), F.col("items"))))
    rows = rows.select(
        "row_no",
        "doc_id",
        F.size("items").cast("long").alias("n"),
        F.when(F.size("items") > 0, key).alias("key"),
        F.slice("items", 1, sketch).alias("sketch"),
    )
    rows = materialize(rows, "sketches")
    best = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id"), F.col("row_no"))).alias("best")
    classes = rows.where("n > 0").groupBy("key").agg(F.min("row_no").alias("node"), best)
    classes = materialize(classes, "classes")
    reps = rows.join(classes.select("node"), F.col("row_no") == F.col("node"), "left_semi")
    reps = materialize(reps.select(F.col("row_no").alias("node"), "n", "sketch"), "class_sketches")
    texts = docs.select(F.col(row_col).alias("node"), text_of(f"`{text_col}`").alias("text"))
    labels = _links(texts, reps, length, percent, sketch)

    # A component's smallest id, found per class first, goes back to classes and then to rows.
    joined = materialize(classes.join(labels, "node"), "linked_classes")
    best = joined.groupBy("comp").agg(F.min("best").alias("top"))
    joined = joined.join(best, "comp").select(F.col("key").alias("k"), "top")
    moved = classes.select("key", "best").join(joined, F.col("key") == F.col("k"), "left")
    moved = moved.select("key", F.coalesce("top", "best").alias("best"))
    out = rows.drop("sketch").join(materialize(moved, "class_groups"), "key", "left")
    alone = F.col("key").isNull()
    return out.select(
        "row_no",
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(alone, F.col("doc_id")).otherwise(F.col("best.doc_id")).alias("component_id"),
        (alone | (F.col("row_no") == F.col("best.row_no"))).alias("kept"),
    )


def drop_near_duplicates(docs: DataFrame, stored: bool = False, **options) -> DataFrame:
    """One document of every group, with all its columns. ``stored``: see ``placed_rows``."""
    rows, (row_no,) = placed_rows(docs, "near_rows", stored)
    found = find_groups(rows, row_col=row_no, **options)
    dropped = materialize(found.where(~F.col("kept")).select(F.col("row_no").alias(row_no)), "dropped_rows")
    return rows.join(dropped, row_no, "left_anti").drop(row_no)
