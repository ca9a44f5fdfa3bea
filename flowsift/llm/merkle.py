"""Merkle manifest of a table, with a proof for every row by pointer jumping.

Rows become leaves: SHA-256 of their columns. Leaves of one group, in the order of
their ids, are the bottom of a binary tree; the roots of the groups, in the order of
the groups, are the bottom of another one, whose root stands for the whole table.

*Tree.* Levels are built in blocks: a group of at most ``2 ** BLOCK_BITS`` neighbouring
nodes is enough to make the next ``BLOCK_BITS`` levels above it, so a tree of a billion
rows takes three shuffles, and no task sees more than a block at once.

*Proofs.* Every node first holds a segment of one step: the sibling on the way to its
parent. A self-join of nodes with the nodes that they point to doubles the distance
and concatenates the segments, until every leaf reaches its root. Only nodes whose
level is a multiple of the new distance are still needed, so the inner nodes to join
shrink from round to round, and rows meet ``log2(log2(rows))`` joins.

A step is 33 bytes: 1 or 2 for a sibling on the left or right and its digest, or 0 and
a blank if the run has no other node. ``fold`` recomputes a root from a leaf and steps.

Places are ranks in a range-partitioned order, so a group that holds a third of all
rows is spread over tasks like the others.

Edge cases: null columns count as ``-``; null groups come first, null ids first in their
group; rows that agree in group and id are leaves in the order of their digests, and
equal rows are leaves of their own; empty and very long texts are hashed whole. A
single leaf is the root of its group, a single group the root of the table, with no
steps. An empty table gives no rows. Other columns are not looked at.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowsift.operators.running import with_rank
from flowsift.storage import materialize

COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
BLOCK_BITS = 10
STEP_BYTES = 33
_BLANK = "cast('' as binary)"


def digest(*parts: Column) -> Column:
    """Lower-case hex SHA-256 of the parts one after the other."""
    return F.sha2(F.concat(*parts) if len(parts) > 1 else parts[0], 256)


def field(value: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def row_digest(values: list[Column]) -> Column:
    return digest(*map(field, values))


def _hex(binary: Column) -> Column:
    return F.lower(F.hex(binary))


def _depth(n: Column) -> Column:
    """Halvings, rounded up, until one of ``n`` nodes remains."""
    return F.when(n > 1, F.length(F.bin(n - 1))).otherwise(0)


def _pairs(nodes: Column) -> Column:
    parents = F.sequence(F.lit(0), F.floor((F.size(nodes) - 1) / 2).cast("int"))
    right = lambda i: F.coalesce(F.get(nodes, 2 * i + 1), F.lit(""))
    return F.transform(parents, lambda i: digest(F.get(nodes, 2 * i), right(i)))


def _blocks(nodes: DataFrame) -> DataFrame:
    """``tree, block, n, levels`` from ``tree, pos, digest, n``: the levels above up to one block of neighbours."""
    block = F.shiftright("pos", BLOCK_BITS)
    grouped = nodes.groupBy("tree", block.alias("block")).agg(
        F.max("n").alias("n"), F.array_sort(F.collect_list(F.struct("pos", "digest"))).alias("run")
    )
    bottom = F.transform("run", lambda x: _hex(x["digest"]))
    steps = F.least(_depth(F.col("n")), F.lit(BLOCK_BITS))
    each = F.when(steps > 0, F.sequence(F.lit(1), steps)).otherwise(F.expr("array()"))
    up = F.aggregate(each, F.array(bottom), lambda levels, _: F.concat(levels, F.array(_pairs(F.element_at(levels, -1)))))
    return grouped.select("tree", "block", "n", up.alias("levels"))


def _steps(blocks: DataFrame, base: int) -> DataFrame:
    """``tree, level, pos, path`` of every node below the top of its block: the step to its parent."""
    levels = F.col("levels")

    def sibling(nodes: Column, i: Column) -> Column:
        other = F.unhex(F.get(nodes, i.bitwiseXOR(F.lit(1))))
        side = F.when(i % 2 == 1, F.expr("X'01'")).otherwise(F.expr("X'02'"))
        return F.coalesce(F.concat(side, other), F.expr(f"cast(repeat('\\0', {STEP_BYTES}) as binary)"))

    inner = F.transform(
        F.slice(levels, 1, F.size(levels) - 1),
        lambda nodes, level: F.transform(
            nodes,
            lambda _, i: F.struct(
                level.alias("above"),
                i.alias("i"),
                sibling(nodes, i).alias("path"),
            ),
        ),
    )
    rows = blocks.select("tree", "block", F.explode(F.flatten(inner)).alias("x"))
    pos = F.expr(f"shiftleft(block, {BLOCK_BITS} - x.above) + x.i")
    return rows.select("tree", (F.col("x.above") + base).alias("level"), pos.alias("pos"), "x.path")


def build(nodes: DataFrame, largest: int) -> tuple[DataFrame, DataFrame]:
    """Trees over ``tree, pos, digest`` (binary) ``, n``, where ``n`` is the number of leaves of the tree.

    Returns (steps, roots): the first step of every node that is no root, and per tree its
    root and depth. ``largest`` is the largest ``n``.
    """
    steps, roots, base, left = [], [], 0, largest
    depth = _depth(F.col("n"))
    while True:
        blocks = materialize(_blocks(nodes), "merkle-blocks")
        top = F.element_at("levels", -1)[0]
        steps.append(_steps(blocks, base))
        roots.append(blocks.where(f"n <= {1 << BLOCK_BITS}").select("tree", top.alias("root"), (depth + base).alias("depth")))
        if left <= 1 << BLOCK_BITS:
            break
        nodes = blocks.where(f"n > {1 << BLOCK_BITS}").select(
            "tree",
            F.col("block").alias("pos"),
            F.unhex(top).alias("digest"),
            F.expr(f"shiftright(n - 1, {BLOCK_BITS}) + 1").alias("n"),
        )
        base, left = base + BLOCK_BITS, ((left - 1) >> BLOCK_BITS) + 1
    return reduce(DataFrame.unionByName, steps), reduce(DataFrame.unionByName, roots)


def paths(leaves: DataFrame, steps: DataFrame, largest: int) -> DataFrame:
    """``leaves`` (``tree, pos, ...``) with ``path``: all steps up to the root of their tree."""
    first = steps.where("level = 0").select("tree", "pos", "path")
    found = _extended(leaves.withColumn("path", F.expr(_BLANK)), first, 0)
    inner, distance, depth = steps.where("level > 0"), 1, max(largest - 1, 0).bit_length()
    while distance < depth:
        # Nodes at this distance from the leaves point as far again; leaves join them.
        found = _extended(found, inner.where(f"level = {distance}").select("tree", "pos", "path"), distance)
        if 2 * distance < depth:
            onward = inner.where(f"level % {2 * distance} = 0")
            target = inner.where(f"level % {2 * distance} = {distance}").select(
                F.col("tree").alias("t"), F.col("level").alias("l"), F.col("pos").alias("p"), F.col("path").alias("more")
            )
            points_to = F.shiftright("pos", distance) == F.col("p")
            joined = onward.join(target, (F.col("tree") == F.col("t")) & (F.col("level") + distance == F.col("l")) & points_to, "left")
            path = F.concat("path", F.coalesce("more", F.expr(_BLANK)))
            inner = materialize(joined.select("tree", "level", "pos", path.alias("path")), "merkle-jumps")
        distance *= 2
    return found


def _extended(leaves: DataFrame, nodes: DataFrame, distance: int) -> DataFrame:
    """Leaves whose path goes on by that of their ancestor at ``distance``, if it has one."""
    ancestor = nodes.select(F.col("tree").alias("t"), F.col("pos").alias("p"), F.col("path").alias("more"))
    met = leaves.join(ancestor, (F.col("tree") == F.col("t")) & (F.shiftright("pos", distance) == F.col("p")), "left")
    return met.withColumn("path", F.concat("path", F.coalesce("more", F.expr(_BLANK)))).drop("t", "p", "more")


def _places(path: Column) -> Column:
    n = (F.octet_length(path) / STEP_BYTES).cast("int")
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.expr("array()").cast("array<int>"))


def _side(path: Column, i: Column) -> Column:
    return F.hex(F.substr(path, i * STEP_BYTES + 1, F.lit(1)))


def _sibling(path: Column, i: Column) -> Column:
    return _hex(F.substr(path, i * STEP_BYTES + 2, F.lit(STEP_BYTES - 1)))


def siblings(path: Column) -> Column:
    """Digests of the siblings on a path, as an array."""
    met = F.filter(_places(path), lambda i: _side(path, i) != "00")
    return F.transform(met, lambda i: _sibling(path, i))


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf's digest and the steps of its proof lead to."""

    def step(below: Column, i: Column) -> Column:
        side, other = _side(path, i), _sibling(path, i)
        return digest(F.when(side == "01", F.concat(other, below)).when(side == "02", F.concat(below, other)).otherwise(below))

    return F.aggregate(_places(path), leaf, step)


def manifest(leaves: DataFrame) -> DataFrame:
    """``leaves`` with ``subroot, root, path`` and their place ``tree, pos``.

    ``leaves`` is a stored table with ``grp``, ``id`` and ``leaf`` (hex), and any other
    columns; its column ``row_no`` tells rows apart.
    """
    order = [F.col("grp").asc_nulls_first(), F.col("id").asc_nulls_first(), F.col("leaf"), F.col("row_no")]
    ranked = with_rank(leaves, order)
    groups = materialize(ranked.groupBy("grp").agg(F.min("rank").alias("start"), F.count("*").alias("n")), "merkle-groups")
    # Groups in order: their starts rise with them, so no second comparison is needed.
    groups = materialize(with_rank(groups, [F.col("start")], "tree"), "merkle-trees")
    n_groups, largest = groups.agg(F.count("*"), F.max("n")).first()
    known = groups.withColumnRenamed("grp", "_grp")
    placed = ranked.join(known, F.col("grp").eqNullSafe(F.col("_grp"))).withColumn("pos", F.col("rank") - F.col("start"))
    placed = materialize(placed.drop("_grp", "rank", "start"), "merkle-placed")
    steps, roots = build(placed.select("tree", "pos", F.unhex("leaf").alias("digest"), "n"), largest or 0)
    roots = materialize(roots.select("tree", F.col("root").alias("subroot")), "merkle-subroots")
    tops = roots.select(
        F.lit(0).cast("long").alias("tree"), F.col("tree").alias("pos"), F.unhex("subroot").alias("digest"), F.lit(n_groups).alias("n")
    )
    top_steps, top = build(tops, n_groups)
    top_paths = paths(tops.select("tree", "pos"), top_steps, n_groups)
    above = top_paths.join(top.select("tree", "root"), "tree").select(F.col("pos").alias("t"), F.col("path").alias("above"), "root")
    per_group = materialize(roots.withColumnRenamed("tree", "t").join(above, "t"), "merkle-tops")
    found = paths(placed.drop("n"), steps, largest or 0).join(per_group, F.col("tree") == F.col("t"))
    return found.withColumn("path", F.concat("path", "above")).drop("t", "above")


def check(docs: DataFrame, columns: tuple[str, ...] = COLUMNS, id_col: str = "doc_id", group_col: str = "lang",
          altered: str = "n_chars", tampered: Column | None = None) -> DataFrame:
    """Manifest of ``docs``, and what the proofs say of rows whose column ``altered`` grew by 1.

    ``tampered`` chooses these rows; by default those where 7 divides the CRC-32 of the id.
    A null stays null. Returns per row its id, ``leaf, subroot, root, path``, the digest of
    its siblings, the root recomputed from the row as it is now, and whether that is the root.
    """
    column = lambda c: F.col(f"`{c}`")
    hit = F.crc32(column(id_col).cast("string")) % 7 == 0 if tampered is None else tampered
    more = (column(altered).cast("decimal(38,0)") + 1).cast("string")
    now = row_digest([more if c == altered else column(c) for c in columns])
    leaves = docs.select(
        column(id_col).alias("id"),
        column(group_col).alias("grp"),
        row_digest([column(c) for c in columns]).alias("leaf"),
        F.when(hit & column(altered).isNotNull(), now).alias("changed"),
        F.monotonically_increasing_id().alias("row_no"),
    )
    found = manifest(materialize(leaves, "merkle-leaves"))
    seen = found.select(
        F.col("id").alias(id_col),
        "leaf",
        "subroot",
        "root",
        "path",
        digest(F.array_join(siblings(F.col("path")), "")).alias("proof_sha256"),
        fold(F.coalesce("changed", "leaf"), F.col("path")).alias("folded_root"),
    )
    return seen.withColumn("verified", F.col("folded_root") == F.col("root"))
