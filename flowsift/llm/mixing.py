"""Mix sources to target weights with a low-discrepancy schedule.

Every source is laid out as a line of tokens in a shuffled document order and cut
into blocks of equal length. Slot ``i`` of the mix gets the golden-ratio point
``frac((i + 1) * phi)``, computed in whole 64-bit steps, which is mapped through the
cumulative target shares to a source; the rank of the slot within its source is the
block it takes. Since such points fill every interval evenly, each stretch of the mix
holds the sources in their target shares, without drawing random numbers. A source stops
at its target, and one that the points served a few slots too little gets them at the
end, so the tokens taken are the target, rounded down.

A document tells its first slot and how many slots take words of it. ``mixed_documents``
writes the mix in slot order: a document stands where the block with its beginning stands.

Hot sources: prefix sums and ranks run over (source, bucket) first and over the
bucket totals second, so no task holds a whole source.

Edge cases: a null text has size 0; documents of size 0 and sources without words
take nothing; a null source is a source of its own, after all others; repeated rows
and repeated ids are documents of their own; an empty table gives no rows. The order
of a source is the MD5 of the id (a null id counts as empty), then size, then place
in the table, so reruns agree. Other columns are not looked at, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowsift.llm.common import placed_rows, text_of, words_of
from flowsift.storage import materialize

BLOCK_TOKENS = 256
MAX_EPOCHS = 3
SEED = "mix-1"
# Fixed value: the golden ratio's fractional part in steps of 2 ** -64.
GOLDEN = 11400714819323198485
_CELLS = 4096
# Values of the three hex digits that name a run.
_BUCKETS = 4096
_SLOTS_PER_RUN = 8192


def sizes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: str = SEED,
          row_cols: list[str] | None = None) -> DataFrame:
    """``row_no, row, doc_id, source, size`` and the shuffle key of every document.

    ``row`` holds ``row_cols``, by which rows can be found again; ``row_no`` is made in this scan.
    """
    key = F.coalesce(F.col("_id").cast("string"), F.lit(""))
    row_no = F.monotonically_increasing_id()
    rows = docs.select(
        row_no.alias("row_no"),
        F.struct(*row_cols or [row_no.alias("n")]).alias("row"),
        F.col(f"`{id_col}`").alias("_id"),
        F.col(f"`{source_col}`").cast("string").alias("source"),
        F.size(words_of(text_of(f"`{text_col}`"))).cast("long").alias("size"),
    )
    return rows.select(
        "row_no", "row", F.col("_id").alias("doc_id"), "source", "size", F.md5(F.concat(F.lit(f"{seed}:"), key)).alias("key")
    )


def by_position(last: Column | None = None) -> Column:
    """Weights 1, 2, 3, 1, ... in code-point order of the sources, null last."""
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    return (place - 1) % 3 + 1


def targets(rows: DataFrame, weight: Column | None = None, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Per source: ``source_size``, ``target`` and its end points on the unit interval.

    All tokens are shared by weight. A target stops at ``max_epochs`` times its source;
    the excess goes to the others by weight until none is above. In the order of limit
    over weight the sources that stop are a prefix, found with running sums. The tables
    here have one row per source.
    """
    per_source = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    # The constant partition keeps the windows to the rows of this small table.
    every = Window.partitionBy(F.lit(0))
    s = per_source.withColumn("weight", (by_position() if weight is None else weight).cast("double"))
    s = s.withColumn("cap", F.lit(float(max_epochs)) * F.col("source_size"))
    rising = every.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = rising.rowsBetween(Window.unboundedPreceding, -1)
    nothing = F.lit(0.0)
    s = s.select(
        "*",
        F.sum("source_size").over(every).alias("total"),
        F.sum("weight").over(every).alias("weights"),
        F.coalesce(F.sum("cap").over(before), nothing).alias("cap_before"),
        F.coalesce(F.sum("weight").over(before), nothing).alias("weight_before"),
    )
    level = (F.col("total") - F.col("cap_before")) / (F.col("weights") - F.col("weight_before"))
    s = s.withColumn("stops", level * F.col("weight") > F.col("cap"))
    stopped = lambda c: F.coalesce(F.sum(F.when(F.col("stops"), F.col(c))).over(every), nothing)
    s = s.withColumn(
        "target",
        F.when(F.col("stops"), F.col("cap")).otherwise(
            (F.col("total") - stopped("cap")) / (F.col("weights") - stopped("weight")) * F.col("weight")
        ),
    )
    line = every.orderBy(F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum("target").over(line)
    whole = F.sum("target").over(every)
    return s.select(
        "source",
        "source_size",
        "target",
        F.floor("target").cast("long").alias("to_take"),
        F.when(whole > 0, (end - F.col("target")) / whole).otherwise(0.0).alias("x_from"),
        F.when(whole > 0, end / whole).otherwise(0.0).alias("x_to"),
    )


def _same(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


def _running(df: DataFrame, keys: list[str], bucket: str, order: list[Column], amount: Column, name: str) -> DataFrame:
    """Sum of ``amount`` over the earlier rows of the same keys, by bucket totals and then inside buckets."""
    totals = df.groupBy(*keys, bucket).agg(F.sum(amount).alias("_in_bucket"))
    earlier = Window.partitionBy(*keys).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(
        *[F.col(k).alias(f"_{k}") for k in keys],
        F.col(bucket).alias("_bucket"),
        F.coalesce(F.sum("_in_bucket").over(earlier), F.lit(0)).alias("_before"),
    )
    inside = Window.partitionBy(*keys, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    on = F.col(bucket) == F.col("_bucket")
    for k in keys:
        on &= _same(F.col(k), F.col(f"_{k}"))
    df = df.withColumn("_inside", F.coalesce(F.sum(amount).over(inside), F.lit(0)))
    df = df.join(totals, on).withColumn(name, F.col("_before") + F.col("_inside"))
    return df.drop("_inside", "_before", "_bucket", *[f"_{k}" for k in keys])


def bucketed(rows: DataFrame) -> DataFrame:
    """``rows`` with ``bucket``: runs of the order by key, size and place.

    The first digits of the shuffled keys make ``_BUCKETS`` even runs. Where ids repeat, or are
    null, one of them can hold most rows; such runs are cut further, by size and by the part
    of the table. There are fewer than ``_BUCKETS`` of them, so they are broadcast.
    """
    runs = rows.withColumn("bucket", F.substring("key", 1, 3))
    counts = materialize(runs.groupBy("source", "bucket").agg(F.count("*").alias("c")), "mix_runs")
    fair = (counts.agg(F.sum("c")).first()[0] or 0) / _BUCKETS
    heavy = counts.where(F.col("c") > max(4 * fair, 64)).select(F.col("source").alias("s"), F.col("bucket").alias("b"))
    met = _same(F.col("source"), F.col("s")) & (F.col("bucket") == F.col("b"))
    part = F.shiftright("row_no", 33)
    fine = F.format_string("%s%016x%016x", F.col("key"), F.col("size"), part)
    cut = F.concat("bucket", F.when(F.col("b").isNotNull(), fine).otherwise(""))
    return runs.join(F.broadcast(heavy), met, "left").withColumn("bucket", cut).drop("s", "b")


def segments(rows: DataFrame, block_tokens: int) -> DataFrame:
    """Where each document lies on its source's line: one row per document and block it touches."""
    placed = _running(
        bucketed(rows.where("size > 0")),
        ["source"],
        "bucket",
        [F.col("key"), F.col("size"), F.col("row_no")],
        F.col("size"),
        "start",
    )
    b = F.lit(block_tokens)
    first, last = F.floor(F.col("start") / b), F.floor((F.col("start") + F.col("size") - 1) / b)
    cut = placed.select("row_no", "source", "start", "size", F.explode(F.sequence(first, last)).alias("block"))
    begin = F.greatest(F.col("start"), F.col("block") * b)
    end = F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * b)
    return cut.select(
        "row_no",
        "source",
        "block",
        (begin - F.col("block") * b).alias("from_token"),
        (end - begin).alias("n_tokens"),
        (begin - F.col("start")).alias("doc_token"),
    )


def schedule(goal: DataFrame, block_tokens: int) -> DataFrame:
    """The mix in order: ``slot, source, rank, epoch, block, take``.

    ``take`` is how many tokens of the block the slot uses. One driver action reads
    the total, a single number, to know how many slots there are.
    """
    spark = goal.sparkSession
    n = spark_total(goal, block_tokens)
    turn = F.expr(f"cast((cast(id + 1 as decimal(18, 0)) * {GOLDEN}BD) % {2**64}BD as double) / {2.0**64}D")
    points = spark.range(n).select(F.col("id").alias("slot"), turn.alias("x"))
    points = points.withColumn("cell", F.floor(F.col("x") * _CELLS))
    # A source covers the cells between its end points; inside a cell few sources remain.
    cells = goal.where("x_to > x_from").select(
        "source", "x_from", "x_to", F.explode(F.sequence(F.floor(F.col("x_from") * _CELLS), F.floor(F.col("x_to") * _CELLS))).alias("cell")
    )
    hit = points.join(cells, "cell").where("x >= x_from AND x < x_to")
    hit = hit.select("slot", "source", F.floor(F.col("slot") / _SLOTS_PER_RUN).alias("run"))
    ranked = _running(hit, ["source"], "run", [F.col("slot")], F.lit(1), "rank").select("slot", "source", "rank")
    b = F.lit(block_tokens)
    need = goal.where("to_take > 0").select(
        "source",
        "source_size",
        "to_take",
        F.ceil(F.col("source_size") / b).alias("n_blocks"),
    )
    rest = F.col("to_take") % F.col("source_size")
    need = need.withColumn("n_slots", F.floor(F.col("to_take") / F.col("source_size")) * F.col("n_blocks") + F.ceil(rest / b))
    served = ranked.groupBy(F.col("source").alias("s")).agg(F.count("*").alias("served"))
    short = need.join(served, _same(F.col("source"), F.col("s")), "left").withColumn("served", F.coalesce("served", F.lit(0)))
    more = short.where("served < n_slots").select(
        "source", F.explode(F.sequence(F.col("served"), F.col("n_slots") - 1)).alias("rank")
    )
    # The points miss a share by a few slots whatever their number, so these are few rows a source.
    late = Window.partitionBy(F.lit(0)).orderBy("rank", F.col("source").asc_nulls_last())
    more = more.select((F.row_number().over(late) + (n - 1)).cast("long").alias("slot"), "source", "rank")
    slots = ranked.unionByName(more)
    need = need.withColumnRenamed("source", "s")
    slots = slots.join(need, _same(F.col("source"), F.col("s"))).where("rank < n_slots")
    epoch, block = F.floor(F.col("rank") / F.col("n_blocks")), F.col("rank") % F.col("n_blocks")
    taken_before = epoch * F.col("source_size") + block * b
    length = F.least(b, F.col("source_size") - block * b)
    return slots.select(
        "slot",
        "source",
        "rank",
        epoch.alias("epoch"),
        block.alias("block"),
        F.least(length, F.col("to_take") - taken_before).alias("take"),
    ).where("take > 0")


def spark_total(goal: DataFrame, block_tokens: int) -> int:
    """Number of slots that all targets need together."""
    total = goal.agg(F.sum("target")).first()[0] or 0.0
    return int(total // block_tokens) + 1 if total else 0


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weight: Column | None = None, block_tokens: int = BLOCK_TOKENS, max_epochs: int = MAX_EPOCHS, seed: str = SEED,
        row_cols: list[str] | None = None):
    """Returns (rows, goal, uses).

    ``rows`` are the documents with their sizes, ``goal`` the sources with their
    targets, ``uses`` one row per slot and document piece: the piece starts at word
    ``doc_token`` of the document and has ``taken`` words.
    """
    rows = materialize(sizes(docs, id_col, text_col, source_col, seed, row_cols), "mix_sizes")
    goal = materialize(targets(rows, weight, max_epochs), "mix_targets")
    pieces = segments(rows, block_tokens).withColumnRenamed("source", "s").withColumnRenamed("block", "b")
    slots = schedule(goal, block_tokens)
    uses = slots.join(pieces, _same(F.col("source"), F.col("s")) & (F.col("block") == F.col("b")))
    taken = F.least(F.col("n_tokens"), F.col("take") - F.col("from_token"))
    uses = uses.withColumn("taken", taken).where("taken > 0")
    return rows, goal, uses.select("slot", "source", "rank", "epoch", "block", "row_no", "doc_token", "taken")


def taken_per_document(docs: DataFrame, **options) -> DataFrame:
    """``row_no, doc_id, source, size, source_size, target, taken, first_slot, n_slots`` of every document."""
    rows, goal, uses = mix(docs, **options)
    used = uses.groupBy(F.col("row_no").alias("r")).agg(
        F.sum("taken").alias("used"), F.min("slot").alias("first_slot"), F.count("*").alias("slots")
    )
    goal = goal.select(F.col("source").alias("s"), "source_size", "target")
    out = rows.join(used, F.col("row_no") == F.col("r"), "left").join(goal, _same(F.col("source"), F.col("s")))
    whole = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    return out.select(
        "row_no",
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        whole("used").alias("taken"),
        "first_slot",
        whole("slots").alias("n_slots"),
    )


def mixed_documents(docs: DataFrame, text_col: str = "text", stored: bool = False, **options) -> DataFrame:
    """The documents of the mix with their own columns, in slot order.

    A document that the mix takes twice stands at two places; one of which only a part of
    the words is taken (at the end of a source's share) has its first words there. A
    document without words belongs to no block; it stays once, at the end. Texts are moved
    to their place and then sorted; they are not stored in between. ``stored``: see ``placed_rows``.
    """
    texts, place = placed_rows(docs, "mix_rows", stored)
    rows, _, uses = mix(texts, text_col=text_col, row_cols=place, **options)
    begins = F.min(F.struct("doc_token", "slot"))["slot"].alias("slot")
    copies = uses.groupBy("row_no", "epoch").agg(begins, F.sum("taken").alias("words"))
    blank = rows.where("size = 0").select("row", F.lit(None).cast("long").alias("slot"), F.lit(0).cast("long").alias("words"))
    copies = rows.join(copies, "row_no").select("row", "slot", F.when(F.col("words") < F.col("size"), F.col("words")).otherwise(0).alias("words"))
    copies = materialize(copies.unionByName(blank), "mix_copies").select("row.*", F.struct("slot", "words").alias("_copy"))
    own = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    found = texts.select(*place, own).join(copies, place).select("_row", "_copy.slot", "_copy.words")
    text = F.col(f"_row.`{text_col}`")
    cut = F.array_join(F.slice(words_of(text), 1, F.col("words").cast("int")), " ")
    row = F.col("_row").withField(f"`{text_col}`", F.when(F.col("words") == 0, text).otherwise(cut))
    order = [F.col("slot").asc_nulls_last(), F.col("at")]
    # Documents whose beginning lies in one block share its slot; a hash orders them.
    laid = found.select("slot", F.xxhash64("_row").alias("at"), row.alias("_row"))
    return laid.repartitionByRange(*order).sortWithinPartitions(*order).select("_row.*")
