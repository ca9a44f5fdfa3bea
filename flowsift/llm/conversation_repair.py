"""Cheapest repair of the structure of conversations, by dynamic programming over a shared grammar.

A conversation is right if its role initials read ``(s?(ua)+)?``. Rows are kept, given
another role, deleted or inserted at a cost; blank rows and repeats must go, cut-off
texts cost more if they stay. Each row becomes one symbol of role initial and fault, and
what a run of symbols can do is a min-plus matrix over the four states of that pattern:
the least cost from state to state, with the edits as an audit text.

*Grammar.* Conversations share most of their structure. Re-Pair rounds count adjacent
symbols over all distinct sequences and name the most frequent pairs by rules. Each
rule's matrix is the product of its two parts', evaluated once, bottom-up, with audits
as ropes that point to the parts' ropes; every conversation that uses a rule shares it.

*Long conversations.* Rows are ranked over the whole table and cut into chunks of
``CHUNK`` rows. Chunk matrices are made wherever the chunk lies, and only they are put
together per conversation, a vector at a time. Of equal costs the smaller audit wins;
candidates of equal cost that handle the same rows are never prefixes of one another, so
choosing in parts gives the smallest of the whole.

The digest of the repaired text is that of one text, which must be read in order: texts
are shuffled and sorted by conversation once and hashed as they stream by, in batches.

Edge cases: null ids are one conversation; nulls in other columns count as one space. Rows
of equal turn are ordered by a digest of role and text; equal rows are copies of each other.
A row without a role initial can be kept anywhere, as it adds nothing to the pattern. A
conversation that loses all rows, like a table that does, costs nothing. Other columns
are not looked at. Empty tables give no rows.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Callable, Iterator
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from flowsift.operators.running import with_rank
from flowsift.storage import materialize

# Fixed value: the six ASCII spaces.
SPACES = " \t\n\x0b\x0c\r"
CHUNK = 1024
ROUNDS, RULES_PER_ROUND = 5, 48

# Costs and initials of the edits.
RENAME, DELETE, INSERT, CUT_OFF = 3, 4, 3, 3
# States: nothing yet, after a system row, after a user row, after an assistant row.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
ENDS = (START, ASSISTANT)
NEXT = {START: ("user", USER), SYSTEM: ("user", USER), USER: ("assistant", ASSISTANT), ASSISTANT: ("user", USER)}
KEEPS = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}, "x": {}, "e": {q: q for q in STATES}}
# One letter a row: its initial, in capitals if cut off; x for any other initial, e for none, d for rows that must go.
SYMBOLS = "dsuaxeSUAXE"


class Rope:
    """A text made of two ropes; it is written out when first asked for."""

    __slots__ = ("left", "right", "_text")

    def __init__(self, text: str | None = None, left: Rope | None = None, right: Rope | None = None):
        self._text, self.left, self.right = text, left, right

    @property
    def text(self) -> str:
        if self._text is None:
            todo, parts = [self], []
            while todo:
                rope = todo.pop()
                if rope._text is None:
                    todo += (rope.right, rope.left)
                else:
                    parts.append(rope._text)
            self._text = "".join(parts)
        return self._text


# From state to state: (cost, audit). A pair that is missing cannot be reached.
Matrix = dict[tuple[int, int], tuple[int, Rope]]


def _better(old: tuple[int, Rope] | None, cost: int, rope: Rope) -> bool:
    return old is None or cost < old[0] or (cost == old[0] and rope.text < old[1].text)


def times(one: Matrix, two: Matrix) -> Matrix:
    """Min-plus product; of equal costs the smaller audit."""
    out: Matrix = {}
    for (i, j), (c, a) in one.items():
        for k in STATES:
            found = two.get((j, k))
            if found and ((old := out.get((i, k))) is None or c + found[0] <= old[0]):
                rope = Rope(left=a, right=found[1])
                if _better(old, c + found[0], rope):
                    out[i, k] = (c + found[0], rope)
    return out


def inserts() -> Matrix:
    """What inserted rows alone can do. Going round in circles only costs more."""
    out: Matrix = {(q, q): (0, Rope("")) for q in STATES}
    for q in STATES:
        at, n = NEXT[q][1], 1
        while (q, at) not in out:
            out[q, at] = (n * INSERT, Rope("I" * n))
            at, n = NEXT[at][1], n + 1
    return out


def of_symbol(symbol: str) -> Matrix:
    """Inserted rows, then one row with the given symbol."""
    step: Matrix = {(q, q): (DELETE, Rope("D")) for q in STATES}
    if symbol != "d":
        extra = CUT_OFF if symbol.isupper() else 0
        for q in STATES:
            options = [((q, NEXT[q][1]), RENAME + extra, "R")]
            if q in KEEPS[symbol.lower()]:
                options.append(((q, KEEPS[symbol.lower()][q]), extra, "K"))
            for key, cost, edit in options:
                if _better(step.get(key), cost, Rope(edit)):
                    step[key] = (cost, Rope(edit))
    return times(inserts(), step)


Rules = tuple[tuple[tuple[int, int], ...], ...]


def parse(symbols: str, rounds: Rules) -> list[int]:
    """Numbers of symbols and rules: each round replaces its pairs from the left."""
    ids = [SYMBOLS.index(s) for s in symbols]
    first = len(SYMBOLS)
    for pairs in rounds:
        names = {pair: first + i for i, pair in enumerate(pairs)}
        first += len(pairs)
        out: list[int] = []
        for x in ids:
            name = names.get((out[-1], x)) if out else None
            if name is None:
                out.append(x)
            else:
                out[-1] = name
        ids = out
    return ids


def learn_rules(sequences: DataFrame, rounds: int = ROUNDS, per_round: int = RULES_PER_ROUND) -> Rules:
    """Re-Pair over the distinct sequences: the most frequent pairs of each round, until none repeats.

    Only the rules reach the driver. Pairs are counted per task before they are shuffled.
    """
    rules: Rules = ()
    for _ in range(rounds):
        known = rules

        def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            seen: Counter = Counter()
            for batch in batches:
                for symbols in batch["symbols"]:
                    ids = parse(symbols, known)
                    seen.update(zip(ids, ids[1:]))
            yield pd.DataFrame([(a, b, n) for (a, b), n in seen.items()], columns=["a", "b", "n"])

        pairs = sequences.mapInPandas(count, "a int, b int, n long").groupBy("a", "b").agg(F.sum("n").alias("n"))
        top = pairs.where("n > 1").orderBy(F.col("n").desc(), "a", "b").limit(per_round).collect()
        if not top:
            break
        rules += (tuple((r["a"], r["b"]) for r in top),)
    return rules


class Grammar:
    """Matrices of all symbols and rules."""

    def __init__(self, rounds: Rules):
        self.rounds = rounds
        self.matrices = [of_symbol(s) for s in SYMBOLS]
        for pairs in rounds:
            self.matrices += [times(self.matrices[a], self.matrices[b]) for a, b in pairs]
        self.of = lru_cache(20_000)(self._of)

    def _of(self, symbols: str) -> Matrix:
        out: Matrix = {(q, q): (0, Rope("")) for q in STATES}
        for x in parse(symbols, self.rounds):
            out = times(out, self.matrices[x])
        return out


@lru_cache(2)
def grammar(rounds: Rules) -> Grammar:
    """One per worker process."""
    return Grammar(rounds)


def damage(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Rows with faults put in by the CRC-32 of conversation and turn: dropped, emptied, cut off, repeated, given to the user."""
    column = lambda c: F.col(f"`{c}`")
    spaced = lambda c: F.coalesce(column(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(spaced(conv_col), F.lit(":"), spaced(turn_col))) % 20
    text = F.when(fault == 1, "").when(fault == 2, F.regexp_replace(spaced(text_col), "[.!?]", "")).otherwise(spaced(text_col))
    return rows.select(
        column(conv_col).alias("conv"),
        column(turn_col).alias("turn"),
        F.when(fault == 4, "user").otherwise(spaced(role_col)).alias("role"),
        text.alias("text"),
        F.explode(F.when(fault == 0, F.expr("array()")).when(fault == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    ).drop("copy")


def _mark() -> Column:
    """Digest that stands for role and text."""
    return F.unhex(F.md5(F.concat(F.char_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))))


def _order(*, last: str) -> list[Column]:
    return [F.col("conv").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("mark"), F.col(last)]


def symbols_of(rows: DataFrame) -> DataFrame:
    """``conv, turn, rank, initial, fault, symbol`` of every row of ``conv, turn, role, text``; texts stay behind."""
    last = F.right(F.rtrim("text", F.lit(SPACES)), F.lit(1))
    narrow = rows.select(
        "conv",
        "turn",
        _mark().alias("mark"),
        F.substring("role", 1, 1).alias("initial"),
        (last == "").alias("blank"),
        (~last.isin(".", "!", "?")).alias("cut_off"),
        F.monotonically_increasing_id().alias("row_no"),
    )
    ranked = with_rank(materialize(narrow, "turns"), _order(last="row_no"))
    # The first row of each role and text, found by its rank: no group of repeats meets in one task.
    first = ranked.groupBy("conv", "mark").agg(F.min("rank").alias("rank")).select("rank", F.lit(True).alias("is_first"))
    known = ranked.join(first, "rank", "left")
    fault = (
        F.when(F.col("blank"), "blank")
        .when(F.col("is_first").isNull(), "duplicate")
        .when(F.col("cut_off"), "truncated")
        .otherwise("")
    )
    initial = F.col("initial")
    letter = F.when(initial == "", "e").when(initial.isin("s", "u", "a"), initial).otherwise("x")
    symbol = F.when(F.col("fault").isin("blank", "duplicate"), "d").when(F.col("fault") == "truncated", F.upper(letter)).otherwise(letter)
    return known.withColumn("fault", fault).select("conv", "turn", "rank", "initial", "fault", symbol.alias("symbol"))


def chunks_of(rows: DataFrame, size: int = CHUNK) -> DataFrame:
    """One row per conversation and run of ranks: its symbols and what its neighbours need to know."""
    run = F.array_sort(F.collect_list(F.struct("rank", "turn", "initial", "symbol")))
    counted = rows.groupBy("conv", F.floor(F.col("rank") / size).alias("chunk")).agg(
        *[F.count_if(F.col("fault") == name).alias(name) for name in ("blank", "duplicate", "truncated")], run.alias("run")
    )
    turns = F.array_compact(F.transform("run", lambda x: x["turn"]))
    pairs = F.transform(F.slice("run", 2, F.size("run")), lambda x, i: F.concat(F.get("run", i)["initial"], x["initial"]))
    ends = lambda field: (F.element_at("run", 1)[field], F.element_at("run", -1)[field])
    return counted.select(
        "conv",
        "chunk",
        "blank",
        "duplicate",
        "truncated",
        F.size(F.filter(pairs, lambda p: ~p.isin("su", "ua", "au"))).cast("long").alias("illegal"),
        ends("initial")[0].alias("first_initial"),
        ends("initial")[1].alias("last_initial"),
        F.array_min(turns).alias("first_turn"),
        F.array_max(turns).alias("last_turn"),
        F.size(F.array_distinct(turns)).cast("long").alias("n_turns"),
        F.array_join(F.transform("run", lambda x: x["symbol"]), "").alias("symbols"),
    )


def with_matrices(chunks: DataFrame, rules: Rules) -> DataFrame:
    """Chunks with ``costs`` and ``audits`` from each state to each (null where there is no way)."""
    schema = T.StructType([*chunks.schema, *T.StructType.fromDDL("costs array<long>, audits array<string>")])
    every = [(i, k) for i in STATES for k in STATES]

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = grammar(rules).of
        for batch in batches:
            matrices = [of(s) for s in batch.column("symbols").to_pylist()]
            costs = [[m[e][0] if e in m else None for e in every] for m in matrices]
            audits = [[m[e][1].text if e in m else None for e in every] for m in matrices]
            columns = [*batch.columns, pa.array(costs, pa.list_(pa.int64())), pa.array(audits, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "costs", "audits"])

    return chunks.mapInArrow(solve, schema)


class _Trail:
    """An audit that grows by pieces; trails that fork share what lies before."""

    __slots__ = ("before", "piece")

    def __init__(self, before: _Trail | None, piece: str):
        self.before, self.piece = before, piece

    def pieces(self, until: _Trail | None = None) -> str:
        found, at = [], self
        while at is not until and at is not None:
            found.append(at.piece)
            at = at.before
        return "".join(reversed(found))

    def less(self, other: _Trail) -> bool:
        # Both have one piece per chunk, so their fork is reached at the same step.
        a, b = self, other
        while a is not b and a is not None:
            a, b = a.before, b.before
        return self.pieces(a) < other.pieces(a)


class _Conversation:
    """Chunks of one conversation, put together in order."""

    COUNTS = ("blank", "duplicate", "truncated", "illegal")

    def __init__(self):
        self.counts = dict.fromkeys(self.COUNTS, 0)
        self.vector: dict[int, tuple[int, _Trail]] = {START: (0, _Trail(None, ""))}
        self.turns = self.first_turn = self.last_turn = 0
        self.last_initial: str | None = None

    def add(self, chunk: dict) -> None:
        for name in self.COUNTS:
            self.counts[name] += chunk[name]
        if self.last_initial is not None:
            self.counts["illegal"] += self.last_initial + chunk["first_initial"] not in ("su", "ua", "au")
        self.last_initial = chunk["last_initial"]
        if chunk["n_turns"]:
            # Turns rise, so a chunk shares at most its first one with those before.
            shared = self.turns and self.last_turn == chunk["first_turn"]
            self.first_turn = self.first_turn if self.turns else chunk["first_turn"]
            self.turns += chunk["n_turns"] - bool(shared)
            self.last_turn = chunk["last_turn"]
        self._go(lambda i, k: (chunk["costs"][4 * i + k], chunk["audits"][4 * i + k]))

    def _go(self, way: Callable[[int, int], tuple[int | None, str | None]]) -> None:
        out: dict[int, tuple[int, _Trail]] = {}
        for i, (cost, trail) in self.vector.items():
            for k in STATES:
                more, audit = way(i, k)
                if more is None:
                    continue
                longer = _Trail(trail, audit)
                old = out.get(k)
                if old is None or cost + more < old[0] or (cost + more == old[0] and longer.less(old[1])):
                    out[k] = (cost + more, longer)
        self.vector = out

    def result(self) -> dict:
        ending = {key: (cost, rope.text) for key, (cost, rope) in inserts().items()}
        self._go(lambda i, k: ending.get((i, k), (None, None)) if k in ENDS else (None, None))
        cost, audit = min((cost, trail.pieces()) for cost, trail in self.vector.values())
        gaps = self.last_turn - self.first_turn + 1 - self.turns if self.turns else 0
        return {"gaps": gaps, **self.counts, "cost": cost, "audit": audit}


RESULT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def put_together(chunks: DataFrame, convs: DataFrame) -> DataFrame:
    """One row per conversation of ``convs``: counts, least cost and audit."""
    every = chunks.unionByName(convs.withColumn("chunk", F.lit(-1).cast("long")), allowMissingColumns=True)
    placed = every.repartition("conv").sortWithinPartitions(F.col("conv").asc_nulls_first(), "chunk")

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nothing = object()
        conv, held = nothing, _Conversation()
        for batch in batches:
            done = []
            for row in batch.to_pylist():
                if conv is nothing or row["conv"] != conv:
                    if conv is not nothing:
                        done.append({"conv": conv, **held.result()})
                    conv, held = row["conv"], _Conversation()
                if row["chunk"] >= 0:
                    held.add(row)
            yield _batch(done, types)
        if conv is not nothing:
            yield _batch([{"conv": conv, **held.result()}], types)

    schema = T.StructType([T.StructField("conv", chunks.schema["conv"].dataType), *T.StructType.fromDDL(RESULT)])
    types = to_arrow_schema(schema)
    return placed.mapInArrow(fold, schema)


def _batch(rows: list[dict], types: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=types)


class _Repaired:
    """Digest of ``role:text`` lines as an audit leaves them."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state, self.lines = audit, 0, START, 0
        self.hash = hashlib.sha256()

    def _write(self, role: str, text: str) -> None:
        self.hash.update((("\n" if self.lines else "") + f"{role}:{text}").encode("utf-8", "surrogatepass"))
        self.lines += 1

    def _insert(self) -> None:
        while self.audit[self.at : self.at + 1] == "I":
            role, self.state = NEXT[self.state]
            self._write(role, "")
            self.at += 1

    def add(self, role: str, text: str) -> None:
        self._insert()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            self.state = KEEPS[role[:1] or "e"][self.state]
            self._write(role, text)
        elif edit == "R":
            role, self.state = NEXT[self.state]
            self._write(role, text)

    def digest(self) -> str:
        self._insert()
        return self.hash.hexdigest()


def with_digests(results: DataFrame, rows: DataFrame) -> DataFrame:
    """``results`` with ``repaired_sha256`` of the texts of ``rows``."""
    names = results.columns
    heads = results.withColumn("part", F.lit(0))
    texts = rows.select("conv", "turn", "role", "text", _mark().alias("mark"), F.lit(1).alias("part"))
    every = heads.unionByName(texts, allowMissingColumns=True)
    order = [F.col("conv").asc_nulls_first(), "part", F.col("turn").asc_nulls_first(), "mark"]
    placed = every.repartition("conv").sortWithinPartitions(*order).select(*names, "part", "role", "text")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, held = None, None
        for batch in batches:
            done = []
            for row in batch.to_pylist():
                if row["part"] == 0:
                    if head:
                        done.append({**head, "repaired_sha256": held.digest()})
                    head, held = {n: row[n] for n in names}, _Repaired(row["audit"])
                else:
                    held.add(row["role"], row["text"])
            yield _batch(done, types)
        if head:
            yield _batch([{**head, "repaired_sha256": held.digest()}], types)

    schema = T.StructType([*results.schema, T.StructField("repaired_sha256", T.StringType())])
    types = to_arrow_schema(schema)
    return placed.mapInArrow(write, schema)


def audit(rows: DataFrame, convs: DataFrame) -> DataFrame:
    """Counts of faults, least cost and audit of every conversation of ``convs`` over ``conv, turn, role, text``."""
    chunks = materialize(chunks_of(symbols_of(rows)), "chunks")
    rules = learn_rules(materialize(chunks.select("symbols").distinct(), "sequences"))
    return put_together(with_matrices(chunks, rules), convs)


def repair_damaged(rows: DataFrame, conv_col: str = "conv_id", **columns: str) -> DataFrame:
    """Damages the rows and repairs them: one row per conversation of ``rows``."""
    harmed = damage(rows, conv_col, **columns)
    convs = rows.select(F.col(f"`{conv_col}`").alias("conv")).distinct()
    found = materialize(audit(harmed, convs), "audits")
    return with_digests(found, harmed).withColumnRenamed("conv", conv_col)


def repair(rows: DataFrame) -> DataFrame:
    """Repairs ``conv, turn, role, text`` (no nulls but in ``conv`` and ``turn``) as they are: one row per conversation."""
    return with_digests(materialize(audit(rows, rows.select("conv").distinct()), "audits"), rows)
