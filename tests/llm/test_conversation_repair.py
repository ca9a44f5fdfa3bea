import hashlib
import itertools
import random
import re
import zlib
from functools import lru_cache

import pytest

from check_oracle import compare
from flowsift.llm import conversation_repair as m
from flowsift.llm.common import read_table
from flowsift.llm.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string"
SPACE = " \t\n\x0b\x0c\r"


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        spaced = lambda v: " " if v is None else v
        k = zlib.crc32(f"{spaced(conv)}:{spaced(turn)}".encode()) % 20
        role, text = spaced(role), spaced(text)
        text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
        role = "user" if k == 4 else role
        out += [(conv, turn, role, text)] * {0: 0, 3: 2}.get(k, 1)
    return out


def solve(rows):
    """rows of (role, fault): least (cost, audit) and the lines it leaves, from the end backwards."""
    moves = {"": {"s": "S", "u": "U"}, "S": {"u": "U"}, "U": {"a": "A"}, "A": {"u": "U"}}
    word = {"u": "user", "a": "assistant"}

    @lru_cache(None)
    def best(i, state, free):
        """``free``: how many more rows may be inserted here."""
        found = []
        if i == len(rows) and state in ("", "A"):
            found.append((0, "", ()))

        def go(cost, edit, line, j, to, left):
            rest = best(j, to, left)
            if rest:
                found.append((cost + rest[0], edit + rest[1], ((line,) if line else ()) + rest[2]))

        if free:
            for c in "ua":
                if c in moves[state]:
                    go(3, "I", (word[c], ""), i, moves[state][c], free - 1)
        if i < len(rows):
            role, text, fault = rows[i]
            go(4, "D", None, i + 1, state, 3)
            if fault not in ("blank", "duplicate"):
                extra = 3 if fault == "truncated" else 0
                if role == "":
                    go(extra, "K", (role, text), i + 1, state, 3)
                elif role[0] in moves[state]:
                    go(extra, "K", (role, text), i + 1, moves[state][role[0]], 3)
                for c in "ua":
                    if c in moves[state]:
                        go(3 + extra, "R", (word[c], text), i + 1, moves[state][c], 3)
        return min(found) if found else None

    return best(0, "", 3)


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        stripped = text.strip(SPACE)
        fault = "blank" if not stripped else "duplicate" if (role, text) in seen else "truncated" if stripped[-1] not in ".!?" else ""
        seen.add((role, text))
        out.append((role, text, fault))
    return out


def brute(rows, harm=True):
    out = []
    rows_left = damaged(rows) if harm else rows
    for conv in {r[0] for r in rows}:
        mine = [r[1:] for r in rows_left if r[0] == conv]
        mark = lambda r: hashlib.md5(f"{len(r[1])}:{r[1]}{r[2]}".encode()).digest()
        mine.sort(key=lambda r: (r[0] is not None, r[0] or 0, mark(r)))
        known = faults(mine)
        cost, audit, lines = solve(tuple(known))
        turns = [r[0] for r in mine if r[0] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(mine, mine[1:]))
        count = [sum(f == name for *_, f in known) for name in ("blank", "duplicate", "truncated")]
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in lines).encode()).hexdigest()
        assert re.fullmatch("(s?(ua)+)?", "".join(r[:1] for r, _ in lines))
        out.append((conv, gaps, *count, illegal, cost, audit, digest))
    return sorted(out, key=repr)


def tuples(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_search_backwards_is_the_least_of_all():
    """The reference of these tests against plain enumeration of edits."""
    r = random.Random(5)
    for _ in range(40):
        rows = [(r.choice(["system", "user", "assistant", "tool"]), "t.", r.choice(["", "", "truncated", "blank"])) for _ in range(3)]
        found = []
        for gaps in itertools.product(("", "I", "II"), repeat=4):
            for edits in itertools.product("KRD", repeat=3):
                done = play(rows, "".join(g + e for g, e in zip(gaps, (*edits, ""))))
                if done is not None:
                    found.append(done)
        assert solve(tuple(rows))[:2] == min(found)


def play(rows, audit):
    initials, cost, i = "", 0, 0
    for e in audit:
        follows = "a" if initials[-1:] == "u" else "u"
        if e == "I":
            initials, cost = initials + follows, cost + 3
            continue
        role, _, fault = rows[i]
        i += 1
        if e == "D":
            cost += 4
            continue
        if fault == "blank":
            return None
        cost += (3 if e == "R" else 0) + (3 if fault == "truncated" else 0)
        initials += follows if e == "R" else role[0]
    return (cost, audit) if re.fullmatch("(s?(ua)+)?", initials) else None


@pytest.mark.parametrize("seed", range(3))
def test_matrices_of_any_grammar(seed):
    r = random.Random(seed)
    names = dict(zip("suaxe", ("system", "user", "assistant", "tool", "")))
    for _ in range(60):
        symbols = "".join(r.choice(m.SYMBOLS) for _ in range(r.randint(0, 14)))
        size = len(m.SYMBOLS)
        rounds = tuple(tuple((r.randrange(size + 9 * k), r.randrange(size + 9 * k)) for _ in range(9)) for k in range(3))
        rows = [("user" if s == "d" else names[s.lower()], "t.", "blank" if s == "d" else "truncated" if s.isupper() else "") for s in symbols]
        matrix = m.times(m.grammar(rounds).of(symbols), m.inserts())
        ends = [(c, rope.text) for (i, k), (c, rope) in matrix.items() if i == m.START and k in m.ENDS]
        assert min(ends) == solve(tuple(rows))[:2]


def test_query_against_brute_force(spark):
    rows = [tuple(r) for r in read_table(spark, SF, "conversations").collect()]
    assert tuples(QUERIES["op12_conversation_repair"](spark, SF)) == brute(rows)


def test_odd_rows(stored):
    r = random.Random(7)
    texts = ["Hello.", "What", " ", "", None, "x" * 50_000 + "!", "é ", "Yes?\n"]
    roles = ["user", "assistant", "system", "tool", "", None, "User"]
    rows = [(r.choice([1, 2, 3, None]), r.choice([0, 1, 2, 3, 9, None]), r.choice(roles), r.choice(texts)) for _ in range(80)]
    rows += [(50, t, "user", "Same.") for t in range(40)] + [(51, 1, "user", "Twice.")] * 30 + rows[:20]
    docs = stored(rows, SCHEMA)
    columns = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert tuples(m.repair_damaged(docs).select(*columns)) == brute(rows)
    assert tuples(m.repair_damaged(stored([], SCHEMA)).select(*columns)) == []


def test_conversation_that_loses_all_rows(stored):
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    got = tuples(m.repair_damaged(stored([(gone, 0, "user", "Hi.")], SCHEMA)))
    assert got == [(gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_long_conversations_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(m.chunks_of, "__defaults__", (7,))
    r = random.Random(8)
    rows = [(c, t // 2, r.choice(["user", "assistant", "assistant", "system"]), f"{r.randint(0, 99)}{r.choice(['.', ''])}") for c in range(3) for t in range(60)]
    df = spark.createDataFrame(rows, "conv long, turn long, role string, text string").repartition(3)
    assert tuples(m.repair(m.materialize(df, "rows"))) == brute(rows, harm=False)


def test_rules_are_shared(spark):
    sequences = spark.createDataFrame([("suauaua",), ("uauauaua",), ("ua",), ("",)], "symbols string")
    rules = m.learn_rules(sequences)
    u, a = m.SYMBOLS.index("u"), m.SYMBOLS.index("a")
    assert rules[0][0] == (u, a) and len(m.parse("uauauaua", rules)) <= 2
    assert m.learn_rules(sequences.where("symbols = ''")) == ()


def test_query_equals_sql(spark, con):
    result = compare("op12", spark, con, SF, QUERIES["op12_conversation_repair"], SQL["op12_conversation_repair"])
    assert result.startswith("ok") and "TYPES" not in result, result
