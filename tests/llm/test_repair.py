"""Conversation repair against a brute-force search, block borders, huge and edge conversations."""

import hashlib
import itertools
import random
import zlib

import duckdb
import pytest
from adfuse.llm import repair as R
from adfuse.llm.oracle import SQL
from edge import frame

KINDS = "conv_id bigint, turn bigint, role string, text string"
WHITE = " \t\n\x0b\x0c\r"


def fault(rows, k):
    role, text = rows[k]
    if not text.strip(WHITE):
        return "blank"
    if rows[k] in rows[:k]:
        return "duplicate"
    return "" if text.rstrip(WHITE)[-1] in ".!?" else "truncated"


def legal(roles):
    initials = "".join(r[:1] if r[:1] in ("s", "u", "a") else "x" for r in roles)
    rest = initials[1:] if initials.startswith("s") else initials
    return initials == "" or (rest != "" and rest == "ua" * (len(rest) // 2))


def search(rows):
    """The cheapest edits by trying all of them, least audit first among equals; at most two insertions in a row."""
    best = (10**9, "", [])

    def go(k, cost, audit, out, inserted):
        nonlocal best
        if cost > best[0]:
            return
        if k == len(rows) and legal([r for r, _ in out]):
            best = min(best, (cost, audit, out), key=lambda b: b[:2])
        if inserted < 2:
            for role in ("user", "assistant"):
                go(k, cost + 3, audit + "I", [*out, (role, "")], inserted + 1)
        if k == len(rows):
            return
        role, text = rows[k]
        wrong = fault(rows, k)
        go(k + 1, cost + 4, audit + "D", out, 0)
        if wrong in ("", "truncated"):
            more = 3 * (wrong == "truncated")
            go(k + 1, cost + more, audit + "K", [*out, (role, text)], 0)
            for new in ("user", "assistant"):
                go(k + 1, cost + 3 + more, audit + "R", [*out, (new, text)], 0)

    go(0, 0, "", [], 0)
    return best


def states(rows):
    """(cost, audit) of any length by the least path into each state, without tables or blocks."""
    at = {0: (0, "")}
    after = {"s": 1, "u": 2, "a": 3}

    def follows(q, initial):
        return after.get(initial) if (q, initial) in {(0, "s"), (0, "u"), (1, "u"), (2, "a"), (3, "u")} else None

    def put(into, q, way):
        if q is not None and (q not in into or way < into[q]):
            into[q] = way

    for k in range(len(rows) + 1):
        for _ in range(2):
            for q, (cost, audit) in sorted(at.items()):
                for i in "ua":
                    put(at, follows(q, i), (cost + 3, audit + "I"))
        if k == len(rows):
            break
        new, wrong = {}, fault(rows, k)
        for q, (cost, audit) in at.items():
            put(new, q, (cost + 4, audit + "D"))
            if wrong in ("", "truncated"):
                more = 3 * (wrong == "truncated")
                put(new, follows(q, rows[k][0][:1]), (cost + more, audit + "K"))
                for i in "ua":
                    put(new, follows(q, i), (cost + 3 + more, audit + "R"))
        at = new
    return min(at[q] for q in (0, 3) if q in at)


def marks(rows):
    kinds = ("", "blank", "duplicate", "truncated")
    return "".join(
        R.MARKS[("sua".find(r[:1]) if r[:1] in ("s", "u", "a") else 3) * 4 + kinds.index(fault(rows, k))]
        for k, (r, _) in enumerate(rows)
    )


ROLES = ["user", "assistant", "system", "tool", "", "User", "u"]
TEXTS = ["Yes.", "No", " ", "", "Why?", "Stop!\n", "so on... \t", "\x0b", "a"]


def test_every_short_conversation_and_block_border():
    for n in range(4):  # all mixes of initial and fault
        for combo in itertools.product("suao", ("Yes", "Yes.", ""), repeat=n):
            rows = [
                ({"s": "system", "u": "user", "a": "assistant", "o": "tool"}[i], t and f"{k} {t}")
                for k, (i, t) in enumerate(zip(combo[::2], combo[1::2], strict=True))
            ]
            got = R.inspect(marks(rows))
            assert (got["cost"], got["audit"]) == states(rows)
    r = random.Random(1)
    for _ in range(40):
        rows = [(r.choice(ROLES), r.choice(TEXTS)) for _ in range(r.randint(0, 3))]
        got = R.inspect(marks(rows))
        assert (got["cost"], got["audit"]) == search(rows)[:2]


@pytest.mark.parametrize("block", [1, 2, 3, 5])
def test_blocks_of_any_length_agree(block):
    tables, r = R.Tables(block), random.Random(block)
    assert len(tables.vectors) < 100
    for n in (0, 1, block, 4 * block, 4 * block + 1, 997):
        rows = [(r.choice(ROLES[:4]), f"{k}{r.choice(['.', '', '!'])}") for k in range(n)]
        m = marks(rows)
        assert tables.cheapest(R._SYMBOL[[ord(c) - 65 for c in m]]) == states(rows)


def repaired(rows, audit):
    letters = [e for e in audit if e != "D"]
    out, source = [], iter(rows)
    for e in audit:
        row = None if e == "I" else next(source)
        if e != "D":
            role = row[0] if e == "K" else "user" if (len(out) + len(letters)) % 2 == 0 else "assistant"
            out.append((role, row[1] if row else ""))
    return out


def expected(rows):
    """The whole result row of one conversation of (turn, role, text) after damage, in order."""
    plain = [(r, t) for _, r, t in rows]
    turns = [t for t, _, _ in rows if t is not None]
    faults = [fault(plain, k) for k in range(len(plain))]
    initials = [r[:1] for r, _ in plain]
    cost, audit = states(plain)
    text = "\n".join(f"{r}:{t}" for r, t in repaired(plain, audit))
    return (
        max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
        *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
        sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False)),
        *(cost, audit, hashlib.sha256(text.encode()).hexdigest()),
    )


def damaged(rows):
    out = {}
    for conv, turn, role, text in rows:
        out.setdefault(conv, [])
        role, text = (" " if v is None else v for v in (role, text))
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        if kind == 0:
            continue
        text = {1: "", 2: "".join(c for c in text if c not in ".!?")}.get(kind, text)
        out[conv] += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    order = lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])
    return {c: sorted(r, key=order) for c, r in out.items()}


def random_rows():
    r = random.Random(7)
    rows = [
        (conv, r.choice([None, *range(-3, 9)]), r.choice([None, *ROLES]), r.choice([None, *TEXTS, "ü 日本."]))
        for conv in [*range(60), None, -5, 2**60]
        for _ in range(r.randint(1, 9))
    ]
    return rows + rows[:20]


def test_damaged_conversations_against_plain_python(spark):
    rows = random_rows()
    clashing = frame(spark, rows, kinds=KINDS).withColumnRenamed("size", "audit")
    ids = spark.createDataFrame([(c,) for c in {r[0] for r in rows}], "conv_id bigint")
    report, fixed = R.repair(R.damage(clashing), ids)
    hashes = {r[0]: r[1] for r in R.line_hashes(fixed).collect()}
    got = {r[0]: (*r[1:], hashes.get(r[0], hashlib.sha256(b"").hexdigest())) for r in report.collect()}
    assert got == {c: expected(rows) for c, rows in damaged(rows).items()}


def test_sql_twin_on_nulls_ties_and_repeats(spark, tmp_path):
    path = f"{tmp_path}/conversations.parquet"
    spark.createDataFrame(random_rows(), KINDS).coalesce(1).write.parquet(path)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{path}/*.parquet'")
    got = R.op11_repair(spark, str(tmp_path))
    want = con.execute(f"SELECT {', '.join(got.columns)} FROM ({SQL['op11_repair']})").fetchall()
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)


def test_one_huge_conversation_lies_in_many_chunks(spark):
    r = random.Random(2)
    rows = [(3, k // 2, r.choice(ROLES[:3]), r.choice(["", f"{k}.", f"{k}", "same."])) for k in range(6000)]
    df = spark.createDataFrame(rows, KINDS).repartition(6)
    report, fixed = R.repair(df)
    ordered = sorted((t, role, text) for _, t, role, text in rows)
    got = report.collect()
    assert [tuple(g[1:]) for g in got] == [expected(ordered)[:-1]]
    assert R.line_hashes(fixed).collect()[0][1] == expected(ordered)[-1]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # so small a table is one partition otherwise
    try:
        numbered = R._numbered(df)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    tasks = numbered.groupBy((numbered["row"] / 2**33).cast("int")).count().collect()
    assert len(tasks) > 4 and max(t["count"] for t in tasks) < 2000  # dealt out, though it is one key


def test_empty_table(spark):
    report, fixed = R.repair(spark.createDataFrame([], KINDS))
    assert report.collect() == [] == R.line_hashes(fixed).collect()
