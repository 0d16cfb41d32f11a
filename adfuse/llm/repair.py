"""Conversation structure repair: cheapest edits by Four-Russians block tables.

The repaired roles of a conversation read ``(s?(ua)+)?`` by their initials.
Edits are Keep (0), Rerole to user or assistant (3), Delete (4, required for
blank and duplicate rows) and Insert an empty user or assistant row (3);
an undeleted truncated row costs 3 more.  ``audit`` holds the initials of the
cheapest edits in order; of equally cheap ones the ASCII-least.

A row is one of nine symbols (initial x truncated, or to be deleted).  The cost
of repairing the rest of a conversation is a vector over the four states of the
pattern.  Its entries differ by a bounded amount, so there are only a few
vectors after the least entry is taken off.  For every such vector and every
block of ``BLOCK`` symbols a table holds the vector in front of the block and
what it adds.  A conversation is read from its end block by block, one lookup
each; then it is traced from its start, where each block is expanded backward
into its inner vectors.  With the exact cost of the rest at hand, the least
letter that stays cheapest is the right one, so ties need no search.

Rows are dealt out by range with a row number as last key, so the rows of one
huge conversation go to many tasks.  What is gathered for one conversation is
one symbol a row, which is no more than its audit.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adfuse.llm.tables import frozen, pick, table

#: Symbols of a block.
BLOCK = 4
#: Rows whose symbols are gathered in one group.
CHUNK_BITS = 12
#: Characters of a text that order rows of one turn and role; then its hash.
PREFIX = 64

# Costs.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3

ROWS = (("conv_id", "bigint"), ("turn", "bigint"), ("role", "string"), ("text", "string"))
SPACE = " \t\n\x0b\x0c\r"

# States: nothing yet, after s, after u, after a.  Where a user or assistant row leads (one of them fits each state):
NEXT = (2, 2, 3, 2)
KEEP = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}, "o": {}}
#: The cost of ending in each state.
LAST = (0, 2 * INSERT, INSERT, 0)
#: Symbols: (initial, truncated), and None for a row that has to go.
SYMBOLS = (None, *((i, t) for t in (False, True) for i in "suao"))


def _moves(symbol, q: int) -> Iterator[tuple[str, int, int]]:
    """Edits of a row in a state, in the order of their letters: letter, cost, next state."""
    yield "D", DELETE, q
    if symbol:
        initial, truncated = symbol
        more = TRUNCATED * truncated
        if q in KEEP[initial]:
            yield "K", more, KEEP[initial][q]
        yield "R", REROLE + more, NEXT[q]


def _before(symbol, rest: tuple[int, ...]) -> tuple[int, ...]:
    """Cost vector in front of a row, given the one behind it."""
    cost = [min(c + rest[to] for _, c, to in _moves(symbol, q)) for q in range(4)]
    for _ in range(2):  # two inserted rows reach every state
        cost = [min(c, INSERT + cost[NEXT[q]]) for q, c in enumerate(cost)]
    return tuple(cost)


def _letters(symbol, rest: tuple[int, ...], q: int) -> tuple[str, int]:
    """The least letters of cheapest edits up to and with a row, and the state behind it."""
    cost, out = _before(symbol, rest), ""
    while True:
        for letter, c, to in _moves(symbol, q):
            if letter > "I" and INSERT + cost[NEXT[q]] == cost[q]:
                break
            if c + rest[to] == cost[q]:
                return out + letter, to
        out, q = out + "I", NEXT[q]


class Tables:
    """The normalised vectors, their steps by symbol and by block."""

    def __init__(self, block: int = BLOCK) -> None:
        self.block, self.vectors, steps = block, [LAST], []
        ids = {LAST: 0}
        for v in self.vectors:  # grows while it is read
            row = []
            for symbol in SYMBOLS:
                cost = _before(symbol, v)
                least = min(cost)
                new = tuple(c - least for c in cost)
                if new not in ids:
                    ids[new] = len(self.vectors)
                    self.vectors.append(new)
                row.append((ids[new], least))
            steps.append(row)
        self.step = np.array(steps, np.int64)  # vector, symbol -> vector before, cost taken off
        n, size = len(self.vectors), len(SYMBOLS)
        self.to, self.add = np.arange(n)[:, None], np.zeros((n, 1), np.int64)
        for _ in range(block):  # one more symbol in front of the block: the most significant digit
            front = self.step[self.to]  # vector, block so far, symbol, 2
            self.to = front[..., 0].transpose(0, 2, 1).reshape(n, -1)
            self.add = (front[..., 1] + self.add[..., None]).transpose(0, 2, 1).reshape(n, -1)
        self.digits = size ** np.arange(block - 1, -1, -1)
        self.trace = functools.lru_cache(maxsize=1 << 17)(self._trace)

    def _trace(self, rest: int, symbols: tuple[int, ...], q: int) -> tuple[str, int]:
        """Letters of a block from state ``q``, given the vector behind it."""
        inner = [rest]
        for s in symbols[:0:-1]:
            inner.append(int(self.step[inner[-1], s, 0]))
        out = ""
        for s, v in zip(symbols, reversed(inner), strict=True):
            letters, q = _letters(SYMBOLS[s], self.vectors[v], q)
            out += letters
        return out, q

    def cheapest(self, symbols: np.ndarray) -> tuple[int, str]:
        """Cost and audit of a conversation, given its symbols' numbers."""
        whole = len(symbols) // self.block * self.block
        rows = symbols[:whole].reshape(-1, self.block)
        codes, v, cost = rows @ self.digits, 0, 0
        tail = tuple(symbols[whole:].tolist())
        for s in reversed(tail):
            v, c = self.step[v, s]
            cost += c
        behind = np.empty(len(codes), np.int64)
        for k in range(len(codes) - 1, -1, -1):
            behind[k] = v
            cost += self.add[v, codes[k]]
            v = self.to[v, codes[k]]
        cost += self.vectors[v][0]
        out, q = [], 0
        for block, rest in zip(rows.tolist(), behind.tolist(), strict=True):
            letters, q = self.trace(rest, tuple(block), q)
            out.append(letters)
        if tail:
            letters, q = self._trace(0, tail, q)
            out.append(letters)
        out.append("I" * (LAST[q] // INSERT))
        return int(cost), "".join(out)


@functools.cache
def tables() -> Tables:
    return Tables()


#: A row's character: its initial (s, u, a, other) and first fault (none, blank, duplicate, truncated).
MARKS = "ABCDEFGHIJKLMNOP"
_SYMBOL = np.array([SYMBOLS.index(("suao"[m // 4], m % 4 == 3)) if m % 4 in (0, 3) else 0 for m in range(len(MARKS))])


def inspect(marks: str) -> dict:
    """Counts, cost and audit of the rows of one conversation, one mark a row."""
    m = np.frombuffer(marks.encode(), np.uint8).astype(np.int64) - ord(MARKS[0])
    initial, fault = m // 4, m % 4
    pair = initial[:-1] * 4 + initial[1:]
    cost, audit = tables().cheapest(_SYMBOL[m])
    return {
        **{name: int((fault == k).sum()) for k, name in ((1, "blank"), (2, "duplicate"), (3, "truncated"))},
        "illegal": int((~np.isin(pair, (1, 6, 9))).sum()),  # su, ua, au
        "cost": cost,
        "audit": audit,
    }


def _numbered(rows: DataFrame) -> DataFrame:
    """Rows in order, with a number that grows in it; written to the shared folder.

    Only the number's order matters, not its gaps.  Equal rows are told apart
    by where they were read, so that even they go to several tasks.
    """
    keys = ("conv_id", "turn", "role", "_prefix", "_hash", "_tie")
    return frozen(
        rows.withColumns(
            {
                "_prefix": F.left("text", F.lit(PREFIX)),
                "_hash": F.xxhash64("text"),
                "_tie": F.monotonically_increasing_id(),
            }
        )
        .repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .select(*[name for name, _ in ROWS], F.monotonically_increasing_id().alias("row")),
        "turns",
    )


def _marks(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, row, mark) of numbered rows."""
    known = rows.groupBy("conv_id", "role", F.md5("text")).agg(F.min("row").alias("row"))
    known = known.select("row", F.lit(True).alias("first"))
    ends, initial = F.rtrim("text", F.lit(SPACE)), F.left("role", F.lit(1))
    narrow = rows.select(
        "conv_id",
        "turn",
        "row",
        F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3).alias("initial"),
        (ends == "").alias("blank"),
        (~F.right(ends, F.lit(1)).isin(".", "!", "?")).alias("cut"),
    )
    fault = F.when(F.col("blank"), 1).when(F.col("first").isNull(), 2).when(F.col("cut"), 3).otherwise(0)
    return narrow.join(known, "row", "left").select(
        "conv_id", "turn", "row", F.substr(F.lit(MARKS), F.col("initial") * 4 + fault + 1, F.lit(1)).alias("mark")
    )


PLAN = (
    "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, "
    "audit string, starts array<bigint>, sizes array<bigint>"
)


def _plan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [f.split()[0] for f in PLAN.split(", ")]
    for batch in batches:
        out = []
        for conv, chunks in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            chunks = [c for c in chunks if c["marks"]]
            timed = [c for c in chunks if c["n_turns"]]
            turns = sum(c["n_turns"] for c in timed)
            turns -= sum(a["high"] == b["low"] for a, b in zip(timed[:-1], timed[1:], strict=True))
            gaps = timed[-1]["high"] - timed[0]["low"] + 1 - turns if timed else 0
            found = inspect("".join(c["marks"] for c in chunks))
            places = {"starts": [c["chunk"] for c in chunks], "sizes": [len(c["marks"]) for c in chunks]}
            out.append({"conv_id": conv, "gaps": gaps, **found, **places})
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=_PLAN_SCHEMA).select(names)


_PLAN_SCHEMA = pa.schema(
    [("conv_id", pa.int64()), *((n, pa.int64()) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost"))]
    + [("audit", pa.string()), ("starts", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64()))]
)


def _plans(rows: DataFrame, ids: DataFrame) -> DataFrame:
    marks = _marks(rows)
    chunks = (
        marks.groupBy("conv_id", F.shiftright("row", CHUNK_BITS).alias("part"))  # bounded groups
        .agg(
            F.min("row").alias("chunk"),
            F.array_join(
                F.transform(F.sort_array(F.collect_list(F.struct("row", "mark"))), lambda r: r["mark"]), ""
            ).alias("marks"),
            F.min("turn").alias("low"),
            F.max("turn").alias("high"),
            F.size(F.collect_set("turn")).cast("bigint").alias("n_turns"),
        )
        .drop("part")
    )
    none = ids.select(
        "conv_id",
        F.lit(-1).cast("bigint").alias("chunk"),
        F.lit("").alias("marks"),
        F.lit(None).cast("bigint").alias("low"),
        F.lit(None).cast("bigint").alias("high"),
        F.lit(0).cast("bigint").alias("n_turns"),
    ).distinct()
    whole = chunks.union(none).groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("chunk", "marks", "low", "high", "n_turns"))).alias("chunks")
    )
    return frozen(whole.mapInArrow(_plan, PLAN), "repairs")


_EDIT_SLICE = 1 << 16
EDITS = "conv_id bigint, place bigint, edit string, new_role string, row bigint"


def _edits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows that stay or are inserted: their place, edit and role, and the row they come from."""
    for batch in batches:
        for conv, audit, starts, sizes in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
            letters = np.frombuffer(audit.encode(), np.uint8)
            number = [a + np.arange(n) for a, n in zip(starts, sizes, strict=True)]
            source = np.full(len(letters), -1, np.int64)
            source[letters != ord("I")] = np.concatenate(number or [np.empty(0, np.int64)])
            stays = letters != ord("D")
            letters, source = letters[stays], source[stays]
            place = np.arange(len(letters))
            user = (place + len(letters)) % 2 == 0  # an odd number of rows begins with s
            for lo in range(0, len(letters), _EDIT_SLICE):
                part = slice(lo, lo + _EDIT_SLICE)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([conv] * len(place[part]), pa.int64()),
                        pa.array(place[part]),
                        pa.array([chr(c) for c in letters[part]]),
                        pa.array(np.where(user[part], "user", "assistant").tolist(), pa.string()),
                        pa.array(source[part], mask=source[part] < 0),
                    ],
                    [f.split()[0] for f in EDITS.split(", ")],
                )


def repair(conversations: DataFrame, ids: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Repair the conversations of (conv_id, turn, role, text).

    Returns the report and the repaired rows.  The report has one row for each
    conv_id of ``ids`` or of the rows: gaps in the turn numbers, rows whose
    first fault is blank, duplicate or truncated, illegal neighbours, cost and
    audit; zeros and an empty audit without rows.  The repaired rows have
    conv_id, place (0, 1, ...), edit (K, R or I), role and text.

    Rows are taken by turn (null first), then role and text (its first
    ``PREFIX`` characters, then a hash).  A null role or text is one space; an
    unknown or empty role has no legal initial; rows without conv_id are one
    conversation; repeated rows are duplicates; empty tables give no rows.
    """
    rows = pick(conversations, *ROWS)
    ids = rows.select("conv_id") if ids is None else pick(ids, ("conv_id", "bigint"))
    rows = _numbered(rows.fillna(" ", ["role", "text"]))
    plans = _plans(rows, ids.union(rows.select("conv_id")).distinct())
    edits = plans.select("conv_id", "audit", "starts", "sizes").mapInArrow(_edits, EDITS)
    old = edits.where("row IS NOT NULL").join(rows.select("row", "role", "text"), "row")
    new = edits.where("row IS NULL")
    repaired = old.select(
        *("conv_id", "place", "edit"),
        F.when(F.col("edit") == "K", F.col("role")).otherwise(F.col("new_role")).alias("role"),
        "text",
    ).union(new.select("conv_id", "place", "edit", F.col("new_role").alias("role"), F.lit("").alias("text")))
    return plans.drop("starts", "sizes"), repaired


def _pairs(rows: list[tuple]) -> pa.RecordBatch:
    ids, hashes = pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.string())
    return pa.RecordBatch.from_arrays([ids, hashes], ["conv_id", "repaired_sha256"])


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each conversation's lines, which come in order; texts of one batch at a time are held."""
    state, started = None, None
    for batch in batches:
        done: list[tuple] = []
        for conv, role, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if started != (conv,):
                if started:
                    done.append((*started, state.hexdigest()))
                started, state = (conv,), hashlib.sha256()
            else:
                state.update(b"\n")
            state.update(f"{role}:{text}".encode())
        yield _pairs(done)
    if started:
        yield _pairs([(*started, state.hexdigest())])


def line_hashes(repaired: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256) of the repaired rows, as lines ``role:text`` in order.

    A hash over a whole conversation has to read it in order, so one
    conversation is one task's work here; it is streamed, not held.
    """
    return (
        repaired.repartition("conv_id")
        .sortWithinPartitions("conv_id", "place")
        .select("conv_id", "role", "text")
        .mapInArrow(_hashed, "conv_id bigint, repaired_sha256 string")
    )


def damage(conversations: DataFrame) -> DataFrame:
    """Conversations with the faults that crc32(``conv_id:turn``) modulo 20 names (null is one space there).

    0 drops the row, 1 empties its text, 2 removes its stops, 3 repeats it, 4 makes its role user.
    """
    rows = pick(conversations, *ROWS)
    conv, turn = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn"))
    key = F.concat(conv, F.lit(":"), turn)
    rows = rows.fillna(" ", ["role", "text"]).withColumn("_fault", F.crc32(key) % 20).where("_fault != 0")
    once, twice = F.array(F.lit(0)), F.array(F.lit(0), F.lit(1))
    fault = F.col("_fault")
    text = F.when(fault == 1, "").when(fault == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    return rows.select(
        "conv_id",
        "turn",
        F.when(fault == 4, "user").otherwise(F.col("role")).alias("role"),
        text.alias("text"),
        F.explode(F.when(fault == 3, twice).otherwise(once)).alias("_copy"),
    ).drop("_copy")


def op11_repair(spark, sf_dir) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    report, repaired = repair(damage(conversations), conversations.select("conv_id"))
    hashes = line_hashes(repaired).withColumnRenamed("conv_id", "_id")
    return report.join(hashes, F.col("conv_id").eqNullSafe(F.col("_id")), "left").select(
        *report.columns, F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256")
    )
