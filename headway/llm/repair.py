"""Repair of conversation structure at the least cost, by Hirschberg's divide and conquer.

An automaton of four states says what a conversation may look like: nothing yet, after a
system turn, after a user turn, after an assistant turn.  Edits move through rows and states.
Costs from the start and costs to the end, four numbers each, meet in the middle; of the
crossings of least total the one whose edits come first in ASCII order is taken, and both
halves are solved alike.  A long conversation is cut into blocks first, whose 4 x 4 costs say
where its best edits cross the cuts, so blocks are solved apart.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.llm.common import bounded, stored, worker_state
from headway.llm.ordered import placed

# Rows of a conversation that one task solves at once.
BLOCK = 4096
# Solutions that a worker keeps, of conversations up to this length.
KEPT, SHORT = 1 << 16, 16

# What the edits cost, and what a kept truncated row adds.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5

_FAR = 1 << 60
_STATES = range(4)  # nothing yet, after system, after user, after assistant
_END = {0: 0, 1: 2, 2: 1, 3: 0}  # rows to insert until the conversation may end
_ROLES = "sua"
# A row is a letter: its role's initial (s, u, a, other) and whether it is sound, has to go,
# or is truncated.
_SOUND, _GONE, _CUT = range(3)
_EMPTY = hashlib.sha256(b"").hexdigest()

_SPACES = " \t\n\x0b\x0c\r"


def _next(state: int) -> tuple[str, int]:
    """Role and state that an inserted or rerole'd row brings."""
    return ("a", 3) if state == 2 else ("u", 2)


def _steps(initial: int, fault: int) -> list[list[tuple[int, str]]]:
    """Least (cost, edits) that take one row from state to state."""
    found = [[(_FAR, "")] * 4 for _ in _STATES]

    def reach(start: int, state: int, cost: int, edits: str) -> None:
        found[start][state] = min(found[start][state], (cost, edits))

    for start in _STATES:
        state, cost, edits = start, 0, ""
        # A third insertion in one place would lead back to where the first one led.
        for _ in range(3):
            reach(start, state, cost + DELETE, edits + "D")
            if fault != _GONE:
                more = cost + (TRUNCATED if fault == _CUT else 0)
                role, after = _next(state)
                reach(start, after, more + REROLE, edits + "R")
                if initial < 3 and _ROLES[initial] == role:
                    reach(start, after, more + KEEP, edits + "K")
                if initial == 0 and state == 0:
                    reach(start, 1, more + KEEP, edits + "K")
            _, state = _next(state)
            cost, edits = cost + INSERT, edits + "I"
    return found


STEPS = {chr(65 + 3 * i + f): _steps(i, f) for i in range(4) for f in range(3)}


class Solver:
    """Costs row by row; what it has worked out is kept for the rows to come.

    Vectors are kept less their minimum, so that few different ones occur.
    """

    def __init__(self) -> None:
        self.ahead: dict = {}
        self.behind: dict = {}
        self.short: dict = {}

    def _forward(self, row: str, costs: tuple, ranks: tuple) -> tuple[int, tuple, tuple]:
        """Costs one row further, and the order of the edits that lead to each state.

        Edits to two states of one place differ before either ends, so comparing what leads
        to the states before, and then the row's own edits, compares them whole.
        """
        known = self.ahead.get((row, costs, ranks))
        if known:
            return known
        steps = STEPS[row]
        best = [
            min((costs[s] + steps[s][t][0], ranks[s], steps[s][t][1]) for s in _STATES)
            for t in _STATES
        ]
        order = sorted(_STATES, key=lambda t: (best[t][0] >= _FAR, best[t][1:]))
        least = min(b[0] for b in best)
        above = tuple(b[0] - least if b[0] < _FAR else _FAR for b in best)
        found = least, above, tuple(order.index(t) for t in _STATES)
        self.ahead[row, costs, ranks] = found
        return found

    def _backward(self, row: str, costs: tuple) -> tuple:
        known = self.behind.get((row, costs))
        if known:
            return known
        steps = STEPS[row]
        best = [min(min(_FAR, steps[s][t][0] + costs[t]) for t in _STATES) for s in _STATES]
        least = min(best)
        found = tuple(b - least if b < _FAR else _FAR for b in best)
        self.behind[row, costs] = found
        return found

    def costs(self, rows: str, start: int) -> tuple[int, tuple, tuple]:
        """All rows from ``start``: the least cost, each state's above it, the order of states."""
        total, costs, ranks = 0, _only(start), (0, 1, 2, 3)
        for row in rows:
            more, costs, ranks = self._forward(row, costs, ranks)
            total += more
        return total, costs, ranks

    def between(self, rows: str, start: int, end: int) -> str:
        """Cheapest edits that take rows from one state to another, the ASCII-least of them."""
        done, todo = [], [(rows, start, end)]
        while todo:
            rows, start, end = todo.pop()
            if len(rows) < 2:
                done.append(STEPS[rows][start][end][1] if rows else "")
                continue
            middle = len(rows) // 2
            _, ahead, ranks = self.costs(rows[:middle], start)
            behind = _only(end)
            for row in reversed(rows[middle:]):
                behind = self._backward(row, behind)
            cross = min(_STATES, key=lambda s: (ahead[s] + behind[s], ranks[s]))
            todo += [(rows[middle:], cross, end), (rows[:middle], start, cross)]
        return "".join(done)

    def solve(
        self, rows: str, start: int = 0, end: int | None = None, last: bool = True
    ) -> tuple[str, int]:
        """Edits and cost; without ``end``, to the best state in which rows may end."""
        asked = rows, start, end, last
        known = self.short.get(asked)
        if known:
            return known
        total, costs, ranks = self.costs(rows, start)
        if end is None:
            end = min(_STATES, key=lambda s: (costs[s] + INSERT * _END[s], ranks[s]))
        tail = _END[end] if last else 0
        found = self.between(rows, start, end) + "I" * tail, total + costs[end] + INSERT * tail
        if len(rows) <= SHORT:
            if len(self.short) >= KEPT:
                self.short.clear()
            self.short[asked] = found
        return found


def _only(state: int) -> tuple:
    return tuple(0 if s == state else _FAR for s in _STATES)


# --- rows to letters ----------------------------------------------------------------


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows with planted faults: conv_id, turn, role, text.

    Nulls in role and text become one space, and count as one space in what is hashed.  A
    repeated row has the same turn.  Other columns are not read.
    """
    space = F.lit(" ")
    named = F.concat(
        F.coalesce(F.col("conv_id").cast("string"), space),
        F.lit(":"),
        F.coalesce(F.col("turn").cast("string"), space),
    )
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", space).alias("role"),
        F.coalesce("text", space).alias("text"),
        (F.crc32(named) % 20).alias("_fault"),
    )
    fault = F.col("_fault")
    text = (
        F.when(fault == 1, "").when(fault == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    )
    copies = F.sequence(F.lit(1), F.when(fault == 3, 2).otherwise(1))
    return rows.where(fault != 0).select(
        "conv_id",
        "turn",
        F.when(fault == 4, "user").otherwise(F.col("role")).alias("role"),
        text.alias("text"),
        F.explode(copies).alias("_copy"),
    ).drop("_copy")


def _keys() -> list[Column]:
    """128 bits of SHA-256 of role and text."""
    whole = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    return [
        F.conv(F.substr(whole, F.lit(1 + 16 * i), F.lit(16)), 16, -10).cast("long").alias(f"k{i + 1}")
        for i in range(2)
    ]


def _letters(turns: DataFrame) -> DataFrame:
    """Rows with their first fault: conv_id, turn, pos, blank, duplicate, truncated, letter."""
    again = stored(
        turns.groupBy("conv_id", "k1", "k2")
        .agg(F.min("pos").alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select(F.col("conv_id").alias("_conv"), F.col("k1").alias("_k1"), F.col("k2").alias("_k2"), "first"),
        "repair-again",
    )
    same = F.expr("conv_id <=> _conv AND k1 = _k1 AND k2 = _k2")
    told = turns.join(bounded(again), same, "left")
    seen = F.coalesce(F.col("pos") > F.col("first"), F.lit(False))
    blank = F.col("blank")
    faults = {
        "blank": blank,
        "duplicate": ~blank & seen,
        "truncated": ~blank & ~seen & F.col("cut"),
    }
    fault = F.when(blank | seen, _GONE).when(F.col("cut"), _CUT).otherwise(_SOUND)
    return told.select(
        "conv_id",
        "turn",
        "pos",
        *(value.cast("int").alias(name) for name, value in faults.items()),
        F.char(65 + 3 * F.col("initial") + fault).alias("letter"),
    )


# --- conversations -------------------------------------------------------------------


def repaired(rows: DataFrame) -> DataFrame:
    """The faults and the cheapest repair of every conversation that has rows.

    ``rows``: conv_id, turn, role, text, without null roles and texts (``damaged`` sees to
    that); other columns are not read.  A conversation's rows are in the order of turn (null
    first), those of one turn in that of their SHA-256 of role and text; rows without
    conv_id are one conversation.  Duplicates are told by 128 bits of that digest.  Roles
    count by their first character.  No rows give no rows.

    Columns: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256.

    What is gathered is one letter a row and block.  Texts are shuffled once; as a digest has
    to see them in order, a conversation's texts pass through one task, one at a time.
    """
    last = F.substr(F.rtrim("text", F.lit(_SPACES)), F.lit(-1), F.lit(1))
    initial = F.substr("role", F.lit(1), F.lit(1))
    place = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    narrow = rows.select(
        "conv_id",
        "turn",
        *_keys(),
        place.alias("initial"),
        (last == "").alias("blank"),
        (~last.isin(".", "!", "?")).alias("cut"),
    )
    turns = placed(narrow, "conv_id", ("turn", "k1", "k2"), "repair-turns")
    letters = stored(_letters(stored(turns, "repair-placed")), "repair-letters")
    sums = [F.sum(name).alias(name) for name in ("blank", "duplicate", "truncated")]
    counts = letters.groupBy("conv_id", "turn").agg(*sums).groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).alias("gaps"), *sums
    )
    audits = stored(_audits(letters), "repair-audits")
    whole = audits.groupBy("conv_id").agg(
        F.sum("illegal").alias("illegal"),
        F.sum("cost").alias("cost"),
        F.array_join(
            F.transform(F.array_sort(F.collect_list(F.struct("block", "audit"))), lambda b: b["audit"]), ""
        ).alias("audit"),
    )
    found = counts.alias("c").join(whole.alias("w"), F.expr("c.conv_id <=> w.conv_id")).drop(F.col("w.conv_id"))
    digests = _digests(rows, audits).select(F.col("conv_id").alias("_conv"), "repaired_sha256")
    return found.join(digests, F.expr("conv_id <=> _conv")).drop("_conv")


def _audits(letters: DataFrame) -> DataFrame:
    """Edits, cost and illegal neighbours of every block: conv_id, block, audit, cost, illegal."""
    block = F.expr(f"(pos - 1) div {BLOCK}")
    gathered = letters.groupBy("conv_id", block.alias("block")).agg(
        F.array_join(
            F.transform(F.array_sort(F.collect_list(F.struct("pos", "letter"))), lambda r: r["letter"]), ""
        ).alias("rows")
    )
    blocks = stored(gathered, "repair-blocks")
    several = blocks.where("block = 1").select(F.col("conv_id").alias("_conv"))
    same = F.expr("conv_id <=> _conv")
    cut = stored(blocks.join(several, same, "left_semi").mapInArrow(_crossings, _CROSSINGS), "repair-crossings")
    states = "conv_id long, block long, start int, end int, last boolean, before string"
    chained = cut.repartition("conv_id").sortWithinPartitions("conv_id", "block").mapInArrow(_chained, states)
    chained = stored(chained, "repair-states").select(
        F.col("conv_id").alias("_conv"), F.col("block").alias("_block"), "start", "end", "last", "before"
    )
    planned = blocks.join(bounded(chained), F.expr("conv_id <=> _conv AND block = _block"), "left")
    return planned.select("conv_id", "block", "rows", "start", "end", "last", "before").mapInArrow(
        _solutions, "conv_id long, block long, audit string, cost long, illegal long"
    )


_CROSSINGS = "conv_id long, block long, least array<long>, above array<long>, ranks array<long>, edge string"


def _crossings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each state a block may start in: costs and order of the states it may end in."""
    solver = worker_state("repair", Solver)
    for batch in batches:
        least, above, ranks, edges = [], [], [], []
        for rows in batch.column("rows").to_pylist():
            found = [solver.costs(rows, start) for start in _STATES]
            least.append([f[0] for f in found])
            above.append([c for f in found for c in f[1]])
            ranks.append([r for f in found for r in f[2]])
            edges.append(rows[-1])
        kind = pa.list_(pa.int64())
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("conv_id"),
                batch.column("block"),
                *(pa.array(column, kind) for column in (least, above, ranks)),
                pa.array(edges, pa.string()),
            ],
            names=["conv_id", "block", "least", "above", "ranks", "edge"],
        )


def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """States in which the best edits of long conversations enter and leave each block."""
    names = ["conv_id", "block", "start", "end", "last", "before"]
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.string()]

    def walked(conv_id: int | None, blocks: list[tuple]) -> pa.RecordBatch:
        costs, ranks, came = [0, _FAR, _FAR, _FAR], [0, 1, 2, 3], []
        for least, above, order, _ in blocks:
            best = []
            for t in _STATES:
                best.append(
                    min(
                        (min(_FAR, costs[s] + least[s] + above[4 * s + t]), ranks[s], order[4 * s + t], s)
                        for s in _STATES
                    )
                )
            costs = [b[0] for b in best]
            order_now = sorted(_STATES, key=lambda t: (best[t][0] >= _FAR, best[t][1:3]))
            ranks = [order_now.index(t) for t in _STATES]
            came.append([b[3] for b in best])
        state = min(_STATES, key=lambda s: (costs[s] + INSERT * _END[s], ranks[s]))
        rows = []
        for number in reversed(range(len(blocks))):
            start = came[number][state]
            before = blocks[number - 1][3] if number else None
            rows.append((conv_id, number, start, state, number == len(blocks) - 1, before))
            state = start
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    own, blocks = None, []
    for batch in batches:
        for conv_id, _, *block in zip(*(column.to_pylist() for column in batch.columns)):
            if blocks and conv_id != own:
                yield walked(own, blocks)
                blocks = []
            own = conv_id
            blocks.append(block)
    if blocks:
        yield walked(own, blocks)


def _illegal(rows: str) -> int:
    """Neighbours whose roles' initials are not su, ua or au."""
    at = (np.frombuffer(rows.encode(), np.uint8) - 65) // 3
    one, two = at[:-1], at[1:]
    legal = ((two == 1) & ((one == 0) | (one == 2))) | ((one == 1) & (two == 2))
    return int(len(one) - legal.sum())


def _solutions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    solver = worker_state("repair", Solver)
    for batch in batches:
        audits, costs, illegal = [], [], []
        columns = (batch.column(name).to_pylist() for name in ("rows", "start", "end", "last", "before"))
        for rows, start, end, last, before in zip(*columns):
            audit, cost = solver.solve(rows, start or 0, end, last is not False)
            audits.append(audit)
            costs.append(cost)
            illegal.append(_illegal((before or "") + rows))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("conv_id"),
                batch.column("block"),
                pa.array(audits, pa.string()),
                pa.array(costs, pa.int64()),
                pa.array(illegal, pa.int64()),
            ],
            names=["conv_id", "block", "audit", "cost", "illegal"],
        )


# --- texts ----------------------------------------------------------------------------


def _digests(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """SHA-256 of every repaired conversation; its edits come first, then its texts in order."""
    texts = rows.select("conv_id", F.lit(1).alias("tag"), F.lit(None).cast("long").alias("block"), "turn", *_keys(), "role", "text")
    edits = audits.select("conv_id", F.lit(0).alias("tag"), "block", F.col("audit").alias("text"))
    order = ("conv_id", "tag", "block", "turn", "k1", "k2")
    both = edits.unionByName(texts, allowMissingColumns=True).select(*order, "role", "text")
    together = both.repartition("conv_id").sortWithinPartitions(*order).select("conv_id", "tag", "role", "text")
    return together.mapInArrow(_digested, "conv_id long, repaired_sha256 string")


class _Repair:
    """A conversation that is written edit by edit into a digest."""

    def __init__(self) -> None:
        self.audit, self.at, self.state, self.first = bytearray(), 0, 0, True
        self.digest = hashlib.sha256()

    def add(self, role: str, text: str) -> None:
        self.digest.update((("" if self.first else "\n") + role + ":" + text).encode("utf-8", "surrogatepass"))
        self.first = False

    def inserted(self) -> None:
        while self.at < len(self.audit) and self.audit[self.at] == ord("I"):
            self.at += 1
            self.add(*self.made(), "")

    def made(self) -> tuple[str]:
        role, self.state = _next(self.state)
        return ("assistant" if role == "a" else "user",)

    def row(self, role: str, text: str) -> None:
        self.inserted()
        edit = chr(self.audit[self.at])
        self.at += 1
        if edit == "R":
            self.add(*self.made(), text)
        elif edit == "K":
            self.state = 1 + _ROLES.index(role[0])
            self.add(role, text)


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    own, repair = None, None
    for batch in batches:
        done = []
        kept = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
        roles, texts = batch.column(2), batch.column(3)
        for at, (conv_id, tag) in enumerate(kept):
            if repair is None or conv_id != own:
                if repair is not None:
                    repair.inserted()
                    done.append((own, repair.digest.hexdigest()))
                own, repair = conv_id, _Repair()
            if tag == 0:
                repair.audit += texts[at].as_py().encode()
            else:
                repair.row(roles[at].as_py(), texts[at].as_py())
        yield _digest_batch(done)
    if repair is not None:
        repair.inserted()
        yield _digest_batch([(own, repair.digest.hexdigest())])


def _digest_batch(rows: list[tuple]) -> pa.RecordBatch:
    ids, digests = zip(*rows) if rows else ((), ())
    return pa.RecordBatch.from_arrays(
        [pa.array(ids, pa.int64()), pa.array(digests, pa.string())], ["conv_id", "repaired_sha256"]
    )


def damage_and_repair(conversations: DataFrame) -> DataFrame:
    """Every original conversation after planted damage and repair; see :func:`repaired`.

    A conversation that the damage left without rows has zeros, no edits and the digest of
    the empty string.  An empty table gives no rows.
    """
    ids = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    found = repaired(damaged(conversations)).withColumnRenamed("conv_id", "_conv")
    joined = ids.join(found, F.expr("conv_id <=> _conv"), "left")
    numbers = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return joined.select(
        "conv_id",
        *(F.coalesce(name, F.lit(0)).cast("long").alias(name) for name in numbers),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(_EMPTY)).alias("repaired_sha256"),
    )
