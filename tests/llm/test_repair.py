from __future__ import annotations

import hashlib
import heapq
import itertools
import random
import re
import zlib
from collections import defaultdict

import pytest

from headway.llm import repair
from tests.llm.test_prefix_trie import _signed

SCHEMA = "conv_id long, turn long, role string, text string, letter string, block long, tag long"
WORD = r"[^\x20\x09-\x0D]"


def key(role: str, text: str) -> tuple:
    digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()
    return tuple(_signed(digest[i : i + 16]) for i in (0, 16))


def damaged(given: list[tuple]) -> dict:
    found = defaultdict(list)
    for conv_id, turn, role, text in given:
        own = found[conv_id]
        role, text = " " if role is None else role, " " if text is None else text
        name = f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}"
        fault = zlib.crc32(name.encode()) % 20
        if fault == 0:
            continue
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        own += [(turn, "user" if fault == 4 else role, text)] * (2 if fault == 3 else 1)
    order = lambda r: (r[0] is not None, r[0] or 0, *key(*r[1:]))
    return {c: sorted(rows, key=order) for c, rows in found.items()}


def cheapest(rows: list[tuple], faults: list[str]) -> tuple[int, str, list]:
    """Uniform-cost search over (cost, edits), so the first end found is the answer."""
    queue = [(0, "", 0, "", ())]
    seen = set()
    while queue:
        cost, audit, at, initials, out = heapq.heappop(queue)
        state = initials[-1:] if initials else ""
        if at == len(rows) and re.fullmatch("(s?(ua)+)?", initials):
            return cost, audit, list(out)
        if (at, state) in seen:
            continue
        seen.add((at, state))
        need = "assistant" if state == "u" else "user"

        def push(more, letter, step, role, text):
            added = (role, text)
            heapq.heappush(queue, (cost + more, audit + letter, at + step, initials + role[:1], (*out, added)))

        push(5, "I", 0, need, "")
        if at < len(rows):
            heapq.heappush(queue, (cost + 2, audit + "D", at + 1, initials, out))
            if faults[at] not in ("blank", "duplicate"):
                more = 5 if faults[at] == "truncated" else 0
                role, text = rows[at][1:]
                push(more + 1, "R", 1, need, text)
                if role[:1] == need[0] or (role[:1] == "s" and not initials):
                    push(more, "K", 1, role, text)
    raise AssertionError


def fault_names(rows: list[tuple]) -> list[str]:
    seen, found = set(), []
    for _, role, text in rows:
        words = re.findall(WORD, text)
        if not words:
            found.append("blank")
        elif (role, text) in seen:
            found.append("duplicate")
        else:
            found.append("" if words[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return found


def brute(given: list[tuple]) -> dict:
    found = {}
    for conv_id, rows in damaged(given).items():
        faults = fault_names(rows)
        turns = [t for t, *_ in rows if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        initials = [r[:1] for _, r, _ in rows]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, audit, out = cheapest(rows, faults)
        sha = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest()
        counts = [faults.count(name) for name in ("blank", "duplicate", "truncated")]
        found[conv_id] = (gaps, *counts, illegal, cost, audit, sha)
    return found


def shape(frame) -> dict:
    names = "gaps blank duplicate truncated illegal cost audit repaired_sha256".split()
    rows = frame.collect()
    found = {r["conv_id"]: tuple(r[n] for n in names) for r in rows}
    assert len(found) == len(rows)
    return found


def conversations(seed: int, count: int = 250) -> list[tuple]:
    rng = random.Random(seed)
    texts = ["Fine.", "Fine.", "Who? \n", "cut off", "", " \t", None, "Ja!", "é 😀.", "x. y", "line\none."]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", None, "", "sys", "User"]
    found = []
    for c in [None, -3, *range(count)]:
        for turn in range(rng.choice([1, 1, 2, 4, 6, 9])):
            role = roles[turn % 2] if rng.random() < 0.6 else rng.choice(roles)
            found.append((c, rng.choice([turn, turn, turn, None, turn * 2]), role, f"{turn} {c} ok." if rng.random() < 0.5 else rng.choice(texts)))
    found += [(900, t, ("user", "assistant")[t % 2], rng.choice([f"{t}.", f"{t}", "again."])) for t in range(150)]
    return found + found[:3]


@pytest.mark.parametrize("block", [3, 16, 4096])
def test_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(repair, "BLOCK", block)
    given = conversations(block)
    frame = spark.createDataFrame([(*row, "l", 1, 2) for row in given], SCHEMA).repartition(5)
    assert shape(repair.damage_and_repair(frame)) == brute(given)


def test_every_short_sequence_of_rows():
    """Divide and conquer against a search, also where many repairs cost the same."""
    letters = {"s": ("system", 0), "u": ("user", 1), "a": ("assistant", 2), "x": ("tool", 3)}
    kinds = [(r, f) for r in "suax" for f in ("", "blank", "truncated")]
    rng, solver = random.Random(4), repair.Solver()
    cases = [c for n in range(4) for c in itertools.product(kinds, repeat=n)]
    cases += [tuple(rng.choices(kinds, k=rng.randrange(4, 30))) for _ in range(1500)]
    for case in cases:
        rows = [(0, letters[r][0], "t") for r, _ in case]
        cost, audit, _ = cheapest(rows, [f for _, f in case])
        code = "".join(
            chr(65 + 3 * letters[r][1] + ("", "blank", "truncated").index(f)) for r, f in case
        )
        assert solver.solve(code) == (audit, cost), case


def test_nothing_left(spark):
    names = "conv_id long, turn long, role string, text string"
    assert repair.damage_and_repair(spark.createDataFrame([], names)).count() == 0
    dropped = next(c for c in range(200) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    found = shape(repair.damage_and_repair(spark.createDataFrame([(dropped, 0, "user", "Hi.")], names)))
    assert found == {dropped: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
