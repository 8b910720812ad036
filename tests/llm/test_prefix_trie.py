from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from headway.llm import ordered, prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, depth long, k1 string, block long"


def brute(given: list[tuple], base, head) -> list[tuple]:
    own = defaultdict(list)
    for conv_id, turn, role, text in given:
        if conv_id is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()
            order = (turn is not None, turn or 0, *(_signed(digest[i : i + 16]) for i in (0, 16)))
            own[conv_id].append((order, role, text))
    own = {c: [(r, t) for _, r, t in sorted(turns)] for c, turns in own.items()}
    members = defaultdict(list)
    whole = {}
    for c in own:
        whole[c] = tuple(own.get(base(c), [])[: head(c)] + own[c][head(c) :])
        for d in range(len(whole[c]) + 1):
            members[whole[c][:d]].append(c)
    children = defaultdict(list)
    for prefix in members:
        if prefix:
            children[prefix[:-1]].append(prefix)

    found = []
    sums = {}
    for prefix in sorted(members, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", prefix[-1][1])) if prefix else 0
        leaves = sum(sums[k][0] for k in children[prefix]) or 1
        saved = (len(members[prefix]) - 1) * words + sum(sums[k][1] for k in children[prefix])
        sums[prefix] = leaves, saved
        ends = ",".join(map(str, sorted(c for c in members[prefix] if whole[c] == prefix)))
        found.append(
            (
                min(members[prefix]),
                len(prefix),
                min(members[prefix[:-1]]) if prefix else None,
                len(members[prefix]),
                len(children[prefix]),
                leaves,
                saved,
                hashlib.sha256(ends.encode()).hexdigest(),
            )
        )
    return sorted(found, key=str)


def _signed(digits: str) -> int:
    value = int(digits, 16)
    return value - (1 << 64) if value >> 63 else value


def dealt_base(c: int) -> int:
    return c - c % 20


def dealt_head(c: int) -> int:
    return zlib.crc32(str(c).encode()) % 4


def conversations(seed: int, count: int = 90) -> list[tuple]:
    rng = random.Random(seed)
    said = [("user", "hi there"), ("assistant", "yes\tno  x"), ("user", None), (None, "hi there"), ("", "a\x0bb c")]
    found = []
    for c in rng.sample(range(-45, 200), count):
        for turn in range(rng.choice([1, 1, 2, 3, 4, 6])):
            found.append((c, rng.choice([turn, turn, None]), *rng.choice(said)))
    found += [found[0], found[0], (None, 0, "user", "nobody")]
    long_one = [(300, t, *said[t % 2]) for t in range(120)]
    return found + long_one + [(301, *row[1:]) for row in long_one] + [(320, t, *said[t % 2]) for t in range(70)]


def frame(spark, given):
    return spark.createDataFrame([(*row, 1, "x", 2) for row in given], SCHEMA).repartition(5)


def shape(found) -> list[tuple]:
    names = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()
    return sorted((tuple(r[n] for n in names) for r in found.collect()), key=str)


@pytest.mark.parametrize("block", [4, 4096])
def test_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(prefix_trie, "BLOCK", block)
    monkeypatch.setattr(prefix_trie, "CHUNK", 16 if block == 4 else 1 << 16)
    given = conversations(block)
    assert shape(prefix_trie.prefix_trie(frame(spark, given))) == brute(given, dealt_base, dealt_head)


def test_other_bases_and_longer_heads(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "BLOCK", 8)
    given = conversations(7)
    found = prefix_trie.prefix_trie(
        frame(spark, given),
        base=lambda c: F.when(c % 3 == 0, F.lit(300)).otherwise(c + 1),
        head=lambda c: F.pmod(c * 7, F.lit(40)),
    )
    python = lambda c: 300 if c % 3 == 0 else c + 1
    assert shape(found) == brute(given, python, lambda c: c * 7 % 40)


def test_colliding_keys_and_products_are_told_apart(spark, monkeypatch):
    given = conversations(11, 40)
    expected = brute(given, dealt_base, dealt_head)

    def weak(role, text):
        return F.concat(F.substr(F.sha2(F.concat(role, text), 256), F.lit(1), F.lit(1)), F.lit("0" * 63))

    # Few keys, so several texts share each; ties of one turn would then be ordered otherwise.
    distinct = {(c, t): (c, t, r, x) for c, t, r, x in given if t is not None}
    expected = brute(list(distinct.values()), dealt_base, dealt_head)
    found = prefix_trie.prefix_trie(frame(spark, list(distinct.values())), key_of=weak)
    assert shape(found) == expected
    monkeypatch.setattr(prefix_trie, "PRIMES", (5, 7, (1 << 127) - 1))
    assert shape(prefix_trie.prefix_trie(frame(spark, list(distinct.values())))) == expected
    monkeypatch.setattr(prefix_trie, "PRIMES", (5,))
    with pytest.raises(ArithmeticError):
        prefix_trie.prefix_trie(frame(spark, given))


def test_no_conversations(spark):
    assert prefix_trie.prefix_trie(spark.createDataFrame([], SCHEMA)).count() == 0
    alone = spark.createDataFrame([(9, None, None, None)], "conv_id long, turn long, role string, text string")
    assert shape(prefix_trie.prefix_trie(alone)) == brute([(9, None, None, None)], dealt_base, dealt_head)


def test_places_in_groups_that_span_ranges(spark):
    rng = random.Random(2)
    given = [(rng.choice([None, 1, 2, 2, 2, 2, 3, 90]), i, "x") for i in range(800)]
    rows = spark.createDataFrame(given, "g long, at long, more string").repartition(7)
    found = ordered.placed(rows, "g", ("at",), "places").collect()
    expected = defaultdict(int)
    for g, i, _ in given:
        expected[g] += 1
        assert (g, i, "x", expected[g]) in {tuple(r) for r in found if r["at"] == i}
    assert len(found) == len(given)
