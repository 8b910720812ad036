from __future__ import annotations

import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa

from headway.llm import components, exact_dedup, near_dedup
from tests.llm.helpers import by_id, documents, nothing, rows


def normalised(text: str | None) -> str:
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def shingles(text: str | None) -> frozenset:
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def brute_components(texts: dict) -> dict:
    sets = {i: shingles(text) for i, text in texts.items()}
    found = {i: i for i in texts}

    def top(i):
        while found[i] != i:
            i = found[i]
        return i

    ids = sorted(texts)
    for k, i in enumerate(ids):
        for j in ids[k + 1 :]:
            common = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * common >= 75 * len(sets[i] | sets[j]):
                a, b = sorted((top(i), top(j)))
                found[b] = a
    return {i: (len(sets[i]), top(i)) for i in texts}


def test_exact_duplicates_against_brute_force(spark):
    groups = defaultdict(list)
    for row in rows():
        groups[normalised(row[1])].append(row[0])
    expected = []
    for text, ids in groups.items():
        sha = hashlib.sha256(text.encode()).hexdigest()
        keep = min((i for i in ids if i is not None), default=None)
        expected += [(i, keep, len(ids), i == keep, sha) for i in ids]
    expected.sort(key=lambda v: (v[0] is None, v[0] or 0, str(v)))
    found = exact_dedup.exact_duplicates(documents(spark))
    assert by_id(found, "doc_id", "keep_id", "group_size", "kept", "text_sha256") == expected


def test_equal_fingerprints_of_different_texts_stay_apart(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup.F, "xxhash64", lambda *_: exact_dedup.F.lit(7).cast("long"))
    found = exact_dedup.exact_duplicates(spark.createDataFrame([(1, "a"), (2, "b"), (3, "a")], "doc_id long, text string"))
    assert by_id(found, "doc_id", "keep_id", "group_size") == [(1, 1, 2), (2, 2, 1), (3, 1, 2)]


def test_quotient_filters_count_like_a_hash_table(spark):
    values = [int(v) for v in np.random.default_rng(1).integers(-(2**63), 2**63 - 1, 300)]
    values += values[:50] * 3 + [0, 0, -1, -1, -1]
    frame = spark.createDataFrame([(v,) for v in values], "fp long").repartition(5)
    for bits in (8, 13):
        found = exact_dedup.repeated_fingerprints(frame, bits).collect()
        assert {tuple(r) for r in found} == {(v, values.count(v)) for v in values if values.count(v) > 1}


def test_a_filter_is_smaller_than_its_fingerprints(spark):
    rng = np.random.default_rng(3)
    values = rng.integers(-(2**63), 2**63, 200_000)
    values[:1000] = values[1000:2000]
    frame = spark.createDataFrame([(int(v),) for v in values], "fp long").repartition(3)
    for bits, bytes_each in ((8, 7), (16, 6), (24, 5)):
        assert exact_dedup.remainder_bytes(bits) == bytes_each
        runs = frame.mapInArrow(exact_dedup._partition_filters(bits), exact_dedup._RUNS)
        size = runs.selectExpr("sum(length(remainders) + length(counts)) s").first()["s"]
        assert size < 1.05 * bytes_each * len(values)


def test_near_duplicates_against_brute_force(spark):
    rng = random.Random(2)
    words = [f"w{i}" for i in range(400)]
    texts, n = {}, 0
    for family in range(6):
        base = [rng.choice(words) for _ in range(rng.choice([8, 40, 120, 300]))]
        for _ in range(40):
            copy = list(base)
            for _ in range(rng.randrange(0, 1 + len(base) // 12)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            texts[n] = " ".join(copy).title() if n % 2 else " ".join(copy)
            n += 1
    texts |= {row[0] + 1000: row[1] for row in rows() if row[0] is not None}
    expected = brute_components(texts)
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
    found = near_dedup.near_duplicates(frame).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == expected
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in found)


def test_crowded_buckets_are_dealt_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 3)
    monkeypatch.setattr(near_dedup, "SPLIT", 4)
    rng = random.Random(4)
    base = [f"w{i}" for i in range(60)]
    texts = {}
    for n in range(50):
        copy = list(base)
        for at in rng.sample(range(60), rng.randrange(1, 5)):
            copy[at] = f"x{rng.randrange(30)}"
        texts[n] = " ".join(copy)
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = near_dedup.near_duplicates(frame).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == brute_components(texts)


def test_crowded_buckets_of_unequal_sizes_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 2)
    rng = random.Random(11)
    template, texts = [f"t{i}" for i in range(80)], {}
    for n in range(90):
        own = [f"o{rng.randrange(9)}x{i}" for i in range(rng.randrange(1, 40))]
        texts[n] = " ".join(template[: rng.randrange(60, 81)] + own)
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = near_dedup.near_duplicates(frame).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == brute_components(texts)


def test_a_large_component_is_dealt_once_for_few_others(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 4)
    rows = [(7, n, 0) for n in range(40)] + [(7, 50, 50), (7, 60, 60), (8, 1, 1), (8, 2, 2), (9, 3, 3), (9, 4, 3)]
    rows += [(10, n, n) for n in range(70, 79)]
    placed = spark.createDataFrame(rows, "bucket long, node long, component long")
    found = {r["bucket"]: (r["largest"], r["outer"], r["inner"]) for r in near_dedup._mixed_buckets(placed).collect()}
    assert found == {7: (0, 1, 10), 8: (None, 1, 0), 10: (78, 2, 1)}


def test_every_linked_pair_meets_in_its_prefixes():
    rng = np.random.default_rng(5)
    pool = rng.integers(0, 2**63, 60).astype(np.uint64)
    sets = [np.sort(rng.choice(pool, rng.integers(1, 50), replace=False)) for _ in range(120)]
    sets += [np.sort(rng.choice(one, max(1, int(0.8 * len(one))), replace=False)) for one in sets]
    counts = np.zeros(near_dedup.SLOTS, np.uint32)
    np.add.at(counts, (np.concatenate(sets) % near_dedup.SLOTS).astype(np.int64), 1)
    nodes = np.arange(len(sets))
    batch = pa.RecordBatch.from_arrays(
        [pa.array(nodes), pa.array(nodes), pa.array([one.tobytes() for one in sets], pa.binary())],
        names=["node", "component", "shingles"],
    )
    rows = pa.Table.from_batches(near_dedup._prefixes(counts)([batch])).to_pylist()
    met = set()
    for bucket in {r["bucket"] for r in rows}:
        group = [r for r in rows if r["bucket"] == bucket]
        belongs = near_dedup._by_prefix(pa.Table.from_pylist(group))
        for i in range(len(group) - 1):
            for k in belongs(i, np.arange(i + 1, len(group))):
                met.add(frozenset((group[i]["node"], group[k]["node"])))
    linked = 0
    for i in nodes:
        for k in nodes[i + 1 :]:
            common = len(np.intersect1d(sets[i], sets[k]))
            if 100 * common >= 75 * (len(sets[i]) + len(sets[k]) - common):
                linked += 1
                assert frozenset((int(i), int(k))) in met
    assert linked > 100


def test_documents_of_one_template_do_not_meet(spark):
    texts = [(n, " ".join([f"t{i}" for i in range(60)] + [f"o{n}x{i}" for i in range(16)])) for n in range(40)]
    sets = spark.createDataFrame([(n, near_dedup.shingle_set(t.encode()).tobytes()) for n, t in texts], "node long, shingles binary")
    crowd = spark.createDataFrame([(n, n) for n, _ in texts], "doc_id long, component long")
    assert near_dedup._meetings(sets, crowd).count() == 0


def test_near_duplicates_of_awkward_rows(spark):
    found = by_id(near_dedup.near_duplicates(documents(spark)), "doc_id", "component_id", "kept")
    known = {v[0]: v[1:] for v in found}
    assert len(found) == len(rows()) and known[100] == (7, False)
    assert known[104] == (104, True) and known[106] == (106, True)


def test_components_against_union_find(spark):
    rng = random.Random(3)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(400, 440)]
    found = dict(components.components(spark.createDataFrame(pairs, "a long, b long")).collect())
    top = {i: i for pair in pairs for i in pair}
    for _ in range(300):
        for a, b in pairs:
            top[a] = top[b] = min(top[a], top[b])
    linked = {i for a, b in pairs if a != b for i in (a, b)}
    assert found == {i: top[i] for i in linked}


def test_no_rows(spark):
    assert exact_dedup.exact_duplicates(nothing(spark)).count() == 0
    assert near_dedup.near_duplicates(nothing(spark)).count() == 0


def test_dropping_keeps_the_columns(spark):
    docs = documents(spark)
    for drop in (exact_dedup.drop_exact_duplicates, near_dedup.drop_near_duplicates):
        kept = drop(docs)
        assert kept.columns == docs.columns
        assert {r["doc_id"] for r in kept.collect()} >= {None, 0, 7, 107} and kept.where("doc_id = 100").count() == 0


def test_dropping_leaves_one_of_repeated_rows(spark):
    texts = [(k, " ".join(f"w{k}x{i}" for i in range(30))) for k in range(4)]
    repeated = [*texts, *texts[:2], texts[0], (None, "no id here"), (None, "no  id here"), (None, "other"), (9, texts[3][1])]
    docs = spark.createDataFrame(repeated, "doc_id long, text string").repartition(3)
    for drop in (exact_dedup.drop_exact_duplicates, near_dedup.drop_near_duplicates):
        found = [(r["doc_id"], normalised(r["text"])) for r in drop(docs).collect()]
        assert sorted(found, key=str) == sorted([*texts, (None, "no id here"), (None, "other")], key=str)
