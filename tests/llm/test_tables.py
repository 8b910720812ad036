from __future__ import annotations

import random
import re

import pytest

import corpus_pipeline
from headway.llm import chat, mixing, url_filter
from headway.llm.common import WORD
from tests.llm.helpers import by_id, documents, nothing, rows


def water_filled(sizes: dict, weights=(1, 2, 3), cap=3) -> dict:
    """Targets by repeated sharing of the excess."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    capped: set = set()
    while True:
        left = sum(sizes.values()) - sum(cap * sizes[s] for s in capped)
        each = left / max(sum(weight[s] for s in order if s not in capped), 1e-9)
        over = {s for s in order if s not in capped and weight[s] * each > cap * sizes[s]}
        if not over:
            return {s: cap * sizes[s] if s in capped else weight[s] * each for s in order}
        capped |= over


def mixed_rows(n: int) -> list[tuple]:
    rng = random.Random(n)
    sources = [None, "a", "b", "é", "z", "tiny", "empty"]
    found = []
    for i in range(n):
        source = "a" if i % 3 == 0 else rng.choice(sources)
        words = 0 if source == "empty" else 1 if source == "tiny" else rng.choice([1, 5, 40, 40, 200])
        found.append((i, "w " * words, source))
    return found


def test_mix_against_brute_force(spark):
    given = mixed_rows(1500)
    sizes: dict = {}
    for _, text, source in given:
        sizes[source] = sizes.get(source, 0) + len(re.findall(WORD, text))
    targets = water_filled(sizes)
    docs = spark.createDataFrame(given, "doc_id long, text string, source string")
    found = {r["doc_id"]: r for r in mixing.mixed(docs.repartition(5)).collect()}
    taken: dict = dict.fromkeys(sizes, 0)
    for i, text, source in given:
        r = found[i]
        assert r["size"] == len(re.findall(WORD, text)) and r["source_size"] == sizes[source]
        assert r["target"] == pytest.approx(targets[source])
        assert 0 <= r["taken"] <= 3 * r["size"] and r["taken"] == r["copies"] * r["size"]
        taken[source] += r["taken"]
    assert all(abs(taken[s] - targets[s]) <= 2 * 200 for s in sizes)
    again = {r["doc_id"]: r for r in mixing.mixed(docs).collect()}
    assert again == found
    copies = mixing.mix(docs).groupBy("doc_id").count().collect()
    assert {tuple(r) for r in copies} == {(i, r["copies"]) for i, r in found.items() if r["copies"]}


def test_documents_without_an_id_get_their_copies(spark):
    given = [(i if i % 3 else None, f"{'w ' * (5 + i % 7)}t{i}", f"s{i % 2}") for i in range(300)]
    given += [given[0]] * 4 + [given[1]] * 3 + [(1, "other text of the same id", "s1")]
    docs = spark.createDataFrame(given, "doc_id long, text string, source string").repartition(4)
    decided = mixing.mixed(docs).collect()
    found = [tuple(r) for r in mixing.mix(docs).collect()]
    assert len(found) == sum(r["copies"] for r in decided)
    for source in ("s0", "s1"):
        words = sum(len(text.split()) for _, text, s in found if s == source)
        target = next(r["target"] for r in decided if r["source_size"] == sum(len(t.split()) for _, t, s in given if s == source))
        assert abs(words - target) <= 2 * 12
    assert any(i is None for i, _, _ in found) and set(found) <= set(given)


def test_rates_are_exponentially_tilted(spark):
    """The dual solution against bisection, one source."""
    sizes = spark.createDataFrame([(False, "a", 10, 5), (False, "a", 100, 5)], "no_source boolean, source string, size long, n long")
    goals = spark.createDataFrame([(False, "a", 550, 300.0, 10)], "no_source boolean, source string, source_size long, target double, documents long")
    theta, scale = mixing.solve(sizes, goals).select("theta", "scale").first()
    import math

    assert sum(5 * s * math.exp(theta * s / scale) for s in (10, 100)) == pytest.approx(300, rel=1e-5)


def test_mix_of_awkward_rows(spark):
    assert mixing.mixed(documents(spark)).count() == len(rows())
    assert mixing.mixed(nothing(spark)).count() == 0
    assert mixing.mix(documents(spark)).columns == documents(spark).columns


def brute_rule(host: str, path: str, rules) -> tuple:
    fits = [
        (len(h.split(".")), len(p), h + p, v)
        for h, p, v in rules
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    return max(fits)[2:] if fits else (None, "allow")


def test_urls_against_brute_force(spark):
    rng = random.Random(9)
    hosts = ["org", "example.org", "a.example.org", "com", "x.com", "xorg", "EXAMPLE.Org", "", "example.org.", "com:80"]
    paths = ["", "/", "/es", "/es/", "/en/1", "/en/12/x", "/fr/a", "/de/", "//es/", "/es/?q=/en/1", "#/es/", "/a/b/c/d"]
    urls = [rng.choice(["http://", "https://", "", "x://y://"]) + rng.choice(hosts) + rng.choice(paths) for _ in range(300)]
    pages = spark.createDataFrame(list(enumerate([*urls, None, ""])), "page_id long, url string")
    more = [("", "/", "block"), ("example.org", "/es/", "allow"), ("example.org", "", "allow"), ("org", "/a/b", "block"), ("a.example.org", "/e", "block")]
    for given in (url_filter.RULES, [*url_filter.RULES, *more]):
        known = {}
        for h, p, v in given:  # a block wins over an allow of the same rule
            known[h, p] = max(v, known.get((h, p), v))
        frame = spark.createDataFrame([*given, (None, "/", "block")], "host string, path string, verdict string")
        for bound in (url_filter.TRIE_RULES, 0):
            for r in url_filter.judged(pages, frame, trie_rules=bound).collect():
                url = ([*urls, None, ""])[r["page_id"]] or ""
                rest = url.split("://", 1)[1] if "://" in url else ""
                host = re.match(r"[^/?#]*", rest)[0]
                path = re.match(r"[^?#]*", rest[len(host) :])[0]
                host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
                assert (r["host"], r["path"]) == (host, path), url
                assert (r["rule"], r["verdict"]) == brute_rule(host, path, [(*k, v) for k, v in known.items()]), url


def test_long_urls_meet_as_many_rules_as_there_are_lengths(spark):
    """What a url is multiplied by follows from the rules, not from its own length."""
    paths = ["/" + "a/" * k for k in (1, 5, 40)]
    given = [("org", path, "block") for path in paths] + [("b.org", "/", "allow")]
    long = "http://" + "x." * 3000 + "org/" + "a/" * 30_000
    pages = spark.createDataFrame(
        [(1, long, "h", 1), (2, long, "h", 2), (3, "http://a.b.org/" + "a/" * 4 + "c", None, 3), (4, None, "h", 4)],
        "page_id long, url string, host string, key long",
    )
    frame = spark.createDataFrame(given, "host string, path string, verdict string")
    shown = [sorted(map(tuple, url_filter.judged(pages, frame, trie_rules=n).collect())) for n in (100, 0)]
    assert shown[0] == shown[1]
    assert [row[3:] for row in shown[0]] == [
        ("org" + paths[2], "block"), ("org" + paths[2], "block"), ("b.org/", "allow"), (None, "allow"),
    ]
    parted = pages.select("page_id", url_filter.host().alias("host"), url_filter.path().alias("path"))
    met = url_filter._meetings(parted.selectExpr("page_id as key", "host", "path"), frame).where("key = 1")
    assert met.count() == len(paths) and met.selectExpr("max(length(_path))").first()[0] == len(paths[-1])
    for bound in (100, 0):
        assert url_filter.judged(pages.limit(0), frame, trie_rules=bound).count() == 0
        assert url_filter.judged(pages, frame.limit(0), trie_rules=bound).where("rule is null").count() == 4


def test_branches_are_ranked(spark):
    #      1 -> 2 -> 4   and   1 -> 3; 9 has a parent that is not there
    nodes = [
        (1, 1, None, "user", "q", 0.0), (1, 2, 1, "assistant", "bad", 1.0), (1, 3, 1, "assistant", "good", 5.0),
        (1, 4, 2, "user", "<s>[x]\\", 1.0), (1, 9, 77, None, None, None), (None, 1, None, "user", "lone", 0.0),
    ]
    frame = spark.createDataFrame(nodes, "conv_id long, node long, parent long, role string, text string, score double")
    found = {(r["conv_id"], r["branch"]): r for r in chat.formatted(frame, branches=5).collect()}
    assert [found[1, k]["leaf"] for k in (1, 2, 3)] == [3, 4, 9] and (None, 1) in found
    assert found[1, 1]["conversation"] == "<s>[user]q</s><s>[assistant]good</s>"
    assert found[1, 2]["conversation"] == "<s>[user]q</s><s>[assistant]bad</s><s>[user]\\ls>\\bx\\e\\s</s>"
    assert [tuple(s) for s in found[1, 1]["loss_spans"]] == [(28, 32)]


def test_cycles_are_cut(spark):
    """Members of a cycle are roots; what hangs on them keeps its path to them."""
    nodes = [
        (1, 1, 2, "user", "a", 1.0), (1, 2, 1, "assistant", "b", 2.0),  # each other's parent
        (1, 3, 2, "user", "c", 5.0), (1, 4, 3, "assistant", "d", 0.0), (1, 7, 7, "user", "own", 0.0),
        (2, 1, 3, "user", "x", 0.0), (2, 2, 1, "user", "y", 0.0), (2, 3, 2, "user", "z", 0.0),
        (3, 1, None, "user", "q", 0.0),
    ]
    frame = spark.createDataFrame(nodes, "conv_id long, node long, parent long, role string, text string, score double")
    paths = {}
    for r in chat.leaf_paths(frame).collect():
        paths.setdefault((r["conv_id"], r["leaf"]), []).append((r["up"], r["node"]))
    found = {key: [node for _, node in sorted(path)] for key, path in paths.items()}
    assert found == {(1, 4): [4, 3, 2], (1, 1): [1], (1, 7): [7], (2, 1): [1], (2, 2): [2], (2, 3): [3], (3, 1): [1]}
    best = {r["conv_id"]: r["conversation"] for r in chat.formatted(frame).collect()}
    assert best[1] == "<s>[assistant]b</s><s>[user]c</s><s>[assistant]d</s>" and best[2] == "<s>[user]x</s>"


def test_many_branches_against_plain_paths(spark):
    rng = random.Random(6)
    nodes = []
    for c in range(6):
        for node in range(1, 120):
            parent = None if node == 1 else rng.choice([max(1, node - 1), rng.randrange(1, node)])
            nodes.append((c, node, parent, rng.choice(["user", "assistant"]), f"t{node}", rng.randrange(9) / 4))
    frame = spark.createDataFrame(nodes, "conv_id long, node long, parent long, role string, text string, score double")
    found = {(r["conv_id"], r["branch"]): r for r in chat.formatted(frame, branches=3).collect()}
    known = {(c, n): (p, r, t, s) for c, n, p, r, t, s in nodes}
    for c in range(6):
        parents = {p for k, n, p, *_ in nodes if k == c}
        ranked = []
        for leaf in {n for k, n, *_ in nodes if k == c} - parents:
            path, at = [], leaf
            while at is not None:
                path.append(at)
                at = known[c, at][0]
            ranked.append((-sum(known[c, n][3] for n in path), leaf, path[::-1]))
        for branch, (_, leaf, path) in enumerate(sorted(ranked)[:3], 1):
            assert found[c, branch]["leaf"] == leaf
            assert found[c, branch]["conversation"] == "".join(f"<s>[{known[c, n][1]}]{known[c, n][2]}</s>" for n in path)


def test_texts_join_the_chosen_paths_only(spark, monkeypatch):
    """Nothing before the last join reads a text, so none crosses an exchange unranked."""
    seen = []
    store = chat.stored
    monkeypatch.setattr(chat, "stored", lambda df, label: seen.append((label, df.columns)) or store(df, label))
    rows = [(1, k, k - 1 or None, "user", "t", 0.0) for k in range(1, 9)]
    frame = spark.createDataFrame(rows, "conv_id long, node long, parent long, role string, text string, score double")
    plan = chat.formatted(frame)
    assert [label for label, columns in seen if "text" in columns] == ["chat-nodes"]
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") <= 4


def test_stages_return_rows_as_they_were(spark):
    """Whatever the columns are called that operators do not know."""
    given = set(documents(spark).collect())
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, documents(spark), "").collect()
        assert kept and set(kept) <= given, name
        assert stage(spark, nothing(spark), "").collect() == [], name


def test_rates_that_do_not_settle_are_an_error(spark, monkeypatch):
    monkeypatch.setattr(mixing, "MAX_STEPS", 1)
    docs = spark.createDataFrame(mixed_rows(300), "doc_id long, text string, source string")
    with pytest.raises(ArithmeticError):
        mixing.mixed(docs).count()


def test_escapes_are_reversible(spark):
    rng = random.Random(2)
    texts = ["".join(rng.choice("\\<>[]slbe/é\n") for _ in range(rng.randrange(12))) for _ in range(300)]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in frame.select("t", chat.escaped(frame["t"]).alias("e"), chat.unescaped(chat.escaped(frame["t"])).alias("u")).collect():
        assert r["u"] == r["t"] and not set("<[]") & set(r["e"])


def test_long_and_awkward_conversations(spark):
    turns = [(1, k, "assistant" if k % 2 else "user", f"t{k} ") for k in range(70)]
    turns += [(2, None, None, None), (None, 0, "user", ""), (3, 0, "a]b", "x"), (3, 0, "a]b", "x")]
    frame = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    found = {r["conv_id"]: r for r in chat.read_back(chat.formatted(chat.linear(frame))).collect()}
    assert found[1]["n_turns"] == 70 and found[1]["loss_chars"] == sum(len(f"t{k} ") for k in range(1, 70, 2))
    assert found[2]["n_turns"] == 1 and found[None]["loss_chars"] == 0 and found[3]["n_turns"] == 2
    assert chat.formatted(chat.linear(frame.limit(0))).count() == 0


def test_chat_runs_without_python(spark, tmp_path):
    frame = spark.createDataFrame([(1, 0, "user", "a")], "conv_id long, turn long, role string, text string")
    frame.write.parquet(str(tmp_path / "c"))
    plan = chat.read_back(chat.formatted(chat.linear(spark.read.parquet(str(tmp_path / "c")))))
    assert not re.search("Python|Pandas|Arrow", plan._jdf.queryExecution().executedPlan().toString())


def test_pipeline_stages(spark):
    docs, counts = documents(spark), []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, "").cache()
        assert docs.columns == documents(spark).columns, name
        counts.append(docs.count())
    assert counts[0] >= counts[1] >= counts[2] > 0
    last = corpus_pipeline.STAGES[-1][1](spark, docs, "").collect()
    assert len(last) == counts[3] and all(r["round_trip"] for r in last)
    assert by_id(docs, "doc_id")
