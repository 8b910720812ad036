"""Operators that look at one text at a time, against plain versions of their rules."""

from __future__ import annotations

import hashlib
import math
import random
import re

import pytest
import sentencepiece

from headway.llm import langid, pieces, privacy, quality, token_counts
from tests.llm.helpers import LONG, by_id, documents, nothing, rows


@pytest.fixture(scope="module")
def model():
    return pieces.load()


@pytest.fixture(scope="module")
def lattice(model):
    return pieces.Lattice(model)


def segmentations(text: str, model) -> list[tuple[float, tuple]]:
    """All segmentations of a short text, from the best down."""
    if not text:
        return [(0.0, ())]
    found = []
    for size in range(1, len(text) + 1):
        if text[:size] in model.scores:
            number, score = model.scores[text[:size]]
            ids = (number,)
        elif size == 1:
            score, ids = model.unknown, tuple(model.byte_ids[b] for b in text[0].encode())
        else:
            continue
        found += [(score + s, ids + rest) for s, rest in segmentations(text[size:], model)]
    return sorted(found, key=lambda way: -way[0])


@pytest.mark.parametrize("text", ["house", "the end", "a  b", "né☃", "x,y.z", "é▁t", "ins\nin", "\0a"])
def test_nbest_against_all_segmentations(text, model, lattice):
    ids, _, scores, others = lattice.encode([text], 4)
    every = segmentations(model.prefix + text, model)[:4]
    found = [scores[0], *(score for score, _ in others[0])]
    assert found == pytest.approx([score for score, _ in every])
    by_score = {}
    for score, way in segmentations(model.prefix + text, model):
        by_score.setdefault(round(score, 3), set()).add(way)
    ways = [ids.tolist(), *(pieces.alternative(ids.tolist(), edits) for _, edits in others[0])]
    assert len({tuple(way) for way in ways}) == len(ways)
    assert all(tuple(way) in by_score[round(score, 3)] for score, way in zip(found, ways))


def test_the_search_agrees_with_itself_word_by_word(lattice):
    rng = random.Random(1)
    words = ["".join(rng.choice("aehinrst,é ☃") for _ in range(rng.randrange(1, 14))) for _ in range(400)]
    lattice._search(set(words))
    for word in words:
        at = lattice.kept[word]
        two = lattice.nbest(word, 2)
        assert lattice.scores[at] == pytest.approx(two[0][0])
        loss = two[0][0] - two[1][0] if len(two) > 1 else float("inf")
        assert lattice.losses[at] == pytest.approx(loss)


def best_scores(text: str, model, n: int) -> list[float]:
    """Scores of the n best segmentations, place by place."""
    longest, best = max(map(len, model.scores)), [[0.0]]
    for j in range(1, len(text) + 1):
        ways = []
        for i in range(max(0, j - longest), j):
            score = model.scores.get(text[i:j], (0, model.unknown if i == j - 1 else None))[1]
            ways += [] if score is None else [score + s for s in best[i]]
        best.append(sorted(ways, reverse=True)[:n])
    return best[-1]


def test_runs_of_one_character_are_searched_in_bounded_steps(model, lattice, monkeypatch):
    """Runs have very many equal segmentations; the search must not begin them all."""
    pushed, push = [0], pieces.heapq.heappush

    def counted(queue, entry):
        pushed[0] += 1
        assert pushed[0] <= most, "too many paths"
        push(queue, entry)

    monkeypatch.setattr(pieces.heapq, "heappush", counted)
    lengths = [*range(1000, 1065), 2000, 10007, 20000]
    texts = [f"{c}{'-' * k}" for c in (" ", "end\n") for k in lengths] + ["=" * 10007, "end\n" + "-" * 1001 + "\nnext"]
    for text in texts:
        most, pushed[0] = 3 * sum(map(len, lattice._arcs(text))), 0
        found = lattice.nbest(text, 3)
        assert len({ids for _, ids in found}) == 3
        if len(text) < 1100:
            assert [score for score, _ in found] == pytest.approx(best_scores(text, model, 3))
        most, pushed[0] = 10**9, 0
        ids, _, scores, others = lattice.encode([text], 3)
        ways = [tuple(pieces.alternative(ids.tolist(), edits)) for _, edits in others[0]]
        assert len({tuple(ids.tolist()), *ways}) == 3
        same = model.prefix.encode()
        assert {pieces._decoded(list(way), model.spelled, same) for way in ways} == {text}


def test_nbest_of_the_library(model, lattice):
    """Words without rare characters, where the library's single floats are exact."""
    from sentencepiece import sentencepiece_model_pb2 as proto

    unigram = proto.ModelProto()
    with open(pieces.MODEL, "rb") as file:
        unigram.ParseFromString(file.read())
    unigram.trainer_spec.model_type = 1
    library = sentencepiece.SentencePieceProcessor(model_proto=unigram.SerializeToString())
    for word in ("the", "house", "windows", "mountains", "something"):
        found = [list(ids) for _, ids in lattice.nbest(model.prefix + word, 4)]
        assert found == library.nbest_encode_as_ids(word, 4)


def test_round_trip(spark, model):
    decode = pieces.decoder(spark, model)
    encoded = pieces.encode(documents(spark), model)
    found = by_id(encoded.withColumn("text", decode("ids")), "doc_id", "text")
    assert found == by_id(documents(spark), "doc_id", "text")
    assert encoded.where("not round_trip or score > 0").count() == 0
    assert pieces.encode(nothing(spark), model).count() == 0


def plain_spans(text: str) -> list[tuple]:
    spans = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(part) <= 255 for part in m[0].split(".")):
            spans.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = [int(c) for c in m[0] if c.isdigit()][::-1]
        total = sum(d if k % 2 == 0 else 2 * d - 9 * (2 * d > 9) for k, d in enumerate(digits))
        if 13 <= len(digits) <= 19 and total % 10 == 0:
            spans.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
            spans.append(("phone", *m.span()))
    return spans


def test_base_spans_against_plain_patterns():
    rng = random.Random(8)
    bits = ["a", "b.c", "@", "x@y.z", ".", "-", " ", "+", "1", "12", "255", "256", "1.2.3.4", "4111 1111 1111 1111", "(", ")", "\n", "é", "٣"]
    for _ in range(4000):
        text = "".join(rng.choice(bits) for _ in range(rng.randrange(1, 25)))
        assert privacy.base_spans(text) == plain_spans(text), text
    assert privacy.base_spans("9" * 200_000 + "a" * 200_000) == []


def private_rows() -> list[tuple]:
    """One address always next to the same odd word, in different contexts."""
    rng = random.Random(3)
    common = [f"word{i}" for i in range(30)]
    found = []
    for i in range(60):
        words = [rng.choice(common) for _ in range(30)]
        if i % 10 == 0:
            words[15:17] = ["Zanzibarian", "jo@example.org"]
        found.append((i, " ".join(words)))
    return found


def test_terms_that_give_an_entity_away(spark):
    docs = spark.createDataFrame(private_rows() + [(90, "The zanzibarian, alone")], "doc_id long, text string")
    assert [r["term"] for r in privacy.disclosing_terms(docs).collect()] == ["zanzibarian"]
    found = {r["doc_id"]: r for r in privacy.personal_data(docs).collect()}
    assert {i for i, r in found.items() if r["n_term"]} == {0, 10, 20, 30, 40, 50, 90}
    assert found[90]["spans"] == "term:4:15" and found[90]["base_sha256"] == hashlib.sha256(b"").hexdigest()
    joined = {r["doc_id"]: r for r in privacy.personal_data(docs, few=0).collect()}
    assert joined == found
    texts = dict(privacy.sanitised(docs).collect())
    assert "jo@" not in texts[0] and "anzibarian" not in texts[0] and "[email]" in texts[0]
    assert texts[1] == private_rows()[1][1]


def test_terms_reach_rows_without_an_id_and_of_one_id(spark):
    given = private_rows() + [
        (None, "a zanzibarian jo@example.org here"),
        (7, "zanzibarian jo@example.org"),
        (7, "the other one was zanzibarian: jo@example.org"),
        (None, None),
        (7, "zanzibarian jo@example.org"),
    ]
    docs = spark.createDataFrame(given, "doc_id long, text string").repartition(4)
    shown = [sorted(map(str, privacy.personal_data(docs, few).collect())) for few in (1000, 0)]
    assert shown[0] == shown[1]
    texts = [sorted(map(str, privacy.sanitised(docs, few).collect())) for few in (1000, 0)]
    assert texts[0] == texts[1] and len(texts[0]) == len(given)
    found = {tuple(r) for r in privacy.sanitised(docs).collect()}
    assert (None, "a  [email] here") in found and (None, None) in found
    assert (7, " [email]") in found and (7, "the other one was : [email]") in found
    digests = {r["sanitised_sha256"] for r in privacy.personal_data(docs).collect()}
    assert digests == {hashlib.sha256((t or "").encode()).hexdigest() for _, t in found}


def test_overlapping_values_leave_nothing(spark):
    given = {
        "+4915112345678@sms.example.com": "[email]",
        "1.2.3.4@example.org": "[email]",
        "mail jo@example.org here": "mail [email] here",
        "a@b.de+49 151 1234567 x": "[phone] x",  # they touch, and the phone is longer
        "other ann@example.org text": "other [email] text",
        "4111 1111 1111 1111 and 1.2.3.4": "[card] and [ip]",
        "": "",
    }
    docs = spark.createDataFrame([(k % 2 or None, t) for k, t in enumerate(given)], "doc_id long, text string")
    assert sorted(r["text"] for r in privacy.sanitised(docs).collect()) == sorted(given.values())
    hits = [(4, 9, ""), (10, 15, "[email-related]")]
    assert privacy.rewritten("see words there!", [], hits) == "see  [email-related]!"
    assert privacy.rewritten("see words there!", [], [(4, 9, ""), (9, 15, "[ip-related]")]) == "see [ip-related]!"


def plain_shares(texts: list[str], contexts: int) -> dict:
    """Shares of information by their definition, over lists."""
    said = []
    for text in texts:
        spans = privacy.base_spans(text)
        words = [w for w in privacy._terms(text) if all(w[2] <= a or w[1] >= b for _, a, b in spans)]
        own = {}
        for kind, a, b in spans:
            before = [w[0] for w in words if w[1] < a][-privacy.WINDOW :]
            after = [w[0] for w in words if w[1] >= a][: privacy.WINDOW]
            own.setdefault(f"{kind}:{text[a:b]}", []).append((*before, *after))
        said.append(own)
    every = [{w[0] for w in privacy._terms(text)} for text in texts]
    found = {}
    for entity in {e for own in said for e in own}:
        holding = [own[entity] for own in said if entity in own]
        for term in {t for near in holding for context in near for t in context}:
            around = {c for near in holding for c in near if term in c}
            if len(around) < contexts or len(holding) == len(texts):
                continue
            both = sum(any(term in c for c in near) for near in holding)
            alone = sum(term in words for words in every)
            share = math.log(len(texts) * both / (len(holding) * alone)) / math.log(len(texts) / len(holding))
            if share >= privacy.GENERALISED:
                kind = entity.split(":")[0]
                found[term] = max(found.get(term, (0, "")), (round(share, 9), kind))
    return found


def test_shares_of_information_against_their_definition(spark):
    rng = random.Random(12)
    values = ["jo@example.org", "1.2.3.4", "+49 151 1234567", "ann@example.org"]
    texts = []
    for _ in range(300):
        words = [f"w{rng.randrange(40)}" for _ in range(rng.randrange(3, 40))]
        if rng.random() < 0.3:
            k = rng.randrange(4)
            at = rng.randrange(len(words))
            words[at : at + 1] = [f"Odd{k},", values[k]] if rng.random() < 0.95 else [values[k]]
        if rng.random() < 0.1:
            words.append("odd1")
        texts.append(" ".join(words))
    texts += ["jo@example.org", "", "odd2"]
    ids = [None if i % 5 == 0 else i % 90 for i in range(len(texts))]
    docs = spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string").repartition(4)
    found = {r["term"]: (round(r["share"], 9), r["kind"]) for r in privacy.disclosing_terms(docs).collect()}
    assert found == plain_shares(texts, privacy.CONTEXTS) and len(found) >= 2


def test_personal_data_of_awkward_rows(spark):
    found = privacy.personal_data(documents(spark)).collect()
    assert len(found) == len(rows()) and privacy.personal_data(nothing(spark)).count() == 0


def plain_measures(text: str) -> tuple:
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {i + d for i, w in enumerate(windows) if windows.count(w) > 1 for d in range(3)}
    lines = text.split("\n")
    worded = [re.search(r"[^\x20\x09-\x0D]", line) is not None for line in lines]
    dup = sum(worded[k] and lines[k] in lines[:k] for k in range(len(lines)))
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


def test_measures_against_plain_rules():
    rng = random.Random(6)
    bits = ["a", "b", "A ", " ", "\n", "\t", "a b a b", "#", "<x>", "é\u00a0", "\x1c", "\x85", "a\n", "\r"]
    for _ in range(1500):
        text = "".join(rng.choice(bits) for _ in range(rng.randrange(0, 40)))
        assert quality.measure(text)[:5] == plain_measures(text), repr(text)


def test_the_ledger_and_its_policies(spark):
    found = {r["doc_id"]: r for r in quality.judged(documents(spark)).collect()}
    assert found[104]["n_words"] == found[105]["n_words"] == 0 and found[105]["base_failed"]
    assert found[0]["kept"] and not found[111]["kept"]  # the long text repeats itself
    entries = quality.ledger(documents(spark)).cache()
    counts = [entries.where(quality.kept(version)).count() for version in (1, 2, 3)]
    assert counts == sorted(counts, reverse=True)
    kept, mask = counts[2], quality.POLICIES[3]
    for row in quality.ablations(entries, 3).collect():
        bit = quality.BITS[row["rule"]]
        failed = [r["failed"] for r in entries.collect()]
        assert row["n_failed"] == sum(f & bit > 0 for f in failed)
        assert row["n_only"] == sum(f & mask == bit for f in failed)
        assert row["n_kept_without"] == kept + row["n_only"]
    assert quality.judged(nothing(spark)).count() == 0


def test_token_counts_follow_edits():
    counter = token_counts.Counter(token_counts.load())
    rng = random.Random(1)
    bits = ["a", "the ", "'", "'l", "l", " ", "  ", "\n", "1", "23", "!?", "é", "don't", " x", "\t", "日本"]
    for _ in range(400):
        text = "".join(rng.choice(bits) for _ in range(rng.choice([0, 1, 5, 50, 400])))
        tree = token_counts.Tree.build(text, counter)
        for _ in range(4):
            at = rng.randint(0, len(text) + 2)
            instead = "".join(rng.choice(bits) for _ in range(rng.choice([0, 1, 2, 10, 300])))
            tree, text, _ = tree.edit(text, at, at + rng.choice([0, 0, 1, 2, 5, 100]), instead, counter)
            assert tree.total == len(counter.encode(text)) and tree.chars[1] == len(text)
            assert tree.pretokens[1] == len(counter.split.findall(text))
            for values in (tree.chars, tree.pretokens, tree.sums):
                assert all(values[k] == values[2 * k] + values[2 * k + 1] for k in range(1, len(values) // 2))


def test_an_edit_encodes_its_surroundings_only():
    counter = token_counts.Counter(token_counts.load())
    tree = token_counts.Tree.build(LONG, counter)
    after, text, encoded = tree.edit(LONG, 50_000, 50_004, "changed", counter)
    assert encoded < 4 * token_counts.LEAF and after.total == len(counter.encode(text))


def test_an_edit_visits_few_nodes():
    """As many more as the depth grows by, wherever the edit is."""
    counter = token_counts.Counter(token_counts.load())
    for words, depth in ((2_000, 6), (64_000, 11), (256_000, 13)):
        text = "word and another " * (words // 3)
        tree = token_counts.Tree.build(text, counter)
        assert len(tree.sums) // 2 == 1 << depth
        for share in (0, 0.1, 0.5, 0.99, 1):
            at, tree.visited = int(share * len(text)), 0
            tree, text, encoded = tree.edit(text, at, at + 3, "new", counter)
            assert tree.visited <= 3 * depth + 8 and encoded <= 3 * token_counts.LEAF
        assert tree.total == len(counter.encode(text))


def test_token_counts_of_awkward_rows(spark):
    ranks = token_counts.load()
    counter = token_counts.Counter(ranks)
    state = token_counts.with_trees(documents(spark), ranks)
    assert set(documents(spark).columns) <= set(state.columns)
    found = token_counts.edited(state.withColumn("edits", token_counts.trial_edits()), ranks).collect()
    assert len(found) == len(rows())
    assert all(r["n_tokens"] == len(counter.encode(r["text"])) for r in found)
    same = token_counts.edited(state.selectExpr("*", f"cast(null as {token_counts.EDITS}) edits"), ranks)
    assert same.where("n_before <> n_tokens or n_reencoded > 0").count() == 0
    assert token_counts.with_trees(nothing(spark), ranks).count() == 0


def test_language_of_held_out_documents(spark):
    docs = documents(spark)
    found = langid.identify(docs)
    told = found.join(docs.select("doc_id", "lang").distinct(), "doc_id").where("held_out and doc_id < 100")
    assert told.count() > 10 and told.where("lang <> lang_pred").count() == 0
    known = {r["doc_id"]: r for r in found.collect()}
    assert {known[i]["lang_pred"] for i in (104, 105, 106, 108)} == {langid.UNKNOWN}
    assert all(0 <= r["score"] <= 1 for r in known.values()) and found.count() == len(rows())
    assert langid.confident(docs).columns == docs.columns


def test_language_without_anything_to_learn_from(spark):
    assert langid.identify(nothing(spark)).count() == 0
    unknown = documents(spark).selectExpr("doc_id", "text", "cast(null as string) lang")
    assert {r["lang_pred"] for r in langid.identify(unknown).collect()} == {langid.UNKNOWN}
