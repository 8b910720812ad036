"""The pipeline as a whole, over a written folder, against plain versions of its stages."""

from __future__ import annotations

import random
from collections import Counter

import corpus_pipeline
from headway.llm import langid, mixing, pieces
from tests.llm.helpers import documents
from tests.llm.test_dedup import brute_components, normalised


def written(spark, folder) -> str:
    rng = random.Random(9)
    awkward = documents(spark).where("doc_id is not null").dropDuplicates(["doc_id"])
    base = {r["doc_id"]: r for r in awkward.collect()}
    rows = list(base.values())
    for n in range(40):  # near and exact copies of clean documents
        one = base[rng.randrange(60)]
        words = one["text"].split()
        if n % 2:
            words[rng.randrange(len(words))] = "other"
        rows.append((1000 + n, " ".join(words), *one[2:]))
    spark.createDataFrame(rows, awkward.schema).repartition(4).write.parquet(f"{folder}/documents.parquet")
    return str(folder)


def test_run_against_plain_stages(spark, tmp_path):
    folder = written(spark, tmp_path)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    spoken = {
        r["doc_id"]: texts[r["doc_id"]]
        for r in langid.identify(docs).collect()
        if r["lang_pred"] != langid.UNKNOWN and r["score"] >= langid.MIN_SCORE
    }
    # Clean documents stay; those without a letter go.
    assert set(range(60)) <= set(spoken) and not {104, 105, 106, 108} & set(spoken)
    first: dict = {}
    for i in sorted(spoken):
        first.setdefault(normalised(spoken[i]), i)
    single = {i: spoken[i] for i in first.values()}
    apart = {i: single[i] for i, (_, top) in brute_components(single).items() if i == top}
    assert len(spoken) > len(single) > len(apart)
    left = docs.where(docs["doc_id"].isin(list(apart)))
    copies = Counter({r["doc_id"]: r["copies"] for r in mixing.mixed(left).collect()})
    found = corpus_pipeline.run(spark, folder).collect()
    assert Counter(r["doc_id"] for r in found) == +copies
    model = pieces.load()
    for r in found:
        spelled = b"".join(model.spelled[i] for i in r["ids"]).decode()
        assert spelled == model.prefix + texts[r["doc_id"]] and r["round_trip"]
        assert r["n_pieces"] == len(r["ids"])


def test_encode_searches_the_next_segmentations(spark):
    """The stage keeps what the search finds: as many alternatives as op1, none better than the best."""
    texts = ["some ordinary words of a document", "words again", "", None]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    encoded = corpus_pipeline.encode(spark, docs, "")
    found = {r["doc_id"]: r for r in encoded.collect()}
    lattice = pieces.Lattice(pieces.load())
    for i, text in enumerate(texts):
        if not text:
            assert not found[i]["alternatives"]
            continue
        expected = lattice.nbest(lattice.pieces.prefix + text, pieces.NBEST)
        scores = [found[i]["score"], *(way["score"] for way in found[i]["alternatives"])]
        assert len(scores) == pieces.NBEST
        assert all(abs(a - b) < 1e-6 * abs(b) for a, (b, _) in zip(scores, expected))
        for way in found[i]["alternatives"]:
            ids = pieces.alternative(found[i]["ids"], way["edits"])
            spelled = b"".join(lattice.pieces.spelled[piece] for piece in ids).decode()
            assert ids != found[i]["ids"] and spelled == lattice.pieces.prefix + text
