"""Language identification by sparse multinomial logistic regression.

Features are TF-IDF weights of hashed character one- to three-grams of the lower-cased
letters.  Document frequencies are counted over every learning document.  The weights are
fitted by follow-the-regularised-leader (per-coordinate rates, elastic net) on a bounded
sample, and a temperature is calibrated on a part of the sample kept out of the fit.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.llm.common import bounded, give_back, packed, stored, unpacked, worker_state

UNKNOWN = "und"
BITS = 15
# The bound of the sample: so many documents of a language are expected in it, whole texts.
SAMPLE_PER_LANGUAGE = 1500
# And so many of all languages together, as one task fits on them.
SAMPLE_TOTAL = 60_000
# A fifth of the sample calibrates.
CALIBRATION = 5
# Predictions below this probability are rejected by ``confident``.
MIN_SCORE = 0.4

ALPHA, BETA, L1, L2, EPOCHS = 0.5, 1.0, 0.05, 0.5, 4


@dataclass
class Model:
    """Learned languages, weights (language by bucket), biases, IDF and temperature."""

    languages: list[str]
    weights: np.ndarray
    biases: np.ndarray
    idf: np.ndarray
    temperature: float


def _letters() -> np.ndarray:
    return np.array([chr(i).isalpha() for i in range(0x110000)])


def gram_counts(text: str | None) -> np.ndarray:
    """Counts of hashed character n-grams; all zero when there is no letter."""
    size = 1 << BITS
    codes = np.frombuffer((text or "").lower().encode("utf-32-le", "replace"), np.uint32)
    letters = worker_state("letters", _letters)[codes] if len(codes) else np.empty(0, bool)
    if not letters.any():
        return np.zeros(size, np.int64)
    # A run of other characters is one boundary, and the text begins and ends with one.
    padded = np.zeros(len(codes) + 2, np.uint64)
    padded[1:-1] = np.where(letters, codes, 0)
    padded = padded[np.r_[True, (padded[1:] != 0) | (padded[:-1] != 0)]]
    counts = np.zeros(size, np.int64)
    rolled = np.zeros(len(padded), np.uint64)
    for n in range(1, 4):
        if len(padded) < n:
            break
        rolled = rolled[: len(padded) - n + 1] * np.uint64(0x100000001B3) + padded[n - 1 :]
        mixed = (rolled + np.uint64(n << 50)) * np.uint64(0x9E3779B97F4A7C15)
        mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        if n == 1:
            mixed = mixed[padded != 0]
        counts += np.bincount((mixed >> np.uint64(64 - BITS)).astype(np.int64), minlength=size)
    return counts


def _features(counts: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.flatnonzero(counts)
    values = np.log1p(counts[at]) * idf[at]
    return at, values / max(np.sqrt((values**2).sum()), 1e-12)


def _softmax(scores: np.ndarray) -> np.ndarray:
    raised = np.exp(scores - scores.max(axis=-1, keepdims=True))
    return raised / raised.sum(axis=-1, keepdims=True)


def _document_frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task: how many texts hold a bucket; bucket -1 counts the texts."""
    found, texts = np.zeros(1 << BITS, np.int64), 0
    for batch in batches:
        for text in batch.column(0):
            found += gram_counts(text.as_py()) > 0
            texts += 1
    at = np.flatnonzero(found)
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.r_[-1, at], pa.int64()), pa.array(np.r_[texts, found[at]], pa.int64())],
        names=["bucket", "n"],
    )
    give_back()


def _fit(idf: np.ndarray) -> Callable:
    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for batch in batches:
            for lang, text, hashed in zip(*(batch.column(k).to_pylist() for k in range(3))):
                counts = gram_counts(text)
                if counts.any():
                    at, x = _features(counts, idf)
                    rows.append((hashed, lang, at.astype(np.int32), x.astype(np.float32)))
        rows.sort(key=lambda row: row[:2])
        languages = sorted({row[1] for row in rows})
        if not languages:
            return
        weights, biases = _ftrl([r for r in rows if r[0] % CALIBRATION], languages)
        scores = np.array([weights[:, at] @ x + biases for _, _, at, x in rows])
        truth = np.array([languages.index(row[1]) for row in rows])
        aside = np.array([row[0] % CALIBRATION == 0 for row in rows])
        temperature = _temperature(scores[aside], truth[aside]) if aside.any() else 1.0
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(languages),
                pa.array([w.astype(np.float32).tobytes() for w in weights], pa.binary()),
                pa.array(biases, pa.float64()),
                pa.array([temperature] * len(languages), pa.float64()),
            ],
            names=["lang", "weights", "bias", "temperature"],
        )
        del rows, scores
        give_back()

    return fit


def _ftrl(rows: list[tuple], languages: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """FTRL-proximal over the rows; the last coordinate is the bias."""
    size = (1 << BITS) + 1
    z, n = np.zeros((len(languages), size)), np.zeros((len(languages), size))

    def weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
        shrunk = np.sign(z) * np.maximum(np.abs(z) - L1, 0)
        return -shrunk / ((BETA + np.sqrt(n)) / ALPHA + L2)

    order = np.random.Generator(np.random.PCG64(7))
    for _ in range(EPOCHS):
        for k in order.permutation(len(rows)):
            _, lang, at, x = rows[k]
            at, x = np.r_[at, size - 1], np.r_[x, 1.0]
            w = weights(z[:, at], n[:, at])
            error = _softmax(w @ x)
            error[languages.index(lang)] -= 1
            gradient = error[:, None] * x
            grown = n[:, at] + gradient**2
            z[:, at] += gradient - (np.sqrt(grown) - np.sqrt(n[:, at])) / ALPHA * w
            n[:, at] = grown
    w = weights(z, n)
    return w[:, :-1], w[:, -1]


def _temperature(scores: np.ndarray, truth: np.ndarray) -> float:
    """The temperature of least log-loss, by golden section over its logarithm."""

    def loss(log_t: float) -> float:
        chosen = _softmax(scores / np.exp(log_t))[np.arange(len(truth)), truth]
        return -np.log(np.maximum(chosen, 1e-12)).mean()

    low, high, ratio = -4.0, 3.0, (np.sqrt(5) - 1) / 2
    for _ in range(60):
        one, two = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, two) if loss(one) <= loss(two) else (one, high)
    return float(np.exp((low + high) / 2))


def remainder(doc_id: str = "doc_id") -> Column:
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3


def learn(
    docs: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE, total: int = SAMPLE_TOTAL
) -> Model:
    """Fit on documents with a language whose crc32 of the id is not 1 modulo 3.

    Document frequencies cover all of them; the regression is fitted on about
    ``per_language`` documents of each language, and ``total`` of all, chosen by a hash of the
    id.  Without any such document the model knows no language.
    """
    known = docs.where((remainder() != 1) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    counted = (
        known.select("text").mapInArrow(_document_frequencies, "bucket long, n long")
        .groupBy("bucket").agg(F.sum("n").alias("n"))
    )
    frequencies = dict(counted.collect())  # at most one row per bucket
    texts = frequencies.pop(-1, 0)
    found = np.zeros(1 << BITS)
    found[list(frequencies)] = list(frequencies.values())
    idf = (np.log((1 + texts) / (1 + found)) + 1).astype(np.float32)

    spoken = stored(known.groupBy("lang").agg(F.count(F.lit(1)).alias("_n")), "lang-counts")
    each = min(per_language, total / max(1, spoken.count()))
    shares = spoken.select("lang", (F.lit(float(each)) / F.col("_n")).alias("_share"))
    hashed = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40))
    sample = (
        known.select("lang", "text", hashed.alias("_hash"))
        .join(bounded(shares), "lang")
        .where(F.col("_hash") < F.col("_share") * (1 << 40))
        .select("lang", "text", "_hash")
    )
    fitted = (
        sample.repartition(1)
        .mapInArrow(_fit(idf), "lang string, weights binary, bias double, temperature double")
        .collect()  # one row per language
    )
    fitted.sort(key=lambda row: row["lang"])
    weights = [np.frombuffer(row["weights"], np.float32) for row in fitted]
    return Model(
        [row["lang"] for row in fitted],
        np.stack(weights) if weights else np.zeros((0, 1 << BITS), np.float32),
        np.array([row["bias"] for row in fitted]),
        idf,
        fitted[0]["temperature"] if fitted else 1.0,
    )


def predictor(spark, model: Model) -> Callable[[Column], Column]:
    """A column function: text to struct(lang, score)."""
    # Languages times 2**BITS weights, as plain values.
    fields = (model.languages, model.weights, model.biases, model.idf, model.temperature)
    shared = spark.sparkContext.broadcast(fields)

    @F.pandas_udf("lang string, score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        m = Model(*shared.value)
        found = []
        for text in texts:
            counts = gram_counts(text)
            if not m.languages or not counts.any():
                found.append((UNKNOWN, 0.0))
                continue
            at, x = _features(counts, m.idf)
            chances = _softmax((m.weights[:, at] @ x + m.biases) / m.temperature)
            best = int(chances.argmax())
            found.append((m.languages[best], float(chances[best])))
        return pd.DataFrame(found, columns=["lang", "score"])

    return predict


def identify(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, lang_pred, score.

    Text that is null or has no letter is ``und`` with score 0, as is all text when nothing
    could be learned.  Ties go to the language first in code point order.  A null doc_id is
    never learned from.  Repeated rows get equal predictions.
    """
    predict = predictor(docs.sparkSession, model or learn(docs))
    return docs.select(
        "doc_id",
        F.coalesce(remainder() == 1, F.lit(False)).alias("held_out"),
        predict("text").alias("_found"),
    ).select("doc_id", "held_out", F.col("_found.lang").alias("lang_pred"), "_found.score")


def confident(docs: DataFrame, least: float = MIN_SCORE) -> DataFrame:
    """Rows with a recognised language, with all their columns.

    Null text and text without a letter have none and go.  Other columns may have any name
    and come back unchanged.  An empty table gives no rows.
    """
    predict = predictor(docs.sparkSession, learn(docs))
    found = packed(docs, found=predict("text"))
    return unpacked(found.where((F.col("found.lang") != UNKNOWN) & (F.col("found.score") >= least)))
