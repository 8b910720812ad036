"""Awkward documents that every operator has to bear."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    # Names that operators use themselves.
    "fp long, node long, size long, sums string, _norm string, component string, copies long, "
    "_key string, _id long, _of string, _gone long, _copy long, _text_key long, _copies long, "
    "_from string, _none boolean, _alike long, _found string, _rank long, row string, own long, "
    "key string, found string, gone long, alike long, id string, of string"
)
EXTRA = (
    1, 2, 3, "s", "n", "c", 4,
    "k", 5, "o", 6, 7, 8, 9, "f", True, 10, "x", 11, "r", 12, "y", "z", 13, 14, "i", "p",
)
LONG = "lorem ipsum dolor " * 6000 + "x" * 5000


def rows() -> list[tuple]:
    rng = random.Random(5)
    vocabulary = {
        "en": ["the", "and", "this", "with", "house", "that", "of"],
        "fr": ["le", "une", "été", "maison", "avec", "que", "où"],
    }
    found = []
    for i in range(60):
        lang = "fr" if i % 3 else "en"
        text = " ".join(rng.choice(vocabulary[lang]) + rng.choice("abcde") for _ in range(60))
        found.append((i, text, lang, f"s{i % 4}", None, *EXTRA))
    base = found[7][1]
    odd = [
        base, base.replace(" ", "\t\n"), base + " more words here", base.upper(), "", None, " \n\t ",
        "one two", "123 456 !!", "\x1c\u2028\u00a0 not\x85white", "▁tile ▁ 日本 \0 😀", LONG,
    ]
    found += [(100 + k, text, "en", None if k % 2 else "s1", None, *EXTRA) for k, text in enumerate(odd)]
    found.append((None, base, None, None, None, *EXTRA))
    found.append((None, None, None, None, None, *[None] * len(EXTRA)))
    return found + [found[3], found[3]]  # repeated rows


def documents(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(rows(), SCHEMA).repartition(3)


def nothing(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)


def by_id(found: DataFrame, *columns: str) -> list[tuple]:
    """Values in the order of the ids; nulls last."""
    values = [tuple(row[c] for c in columns) for row in found.collect()]
    return sorted(values, key=lambda v: (v[0] is None, v[0] or 0, str(v)))
