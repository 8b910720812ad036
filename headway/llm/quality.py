"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document; the ledger stores the measurements and one bit
for each failed rule.  Policies are versioned masks over the ledger, so a policy is applied,
changed or taken apart without reading a text again.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.llm.common import worker_state

SYMBOLS = "#*$%&|<>"
_SPACES = " \t\n\v\f\r"

MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_letters", "n_upper"
)

# Name and failure condition of every rule; its place is its bit.  Rules are only ever added.
RULES: tuple[tuple[str, str], ...] = (
    ("few_words", "n_words < 50"),
    ("repeated_words", "100 * n_repeat_words > 50 * n_words"),
    ("many_symbols", "100 * n_symbols > 10 * n_words"),
    ("repeated_lines", "n_dup_lines > 1 and 100 * n_dup_lines > 30 * n_lines"),
    ("long_words", "word_chars > 15 * n_words"),
    ("few_letters", "2 * n_letters < word_chars"),
    ("shouting", "2 * n_upper > n_letters"),
)
BITS = {name: 1 << place for place, (name, _) in enumerate(RULES)}

BASE = BITS["few_words"] | BITS["repeated_words"]
# Versions of the policy: the rules that reject.
POLICIES = {
    1: BASE,
    2: BASE | BITS["many_symbols"] | BITS["repeated_lines"],
    3: (1 << len(RULES)) - 1,
}
CURRENT = 3


def _classes() -> np.ndarray:
    """Of every code point: 1 for ASCII white space, 2 a letter, 3 an upper-case letter."""
    every = map(chr, range(0x110000))
    kinds = [1 if c in _SPACES else 2 * c.isalpha() + (c.isalpha() and c.isupper()) for c in every]
    return np.array(kinds, np.uint8)


def measure(text: str) -> tuple[int, ...]:
    """The measurements of one text, in the order of MEASURES."""
    words = text.encode().split()  # of bytes: at ASCII white space only
    windows = list(zip(words, words[1:], words[2:]))
    repeated = 0
    if len(set(windows)) < len(windows):
        counts, reach = Counter(windows), 0
        for i, window in enumerate(windows):
            if counts[window] > 1:
                repeated += i + 3 - max(reach, i)
                reach = i + 3
    lines = [line for line in text.split("\n") if line.strip(_SPACES)]
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    _, spaces, letters, upper = np.bincount(
        worker_state("classes", _classes)[codes], minlength=4
    ).tolist()
    return (
        len(words),
        len(text) - spaces,
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated,
        len(lines),
        letters + upper,
        upper,
    )


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [measure(text.as_py() or "") for text in batch.column(1)]
        columns = [pa.array([row[k] for row in found], pa.int64()) for k in range(len(MEASURES))]
        yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["doc_id", *MEASURES])


def ledger(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, the measurements, failed (bits of failed rules).

    Null text has no words; so it fails ``few_words`` only, like empty and blank text.
    Repeated rows have equal entries; null ids are kept.  Other columns are not read.
    """
    kinds = ", ".join(f"{name} long" for name in MEASURES)
    measured = docs.select("doc_id", "text").mapInArrow(_measured, f"doc_id long, {kinds}")
    bits = [F.when(F.expr(rule), F.lit(BITS[name])).otherwise(0) for name, rule in RULES]
    failed = bits[0]
    for bit in bits[1:]:
        failed = failed.bitwiseOR(bit)
    return measured.withColumn("failed", failed.cast("long"))


def kept(policy: int = CURRENT) -> Column:
    """Whether a ledger entry passes a version of the policy."""
    return F.col("failed").bitwiseAND(F.lit(POLICIES[policy])) == 0


def ablations(entries: DataFrame, policy: int = CURRENT) -> DataFrame:
    """Per rule of a policy: rule, n_failed, n_only (failed by no other rule), n_kept_without.

    The ledger is first counted by its different bit patterns, of which there are at most two
    to the number of rules; the rest works on those counts.
    """
    mask = POLICIES[policy]
    patterns = (
        entries.select(F.col("failed").bitwiseAND(F.lit(mask)).alias("bits"))
        .groupBy("bits")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    rules = F.array(
        *(F.struct(F.lit(n).alias("rule"), F.lit(b).alias("bit")) for n, b in BITS.items() if b & mask)
    )
    each = patterns.select("bits", "n", F.inline(rules))
    has = F.col("bits").bitwiseAND(F.col("bit")) != 0
    others = F.col("bits").bitwiseAND(F.bitwise_not(F.col("bit")))
    count = lambda condition: F.sum(F.when(condition, F.col("n")).otherwise(0))
    return each.groupBy("rule").agg(
        count(has).alias("n_failed"),
        count(has & (others == 0)).alias("n_only"),
        count(others == 0).alias("n_kept_without"),
    )


def judged(docs: DataFrame, policy: int = CURRENT) -> DataFrame:
    """Ledger entries with ``base_failed`` and ``kept``; what the base fails is never kept."""
    base_failed = F.col("failed").bitwiseAND(F.lit(BASE)) != 0
    return ledger(docs).select(
        "doc_id",
        *MEASURES[:5],
        base_failed.alias("base_failed"),
        (~base_failed & kept(policy)).alias("kept"),
        *MEASURES[5:],
        "failed",
    )
