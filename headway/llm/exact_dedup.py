"""Exact deduplication by counting quotient filters and byte verification.

Each partition turns the 64-bit fingerprints of its texts into a counting quotient
filter: the leading bits are the quotient, and every quotient holds a run of sorted
remainders, in as few bytes as they need, with their counts where these are above one.  Runs of one quotient merge losslessly by their sorted
remainders.  Only texts whose fingerprint counts more than one are compared byte by byte.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.llm.common import (
    SPACE,
    bounded,
    empty_if_null,
    stored,
    without_pairs,
    without_repeats,
)

# Fingerprints held by a task before it hands its runs on, and aimed at in a merged run.
FILTER_ROWS = 1 << 20
RUN_ROWS = 1 << 16

_RUNS = "quotient long, remainders binary, counts binary"


def normalised(text: str = "text") -> Column:
    """Each run of ASCII white space as one space; null as the empty text."""
    return F.regexp_replace(empty_if_null(text), SPACE, " ")


def text_key() -> Column:
    """SHA-256 of the normalised text, by which equal texts are told."""
    return F.sha2(normalised(), 256)


def quotient_bits(rows: int) -> int:
    """Bits of the quotient at which a run holds about RUN_ROWS fingerprints."""
    return max(8, int(np.ceil(np.log2(max(rows, 1) / RUN_ROWS))))


def repeated_fingerprints(fingerprints: DataFrame, bits: int) -> DataFrame:
    """Fingerprints (column ``fp``) that occur more than once, with their counts ``n``."""
    runs = fingerprints.select("fp").mapInArrow(_partition_filters(bits), _RUNS)
    return runs.groupBy("quotient").applyInArrow(_merged_run(bits), "fp long, n long")


def remainder_bytes(bits: int) -> int:
    """Bytes of a stored remainder: what the quotient leaves of 64 bits, rounded up."""
    return -(-(64 - bits) // 8)


def _packed_run(remainders: np.ndarray, width: int) -> bytes:
    """Sorted remainders, ``width`` bytes each."""
    return remainders.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def _read_run(run: bytes, width: int) -> np.ndarray:
    found = np.frombuffer(run, np.uint8).reshape(-1, width)
    return np.pad(found, ((0, 0), (0, 8 - width))).view("<u8").ravel().astype(np.uint64)


# A count above one: the place of its remainder in the run, and the count.
_COUNT = np.dtype([("at", "<u4"), ("n", "<u8")])


def _packed_counts(counts: np.ndarray) -> bytes:
    """Counts of a run, those of one implied."""
    at = np.flatnonzero(counts > 1)
    found = np.empty(len(at), _COUNT)
    found["at"], found["n"] = at, counts[at]
    return found.tobytes()


def _read_counts(run: bytes, size: int) -> np.ndarray:
    counts = np.ones(size, np.uint64)
    told = np.frombuffer(run, _COUNT)
    counts[told["at"]] = told["n"]
    return counts


def _partition_filters(bits: int) -> Callable:
    width = remainder_bytes(bits)

    def runs(values: np.ndarray) -> pa.RecordBatch:
        found, counts = np.unique(values, return_counts=True)
        quotients = found >> np.uint64(64 - bits)
        remainders = found & np.uint64((1 << (64 - bits)) - 1)
        starts = np.flatnonzero(np.r_[True, quotients[1:] != quotients[:-1]])
        ends = np.r_[starts[1:], len(found)]
        return pa.RecordBatch.from_arrays(
            [
                pa.array(quotients[starts].astype(np.int64)),
                pa.array([_packed_run(remainders[a:b], width) for a, b in zip(starts, ends)], pa.binary()),
                pa.array([_packed_counts(counts[a:b]) for a, b in zip(starts, ends)], pa.binary()),
            ],
            names=["quotient", "remainders", "counts"],
        )

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            held.append(batch.column(0).to_numpy(zero_copy_only=False).astype(np.uint64))
            rows += len(held[-1])
            if rows >= FILTER_ROWS:
                yield runs(np.concatenate(held))
                held, rows = [], 0
        if rows:
            yield runs(np.concatenate(held))

    return build


def _merged_run(bits: int) -> Callable:
    """The sorted runs of one quotient become one; counts of equal remainders add up."""
    width = remainder_bytes(bits)

    def merge(group: pa.Table) -> pa.Table:
        runs = [_read_run(run.as_py(), width) for run in group.column("remainders")]
        told = [
            _read_counts(run.as_py(), len(own)) for run, own in zip(group.column("counts"), runs)
        ]
        values, counts = np.concatenate(runs), np.concatenate(told)
        order = values.argsort(kind="stable")  # which merges what is sorted in runs
        values, counts = values[order], counts[order]
        starts = np.flatnonzero(np.r_[True, values[1:] != values[:-1]])
        sums = np.add.reduceat(counts, starts)
        repeated = sums > 1
        quotient = np.uint64(group.column("quotient")[0].as_py())
        found = (quotient << np.uint64(64 - bits)) | values[starts][repeated]
        return pa.table(
            {"fp": pa.array(found.view(np.int64)), "n": pa.array(sums[repeated].astype(np.int64))}
        )

    return merge


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are identical after white space is normalised.  The smallest
    doc_id of a group stays.  Null text counts as empty, so all null and empty texts form
    one group.  A null doc_id never beats another id; a group of null ids only keeps them
    all, as do rows that repeat one doc_id and text, which are one document.  Other columns
    are not read.  An empty table gives no rows.
    """
    texts = docs.select(F.col("doc_id"), normalised().alias("_norm"))
    narrow = stored(
        texts.select("doc_id", F.xxhash64("_norm").alias("fp"), F.sha2("_norm", 256).alias("sha")),
        "exact-fingerprints",
    )
    repeated = stored(
        repeated_fingerprints(narrow, quotient_bits(narrow.count())), "exact-repeated"
    )
    candidates = texts.withColumn("fp", F.xxhash64("_norm")).join(
        bounded(repeated.select("fp")), "fp", "left_semi"
    )
    # Grouping by the text itself compares bytes; each task sends one row per different text.
    classes = stored(
        candidates.groupBy("fp", "_norm")
        .agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .where("group_size > 1")
        .select("fp", F.sha2("_norm", 256).alias("sha"), "keep_id", "group_size"),
        "exact-classes",
    )
    return narrow.join(bounded(classes), ["fp", "sha"], "left").select(
        "doc_id",
        F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (F.col("group_size").isNull() | F.col("doc_id").eqNullSafe(F.col("keep_id"))).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def drop_exact_duplicates(docs: DataFrame) -> DataFrame:
    """One row of each group of equal texts, with all its columns.

    Of rows that repeat the smallest doc_id one stays.  Rows without an id are not dropped for
    one with an id; of a text's rows without an id one stays.  Other columns may have any
    name and come back unchanged.  An empty table gives no rows.
    """
    grouped = stored(
        exact_duplicates(docs)
        .where("group_size > 1")
        .groupBy(F.col("doc_id").alias("id"), F.col("text_sha256").alias("of"), "kept")
        .agg(F.count(F.lit(1)).alias("n")),
        "exact-grouped",
    )
    dropped = stored(grouped.where("not kept and id is not null").select("id", "of"), "exact-dropped")
    repeated = stored(grouped.where("(kept or id is null) and n > 1").select("id", "of"), "exact-repeats")
    return without_repeats(without_pairs(docs, dropped, text_key()), repeated, text_key())


ORACLE = r"""
WITH n AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
  doc_id = min(doc_id) OVER w AS kept, sha256(t) AS text_sha256
FROM n WINDOW w AS (PARTITION BY t)
"""
