"""Document fingerprints: threshold-scaled sketches of code point shingles.

A text's sketch keeps every shingle hash below a fixed fraction of the hash range, whatever
the length of the text.  Sketches of any texts are therefore samples by the same rule: the
union of sketches is the sketch of the union, and the share of one sketch's hashes found
in another estimates containment, also between a note and a book.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.llm.common import empty_if_null

# Code points of a shingle, a power of two.
WIDTH = 16
# One hash in SCALE is kept.
SCALE = 16
# Code points hashed at once.
CHUNK = 1 << 20

# Documents of a part of the order, and the most parts that are dealt.
PART_ROWS = 2_000
MAX_PARTS = 10_000

_BITS = 48
_PAD = 0x110000  # beyond the last code point
_STEP = np.uint64(0xA24BAED4963EE407)
_MIX = np.uint64(0x9FB21C651E98DF25)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * _MIX
    x = (x ^ (x >> np.uint64(32))) * _STEP
    return x ^ (x >> np.uint64(31))


def shingle_hashes(codes: np.ndarray) -> np.ndarray:
    """Hash of every run of WIDTH code points, by doubling; a shorter text is one run."""
    if 0 < len(codes) < WIDTH:
        codes = np.pad(codes, (0, WIDTH - len(codes)), constant_values=_PAD)
    found = _mixed(codes.astype(np.uint64) + np.uint64(1))
    step = 1
    while step < WIDTH and len(found):
        found = _mixed(found[:-step] * _STEP + found[step:])
        step *= 2
    return found


def sketch(text: str, scale: int = SCALE) -> np.ndarray:
    """Sorted distinct hashes, 48 bits each, of the shingles below the threshold."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    limit = np.uint64((1 << 64) // scale - 1)
    shift = np.uint64(64 - _BITS - (scale.bit_length() - 1))
    kept = []
    for start in range(0, max(1, len(codes) - WIDTH + 1), CHUNK):
        hashes = shingle_hashes(codes[start : start + CHUNK + WIDTH - 1])
        kept.append(hashes[hashes <= limit] >> shift)
    return np.unique(np.concatenate(kept))


def written(hashes: np.ndarray) -> str:
    """The fingerprint: 12 hexadecimal digits a hash, ascending."""
    return hashes.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 2:].tobytes().hex()


def read(fingerprint: str) -> np.ndarray:
    digits = np.frombuffer(bytes.fromhex(fingerprint), np.uint8).reshape(-1, 6)
    return np.pad(digits, ((0, 0), (2, 0))).view(">u8").ravel().astype(np.uint64)


def _shared(one: np.ndarray, other: np.ndarray) -> int:
    return len(np.intersect1d(one, other, assume_unique=True))


def likeness(one: np.ndarray, other: np.ndarray, equal: bool = False) -> float:
    """Estimated share of all shingles of two texts that both hold.

    1 for texts known to be equal; 0 where neither sketch holds a hash otherwise.
    """
    if equal:
        return 1.0
    shared = _shared(one, other)
    return shared / max(1, len(one) + len(other) - shared)


def contained(one: np.ndarray, other: np.ndarray, equal: bool = False) -> float:
    """Estimated share of the shingles of the first text that the second holds too."""
    return 1.0 if equal else _shared(one, other) / max(1, len(one))


# --- sketches as rows ------------------------------------------------------------


def hash_rows(docs: DataFrame, key: str = "doc_id", scale: int = SCALE) -> DataFrame:
    """Sketches as distinct rows: ``key`` and ``hash``.

    Rows of one key are merged, which is the sketch of their texts together; so a sketch of
    a source or of a whole table comes from ``key`` alone, combined in each task in front of
    the shuffle.  Null and empty texts give no rows.  No group is gathered.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sketch(text or "", scale).astype(np.int64) for text in batch.column(1).to_pylist()]
            owner = np.repeat(np.arange(len(found)), [len(x) for x in found])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(owner)), pa.array(np.concatenate([*found, np.empty(0, np.int64)]))],
                names=["_owner", "hash"],
            )

    kind = docs.schema[key].dataType.simpleString()
    narrow = docs.select(F.col(key).alias("_owner"), F.col("text").alias("_text"))
    hashes = narrow.mapInArrow(rows, f"_owner {kind}, hash long").distinct()
    return hashes.select(F.col("_owner").alias(key), "hash")


def containment(pairs: DataFrame, inner: DataFrame, outer: DataFrame) -> DataFrame:
    """How much of each inner sketch an outer one holds: a, b, n_hashes, n_shared, contained.

    ``pairs`` names distinct (a, b); ``inner`` has (a, hash) and ``outer`` (b, hash), both as
    :func:`hash_rows` gives them, renamed.  An inner sketch without hashes tells nothing and
    gives no row.  The pairs' hashes lead both joins, so a hot sketch can be split.
    """
    asked = pairs.select("a", "b").join(inner.select("a", "hash"), "a")
    held = outer.select("b", "hash", F.lit(1).alias("_held"))
    counted = asked.join(held, ["b", "hash"], "left").groupBy("a", "b").agg(
        F.count(F.lit(1)).alias("n_hashes"), F.count("_held").alias("n_shared")
    )
    return counted.withColumn("contained", F.col("n_shared") / F.col("n_hashes"))


# --- documents and their successors ------------------------------------------------


def with_next(docs: DataFrame) -> DataFrame:
    """Fingerprints of every document, of its edited text, and their likeness.

    The edited text has its last half (rounded down) of code points replaced by as many
    first ones of the next document.  Documents follow each other by doc_id, then, where ids
    repeat, by the text's digest; rows without an id come last; after the last comes the
    first.  Rows that repeat an id and a text are one document with a row each.  Null counts
    as the empty text, whose fingerprint is empty.  Likeness is 1 between equal texts and
    else estimated on the sketches; two sketches without hashes have likeness 0.  Other
    columns are not read.  An empty table gives no rows.

    Columns: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next, and the containments in_edited and in_next.

    Texts are shuffled once, into parts of the order whose bounds come from the keys alone;
    the first document of a part is sent to the part before it as well.  Sketches are made
    where the texts arrive.  A task holds one document and its successor at a time.
    """
    text = empty_if_null("text")
    rows = docs.select(
        F.col("doc_id").isNull().alias("no_id"),
        F.coalesce("doc_id", F.lit(0)).cast("long").alias("id"),
        F.md5(text.cast("binary")).alias("digest"),
        text.alias("text"),
    )
    order = ("no_id", "id", "digest")
    parts = max(1, min(MAX_PARTS, -(-docs.count() // PART_ROWS)))
    keys = rows.select(*order).repartitionByRange(parts, *order).sortWithinPartitions(*order)
    # At most one row a part, so their number is bounded.
    heads = sorted(tuple(row) for row in keys.mapInArrow(_first, keys.schema).collect())
    dealt = rows.mapInArrow(
        _dealt(heads),
        "part int, ahead boolean, no_id boolean, id long, digest string, text string, copies long",
    )
    ordered = dealt.repartition(parts, "part").sortWithinPartitions("part", "ahead", *order)
    return ordered.mapInArrow(
        _edited,
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double, "
        "in_edited double, in_next double",
    )


def _first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first row of a sorted partition."""
    waiting = True
    for batch in batches:
        if waiting and batch.num_rows:
            waiting = False
            yield batch.slice(0, 1)


def _dealt(heads: list[tuple]) -> Callable:
    """Each document to its part, equal ones of a batch once, and heads to the part before."""
    last = len(heads) - 1

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            copies: dict[tuple, list[int]] = {}
            for at, key in enumerate(zip(*(batch.column(i).to_pylist() for i in range(3)))):
                copies.setdefault(key, []).append(at)
            part, ahead, taken, counts = [], [], [], []
            for key, places in copies.items():
                own = bisect_right(heads, key) - 1
                to = [(own, False)]
                if heads[own] == key:
                    to.append((own - 1 if own else last, True))
                for target, early in to:
                    part.append(target)
                    ahead.append(early)
                    taken.append(places[0])
                    counts.append(len(places))
            rows = batch.take(pa.array(taken, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(part, pa.int32()),
                    pa.array(ahead, pa.bool_()),
                    *rows.columns,
                    pa.array(counts, pa.int64()),
                ],
                names=["part", "ahead", *rows.schema.names, "copies"],
            )

    return deal


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted parts: a document is finished when its successor, or the head ahead, arrives."""
    import hashlib

    kinds = [pa.int64(), pa.int64(), *[pa.string()] * 3, *[pa.float64()] * 4]
    names = (
        "doc_id n_chars edited_sha256 fingerprint edited_fingerprint near_edited near_next "
        "in_edited in_next"
    ).split()
    done: list[tuple] = []
    held = 0

    def out() -> pa.RecordBatch:
        columns = list(zip(*done)) or [()] * len(kinds)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    pending = key = None
    for batch in batches:
        columns = [batch.column(i).to_pylist() for i in (0, 1, 2, 3, 4, 6)]
        for at, (part, ahead, no_id, doc_id, digest, copies) in enumerate(zip(*columns)):
            if not ahead and key == (part, no_id, doc_id, digest):
                pending[-1] += copies
                continue
            text = batch.column(5)[at].as_py()
            hashes = sketch(text)
            if pending is not None and key[0] == part:
                _, own, own_digest, kept, repeats = pending
                half = len(own) // 2
                edited = own[: len(own) - half] + text[:half]
                after = kept if edited == own else sketch(edited)
                row = (
                    None if key[1] else key[2],
                    len(own),
                    hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(),
                    written(kept),
                    written(after),
                    likeness(kept, after, edited == own),
                    likeness(kept, hashes, digest == own_digest),
                    contained(kept, after, edited == own),
                    contained(kept, hashes, digest == own_digest),
                )
                size = len(row[3]) + len(row[4]) + 200
                while repeats:
                    some = min(repeats, max(1, (1 << 23) // size))
                    done.extend([row] * some)
                    held += some * size
                    repeats -= some
                    if held >= 1 << 23:
                        yield out()
                        done, held = [], 0
            if ahead:
                pending = key = None
            else:
                key = (part, no_id, doc_id, digest)
                pending = [doc_id, text, digest, hashes, copies]
    if done:
        yield out()
