"""Near-duplicates: universal hash minima, banding, verification, star components.

A document's set holds its distinct five-word shingles as 64-bit hashes.  Documents of
equal sets form one class.  The classes' minima are banded; the members of a bucket are
compared with the bucket's smallest class first, by signature and then on full sets, and
the links joined into components.  Buckets that still hold several components have their
members compared across components, crowded ones where their sets share a rare shingle; so
no link that banding offers between components is lost, and members already joined are not
compared.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.llm.common import bounded, give_back, stored, without_ids, without_repeats
from headway.llm.components import components
from headway.llm.exact_dedup import text_key

SHINGLE_WORDS = 5
PERCENT = 75
# 40 bands of 4 minima miss a pair at a similarity of 0.75 once in four million times.
BANDS, ROWS = 40, 4
# A pair is dropped on its signature alone when the estimate is this far (over 6 standard
# deviations at 160 minima) below the threshold.
MARGIN = 0.22

# Members of a bucket that one task compares with each other, or with as many others.
BLOCK = 1000

# Slots of the histogram that orders shingles from rare to frequent.
SLOTS = 1 << 20

# Pairs of one node that meet one copy of its value.
SPLIT = 500

_MIX = np.uint64(0x9E3779B97F4A7C15)
_POWER = np.uint64(0xD6E8FEB86659FD93)
_CHUNK = 2048


def _coefficients() -> tuple[np.ndarray, np.ndarray]:
    state = np.random.Generator(np.random.PCG64(20_26))
    a, b = state.integers(0, 2**63, (2, BANDS * ROWS, 1), dtype=np.uint64)
    return a * np.uint64(2) + np.uint64(1), b


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _MIX
    x = (x ^ (x >> np.uint64(29))) * _POWER
    return x ^ (x >> np.uint64(32))


def shingle_set(text: bytes) -> np.ndarray:
    """Sorted distinct hashes of the five-word shingles of UTF-8 text."""
    words = text.lower().split()  # of bytes: ASCII letters and ASCII white space only
    if not words:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    size = min(len(words), SHINGLE_WORDS)
    count = len(words) - size + 1
    rolled = np.full(count, size, np.uint64)
    for i in range(size):
        rolled = rolled * _POWER + hashes[i : i + count]
    return np.unique(_mixed(rolled))


def signature(shingles: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Minima of many multiply-add-shift hashes, 32 bits each."""
    least = np.full(len(a), np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(shingles), _CHUNK):
        np.minimum(least, (a * shingles[start : start + _CHUNK] + b).min(axis=1), out=least)
    return (least >> np.uint64(32)).astype(np.uint32)


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    a, b = _coefficients()
    for batch in batches:
        sizes, high, low, signatures = [], [], [], []
        for text in batch.column(1):
            shingles = shingle_set(text.as_py() or b"")
            digest = xxhash.xxh3_128_intdigest(shingles.tobytes())
            sizes.append(len(shingles))
            high.append((digest >> 64) - (1 << 63))
            low.append((digest & (2**64 - 1)) - (1 << 63))
            signatures.append(signature(shingles, a, b).tobytes() if len(shingles) else None)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array(sizes, pa.int64()),
                pa.array(high, pa.int64()),
                pa.array(low, pa.int64()),
                pa.array(signatures, pa.binary()),
            ],
            names=["doc_id", "n_shingles", "high", "low", "signature"],
        )
    give_back()


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [shingle_set(text.as_py() or b"").tobytes() for text in batch.column(1)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(found, pa.binary())], names=["node", "shingles"]
        )
    give_back()


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    salt = _mixed(np.arange(1, BANDS + 1, dtype=np.uint64))
    for batch in batches:
        nodes = batch.column(0).to_numpy(zero_copy_only=False)
        if not len(nodes):
            continue
        minima = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint32)
        minima = minima.reshape(len(nodes), BANDS, ROWS).astype(np.uint64)
        keys = np.broadcast_to(salt, (len(nodes), BANDS))
        for i in range(ROWS):
            keys = _mixed(keys * _POWER + minima[:, :, i])
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys.ravel().astype(np.int64)), pa.array(np.repeat(nodes, BANDS))],
            names=["bucket", "node"],
        )


def _alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose signatures do not rule out the threshold."""
    least = (PERCENT / 100 - MARGIN) * BANDS * ROWS
    for batch in batches:
        keep = [
            (np.frombuffer(x.as_py(), np.uint32) == np.frombuffer(y.as_py(), np.uint32)).sum() >= least
            for x, y in zip(batch.column(2), batch.column(3))
        ]
        yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs at or above the threshold on full sets."""
    for batch in batches:
        keep = []
        for x, y in zip(batch.column(2), batch.column(3)):
            first, second = (np.frombuffer(v.as_py(), np.uint64) for v in (x, y))
            common = len(np.intersect1d(first, second, assume_unique=True))
            keep.append(100 * common >= PERCENT * (len(first) + len(second) - common))
        yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))


def _with_both(pairs: DataFrame, values: DataFrame, name: str) -> DataFrame:
    """Pairs (a, b) with the value of either node.

    Many nodes pair with the first of their bucket, so a hot ``b`` is dealt over as many
    copies of its value as it has SPLIT pairs.
    """
    hot = stored(
        pairs.groupBy("b").agg(F.ceil(F.count(F.lit(1)) / SPLIT).alias("_deal")).where("_deal > 1"),
        "near-hot",
    )
    hot = bounded(hot)  # one row for SPLIT pairs
    dealt = pairs.join(hot, "b", "left").select(
        "a", "b", F.coalesce(F.expr("pmod(xxhash64(a), _deal)"), F.lit(0)).alias("_at")
    )
    first = values.select(F.col("node").alias("a"), F.col(name).alias("_a"))
    copies = F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("_deal", F.lit(1)) - 1))
    second = values.select(F.col("node").alias("b"), F.col(name).alias("_b"))
    second = second.join(hot, "b", "left").select("b", "_b", copies.alias("_at"))
    return dealt.join(first, "a").join(second, ["b", "_at"]).select("a", "b", "_a", "_b")


def _confirmed(pairs: DataFrame, sketches: DataFrame, texts: DataFrame, label: str) -> DataFrame:
    """The linked ones of the distinct pairs (a, b)."""
    pair = "a long, b long"
    alike = stored(
        _with_both(pairs, sketches, "signature").mapInArrow(_alike, pair), f"{label}-alike"
    )
    wanted = stored(
        alike.select(F.col("a").alias("doc_id"))
        .unionByName(alike.select(F.col("b").alias("doc_id")))
        .distinct(),
        f"{label}-wanted",
    )
    sets = _sets_of(texts, wanted, f"{label}-sets")
    return stored(
        _with_both(alike, sets, "shingles").mapInArrow(_linked, pair), f"{label}-links"
    )


def _sets_of(texts: DataFrame, wanted: DataFrame, label: str) -> DataFrame:
    """Full sets of the wanted documents."""
    found = texts.join(bounded(wanted), "doc_id", "left_semi")
    sets = stored(found.mapInArrow(_sets, "node long, shingles binary"), label)
    return sets.dropDuplicates(["node"])


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept.

    Null, empty and blank texts have an empty set and are linked with nothing; texts of
    fewer than five words are one shingle.  Rows that repeat one doc_id and text are one
    document.  A null doc_id is its own component and stays.  Other columns are not read.
    An empty table gives no rows.
    """
    texts = docs.select("doc_id", F.col("text").cast("binary").alias("_text"))
    sketched = stored(
        texts.mapInArrow(
            _sketches, "doc_id long, n_shingles long, high long, low long, signature binary"
        ),
        "near-sketches",
    )
    classes = (
        sketched.where("n_shingles > 0").groupBy("high", "low").agg(F.min("doc_id").alias("node"))
    )
    members = stored(
        sketched.join(classes, ["high", "low"], "left").select(
            "doc_id",
            "n_shingles",
            "node",
            F.when(F.col("doc_id") == F.col("node"), F.col("signature")).alias("signature"),
        ),
        "near-members",
    )
    sketches = members.where("signature is not null").select("node", "signature")
    bands = sketches.mapInArrow(_bands, "bucket long, node long")

    buckets = stored(
        bands.groupBy("bucket")
        .agg(F.min("node").alias("first"), F.max("node").alias("last"))
        .where("first < last")
        .select("bucket", "first"),
        "near-buckets",
    )
    crowded = stored(bands.join(bounded(buckets), "bucket"), "near-crowded")
    tried = stored(
        crowded.where("node <> first")
        .select(F.col("node").alias("a"), F.col("first").alias("b"))
        .distinct(),
        "near-first-pairs",
    )
    links = _confirmed(tried, sketches, texts, "near-first")
    joined = stored(components(links), "near-first-components")
    links = links.unionByName(_across(crowded, joined, sketches, texts))
    joined = stored(components(links), "near-components")

    found = members.select("doc_id", "n_shingles", "node").join(joined, "node", "left")
    component = F.coalesce("component", "node", "doc_id")
    return found.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"),
    )


def _across(crowded: DataFrame, joined: DataFrame, sketches: DataFrame, texts: DataFrame) -> DataFrame:
    """Links of nodes that share a bucket and lie in different components so far.

    The members of such a bucket are compared with each other, or with those outside of its
    largest component, if either are up to BLOCK.  Members of other buckets meet at the
    shingles of their prefixes instead (``_meetings``).
    """
    placed = crowded.select("bucket", "node").join(joined, "node", "left").withColumn(
        "component", F.coalesce("component", "node")
    )
    rest = stored(placed.join(_mixed_buckets(placed), "bucket"), "near-mixed")
    few = _links_within(rest.where("outer = 1"), sketches, texts, "near-mixed")
    crowd = stored(
        rest.where("outer > 1").select(F.col("node").alias("doc_id"), "component").distinct(),
        "near-crowd",
    )
    if crowd.isEmpty():
        return few
    sets = _sets_of(texts, crowd.select("doc_id"), "near-crowd-sets")
    meetings = _meetings(sets, crowd)
    many = _links_within(meetings, sketches, texts, "near-meetings")
    return few.unionByName(many)


def _mixed_buckets(placed: DataFrame) -> DataFrame:
    """Buckets with members of several components, and in how many blocks they are compared.

    A bucket of up to BLOCK members is one outer block.  In a larger one the members of its
    largest component are inner blocks, which need not be compared with each other; so a
    large group of near copies is dealt once for each outer block of the others.
    """
    parts = placed.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("n"))
    whole = parts.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("parts"),
        F.sum("n").alias("all"),
        F.max(F.struct("n", "component")).alias("top"),
    )
    large = F.col("all") > BLOCK
    return whole.where("parts > 1").select(
        "bucket",
        F.when(large, F.col("top.component")).alias("largest"),
        F.when(large, F.ceil((F.col("all") - F.col("top.n")) / BLOCK)).otherwise(1).alias("outer"),
        F.when(large, F.ceil(F.col("top.n") / BLOCK)).otherwise(0).alias("inner"),
    )


def _meetings(sets: DataFrame, crowd: DataFrame) -> DataFrame:
    """Members of crowded buckets by the shingles at which a linked pair has to meet.

    With shingles in one order for all sets, a linked pair shares a shingle among the first
    seventh of its smaller set and the first quarter of its larger one, so no link is lost.
    Rare shingles come first; so documents that have only a template in common, which is
    frequent, do not meet.  The order is that of a histogram of fixed size, whatever the input.
    """
    counted = sets.mapInArrow(_slots, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n"))
    found = counted.toArrow()  # at most SLOTS rows
    counts = np.zeros(SLOTS, np.uint32)
    counts[found.column("slot").to_numpy()] = np.minimum(found.column("n").to_numpy(), 2**32 - 1)
    placed = sets.join(crowd.select(F.col("doc_id").alias("node"), "component"), "node")
    prefixes = stored(
        placed.select("node", "component", "shingles").mapInArrow(
            _prefixes(counts), "bucket long, node long, component long, size long, indexed boolean"
        ),
        "near-prefixes",
    )
    open_ = prefixes.groupBy("bucket").agg(F.max("indexed").alias("any")).where("any").select("bucket")
    shared = stored(_mixed_buckets(prefixes).join(open_, "bucket"), "near-shared")
    return stored(prefixes.join(bounded(shared), "bucket"), "near-meetings")


def _slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(SLOTS, np.int64)
    for batch in batches:
        hashes = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint64)
        counts += np.bincount((hashes % SLOTS).astype(np.int64), minlength=SLOTS)
    slots = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(slots), pa.array(counts[slots])], names=["slot", "n"])


def _prefixes(counts: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            firsts, lengths, sizes, indexed = [np.empty(0, np.uint64)], [], [], [np.empty(0, bool)]
            for shingles in batch.column(2):
                hashes = np.frombuffer(shingles.as_py(), np.uint64)
                size = len(hashes)
                length = size - -(-PERCENT * size // 100) + 1
                smaller = size - -(-2 * PERCENT * size // (100 + PERCENT)) + 1
                order = np.lexsort((hashes, counts[(hashes % SLOTS).astype(np.int64)]))
                firsts.append(hashes[order[:length]])
                lengths.append(length)
                sizes.append(size)
                indexed.append(np.arange(length) < smaller)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate(firsts).view(np.int64)),
                    pa.array(np.repeat(batch.column(0).to_numpy(), lengths)),
                    pa.array(np.repeat(batch.column(1).to_numpy(), lengths)),
                    pa.array(np.repeat(np.array(sizes, np.int64), lengths)),
                    pa.array(np.concatenate(indexed)),
                ],
                names=["bucket", "node", "component", "size", "indexed"],
            )

    return prefixes


def _links_within(rest: DataFrame, sketches: DataFrame, texts: DataFrame, label: str) -> DataFrame:
    """Links across components within the buckets of ``rest``, in blocks dealt over block pairs.

    Signatures are dealt first and say which nodes have a pair that may be a link; the sets of
    these alone are dealt again, and only links leave a task.
    """
    inside = F.col("component").eqNullSafe(F.col("largest"))
    own = F.when(inside, F.expr("outer + pmod(xxhash64(node), inner)"))
    last = F.col("outer") + F.when(inside, F.lit(0)).otherwise(F.col("inner")) - 1
    dealt = (
        rest.join(sketches, "node")
        .withColumn("own", own.otherwise(F.expr("pmod(xxhash64(node), outer)")))
        .withColumn("_other", F.explode(F.sequence(F.lit(0).cast("long"), last)))
        .withColumn("one", F.least("own", "_other"))
        .withColumn("two", F.greatest("own", "_other"))
        .drop("_other", "largest", "outer", "inner")
    )
    promising = stored(
        dealt.groupBy("bucket", "one", "two").applyInArrow(_promising, dealt.schema),
        f"{label}-promising",
    )
    wanted = stored(promising.select(F.col("node").alias("doc_id")).distinct(), f"{label}-wanted")
    sets = _sets_of(texts, wanted, f"{label}-sets")
    found = (
        promising.join(sets, "node").groupBy("bucket", "one", "two").applyInArrow(_block, "a long, b long")
    )
    return stored(found.distinct(), f"{label}-links")


def _candidates(group: pa.Table) -> Iterator[tuple[int, np.ndarray]]:
    """Pairs across components, within a block or between the two, whose signatures allow a link."""
    nodes = group.num_rows
    places = group.column("component").to_numpy()
    own = group.column("own").to_numpy()
    between = group.column("one")[0].as_py() != group.column("two")[0].as_py()
    minima = np.stack([np.frombuffer(x.as_py(), np.uint32) for x in group.column("signature")])
    belongs = _by_prefix(group) if "indexed" in group.column_names else _by_band(minima)
    least = (PERCENT / 100 - MARGIN) * BANDS * ROWS
    for i in range(nodes - 1):
        later = np.arange(i + 1, nodes)
        later = later[places[later] != places[i]]
        if between:
            later = later[own[later] != own[i]]
        later = later[(minima[later] == minima[i]).sum(axis=1) >= least]
        later = belongs(i, later)
        if len(later):
            yield i, later


def _by_band(minima: np.ndarray) -> Callable[[int, np.ndarray], np.ndarray]:
    """A pair belongs to the first band in which it agrees, so it is verified in one bucket."""
    bands = minima.reshape(len(minima), BANDS, ROWS)
    band = int((bands == bands[:1]).all(axis=(0, 2)).argmax())
    return lambda i, later: later[(bands[later] == bands[i]).all(axis=2).argmax(axis=1) == band]


def _by_prefix(group: pa.Table) -> Callable[[int, np.ndarray], np.ndarray]:
    """A pair meets where the shingle is among the first seventh of its smaller set."""
    sizes = group.column("size").to_numpy()
    indexed = group.column("indexed").to_numpy()

    def belongs(i: int, later: np.ndarray) -> np.ndarray:
        met = np.where(sizes[later] < sizes[i], indexed[later], indexed[i])
        small, large = np.minimum(sizes[later], sizes[i]), np.maximum(sizes[later], sizes[i])
        return later[met & (100 * small >= PERCENT * large)]

    return belongs


def _promising(group: pa.Table) -> pa.Table:
    """The rows of a block pair that are part of any candidate."""
    kept = np.zeros(group.num_rows, bool)
    for i, later in _candidates(group):
        kept[i] = True
        kept[later] = True
    return group.filter(pa.array(kept))


def _block(group: pa.Table) -> pa.Table:
    """Links among the candidates of a block pair, on full sets."""
    nodes = group.column("node").to_numpy()
    sets = [np.frombuffer(x.as_py(), np.uint64) for x in group.column("shingles")]
    sizes = np.array([len(x) for x in sets])
    links = []
    for i, later in _candidates(group):
        shared = _common(sets[i], [sets[k] for k in later])
        hit = later[100 * shared >= PERCENT * (sizes[later] + sizes[i] - shared)]
        links.extend((nodes[i], nodes[k]) for k in hit)
    return pa.table(
        {name: pa.array([x[k] for x in links], pa.int64()) for k, name in enumerate("ab")}
    )


def _common(one: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of a sorted set with others."""
    values = np.concatenate(others)
    at = np.minimum(np.searchsorted(one, values), len(one) - 1)
    ends = np.cumsum([len(x) for x in others])
    return np.diff(np.r_[0, np.cumsum(one[at] == values)[ends - 1]])


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, one document of each component, with all columns.

    Of rows that repeat one doc_id (or none) and text, white space aside, one stays.  Other
    columns may have any name and come back unchanged.  An empty table gives no rows.
    """
    dropped = near_duplicates(docs).where(~F.col("kept")).select("doc_id")
    left = without_ids(docs, stored(dropped, "near-dropped"))
    again = (
        left.groupBy(F.col("doc_id").alias("id"), text_key().alias("of"))
        .agg(F.count(F.lit(1)).alias("n"))
        .where("n > 1")
    )
    return without_repeats(left, stored(again.select("id", "of"), "near-repeats"), text_key())
