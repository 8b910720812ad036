"""A trie of rebuilt conversations, from fingerprints that compose.

A rebuilt conversation is the first turns of a base conversation followed by its own later
turns.  The fingerprint of a sequence of turns is a product in a monoid, x -> x * B + turn
modulo a prime, so the product of a head and the product of a suffix compose to that of the
rebuilt sequence, and no rebuilt text exists anywhere.  Equal products are proved: all
members of a prefix group must refer to one last turn and to one parent group, and turns
that share a key are compared as texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from headway.llm.common import WORD, bounded, empty_if_null, stored
from headway.llm.ordered import placed

# Turns of one conversation that a task scans or sums in one go.
BLOCK = 4096
# Bytes of joined ids handed on at once.
CHUNK = 1 << 16

# Primes to take the products by, in the order they are tried.
PRIMES = tuple((1 << bits) - 1 for bits in (127, 127, 127))

_LOW = (1 << 64) - 1
_NODE = ("depth", "f1", "f2")
_EMPTY = hashlib.sha256(b"").hexdigest()


def base_of(conv_id: Column) -> Column:
    """The conversation that lends its head: the last one divisible by 20."""
    return conv_id - F.pmod(conv_id, F.lit(20))


def head_of(conv_id: Column) -> Column:
    """How many turns the base lends."""
    return F.crc32(conv_id.cast("string")) % 4


def strong_key(role: Column, text: Column) -> Column:
    """SHA-256 of role and text, in hexadecimal digits."""
    return F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)


# --- turns ------------------------------------------------------------------------


def _halves(key: Column) -> list[Column]:
    """The first 128 bits of a key as two longs."""
    return [
        F.conv(F.substr(key, F.lit(1 + 16 * i), F.lit(16)), 16, -10).cast("long").alias(f"k{i + 1}")
        for i in range(2)
    ]


def turn_references(conversations: DataFrame, key_of: Callable = strong_key) -> DataFrame:
    """Turns as references: conv_id, turn, k1, k2, words; equal (role, text) have equal keys.

    Turns that share a key are compared as texts, one a task and key; where a key stands for
    several texts, each of these gets a key of its own.
    """
    role, text = empty_if_null("role"), empty_if_null("text")
    turns = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        role.alias("role"),
        text.alias("text"),
        key_of(role, text).alias("key"),
    )
    words = F.regexp_count("text", F.lit(WORD)).cast("long").alias("words")
    plain = ("conv_id", "turn", *_halves(F.col("key")), words)
    found = stored(turns.select(*plain), "trie-turns")
    again = stored(
        found.groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("k1", "k2"),
        "trie-again",
    )
    both = turns.select("*", *_halves(F.col("key")))
    said = F.struct("role", "text")
    mixed = stored(
        both.join(bounded(again), ["k1", "k2"], "left_semi")
        .groupBy("k1", "k2")
        .agg(F.min(said).alias("least"), F.max(said).alias("most"))
        .where("least <> most")
        .select("k1", "k2"),
        "trie-mixed",
    )
    if mixed.isEmpty():
        return found
    texts = both.join(bounded(mixed), ["k1", "k2"], "left_semi").select("k1", "k2", "role", "text").distinct()
    rank = F.row_number().over(Window.partitionBy("k1", "k2").orderBy("role", "text"))
    own = stored(
        texts.withColumn("_rank", rank).withColumn(
            "_key", F.sha2(F.concat_ws("/", "k1", "k2", "_rank", F.sha2("text", 256)), 256)
        ),
        "trie-own",
    ).drop("_rank")
    split = both.join(own, ["k1", "k2", "role", "text"], "left")
    key = F.coalesce("_key", "key")
    return stored(split.select("conv_id", "turn", *_halves(key), words), "trie-turns")


# --- products ---------------------------------------------------------------------


def _multiplier(attempt: int, prime: int) -> int:
    return int.from_bytes(hashlib.sha256(b"turns %d" % attempt).digest()) % (prime - 3) + 2


def _signed(values: list[int]) -> tuple[pa.Array, pa.Array]:
    """128-bit numbers as two columns of longs."""
    high = np.array([v >> 64 for v in values], np.uint64)
    low = np.array([v & _LOW for v in values], np.uint64)
    return pa.array(high.view(np.int64)), pa.array(low.view(np.int64))


def _whole(batch: pa.RecordBatch, high: str, low: str) -> list[int | None]:
    one, two = batch.column(high).to_pylist(), batch.column(low).to_pylist()
    return [None if a is None else ((a & _LOW) << 64) | (b & _LOW) for a, b in zip(one, two)]


_SCANNED = (
    "conv_id long, pos long, k1 long, k2 long, words long, head long, block long, "
    "h1 long, h2 long, s1 long, s2 long"
)


def _scanned(prime: int, multiplier: int) -> Callable:
    """Products of the turns from the block's start, and of those among them after the head."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = None
        whole = suffix = 0
        for batch in batches:
            owners = list(zip(batch.column("conv_id").to_pylist(), batch.column("block").to_pylist()))
            places, heads = batch.column("pos").to_pylist(), batch.column("head").to_pylist()
            all_of, after = [], []
            for owner, turn, pos, head in zip(owners, _whole(batch, "k1", "k2"), places, heads):
                if owner != own:
                    own, whole, suffix = owner, 0, 0
                whole = (whole * multiplier + turn) % prime
                if pos > head:
                    suffix = (suffix * multiplier + turn) % prime
                all_of.append(whole)
                after.append(suffix)
            columns = [*batch.columns, *_signed(all_of), *_signed(after)]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "h1", "h2", "s1", "s2"])

    return scan


def _carried(prime: int, multiplier: int, block: int) -> Callable:
    """Products of all blocks in front of one, from the last turn of every full block."""

    def carry(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        power = pow(multiplier, block, prime)
        own = None
        whole = suffix = 0
        for batch in batches:
            all_of, after = [], []
            rows = zip(
                batch.column("conv_id").to_pylist(),
                batch.column("pos").to_pylist(),
                batch.column("head").to_pylist(),
                _whole(batch, "h1", "h2"),
                _whole(batch, "s1", "s2"),
            )
            for conv_id, pos, head, one, two in rows:
                if conv_id != own:
                    own, whole, suffix = conv_id, 0, 0
                whole = (whole * power + one) % prime
                count = min(block, max(0, pos - head))
                suffix = (suffix * pow(multiplier, count, prime) + two) % prime
                all_of.append(whole)
                after.append(suffix)
            following = pa.array([b + 1 for b in batch.column("block").to_pylist()], pa.int64())
            columns = [batch.column("conv_id"), following, *_signed(all_of), *_signed(after)]
            yield pa.RecordBatch.from_arrays(columns, names=["conv_id", "block", "c1", "c2", "d1", "d2"])

    return carry


def _joined(prime: int, multiplier: int, block: int) -> Callable:
    """Products from the conversation's start: carried ones composed with the block's."""

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places, heads = batch.column("pos").to_pylist(), batch.column("head").to_pylist()
            all_of, after = [], []
            for pos, head, one, two, before, suffix in zip(
                places,
                heads,
                _whole(batch, "h1", "h2"),
                _whole(batch, "s1", "s2"),
                _whole(batch, "c1", "c2"),
                _whole(batch, "d1", "d2"),
            ):
                if before is not None:
                    count = (pos - 1) % block + 1
                    one = (before * pow(multiplier, count, prime) + one) % prime
                    two = (suffix * pow(multiplier, min(count, max(0, pos - head)), prime) + two) % prime
                all_of.append(one)
                after.append(two)
            kept = batch.select(["conv_id", "pos", "k1", "k2", "words", "head"])
            columns = [*kept.columns, *_signed(all_of), *_signed(after)]
            yield pa.RecordBatch.from_arrays(columns, names=[*kept.schema.names, "h1", "h2", "s1", "s2"])

    return join


_PRODUCTS = "conv_id long, pos long, k1 long, k2 long, words long, head long, h1 long, h2 long, s1 long, s2 long"


def products(turns: DataFrame, prime: int, multiplier: int) -> DataFrame:
    """Products up to every turn (h1, h2), and of the turns after the head (s1, s2).

    ``turns``: conv_id, pos, k1, k2, words, head.  A conversation is scanned in blocks; the
    blocks of a longer one are composed from one product each.
    """
    block = F.expr(f"(pos - 1) div {BLOCK}").alias("block")
    blocked = turns.select("conv_id", "pos", "k1", "k2", "words", "head", block)
    sorted_ = blocked.repartition("conv_id", "block").sortWithinPartitions("conv_id", "block", "pos")
    scanned = sorted_.mapInArrow(_scanned(prime, multiplier), _SCANNED)
    names = [name.split()[0] for name in _PRODUCTS.split(", ")]
    if (turns.agg(F.max("pos")).first()[0] or 0) <= BLOCK:
        return scanned.select(*names)
    scanned = stored(scanned, "trie-scanned")
    full = scanned.where(f"pos % {BLOCK} = 0").select("conv_id", "pos", "head", "block", "h1", "h2", "s1", "s2")
    carried = full.repartition("conv_id").sortWithinPartitions("conv_id", "block").mapInArrow(
        _carried(prime, multiplier, BLOCK), "conv_id long, block long, c1 long, c2 long, d1 long, d2 long"
    )
    long_ones = bounded(stored(carried, "trie-carried"))
    return scanned.join(long_ones, ["conv_id", "block"], "left").mapInArrow(
        _joined(prime, multiplier, BLOCK), _PRODUCTS
    )


def _composed(prime: int, multiplier: int) -> Callable:
    """Fingerprints of prefixes and of their parents: head product, own product, last turn."""
    back = pow(multiplier, -1, prime)

    def compose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, above = [], []
            for head, count, suffix, turn in zip(
                _whole(batch, "t1", "t2"),
                batch.column("count").to_pylist(),
                _whole(batch, "s1", "s2"),
                _whole(batch, "k1", "k2"),
            ):
                value = suffix if head is None else (head * pow(multiplier, count, prime) + suffix) % prime
                own.append(value)
                above.append((value - turn) * back % prime)
            kept = batch.select(["conv_id", "depth", "k1", "k2", "words", "last"])
            columns = [*kept.columns, *_signed(own), *_signed(above)]
            yield pa.RecordBatch.from_arrays(columns, names=[*kept.schema.names, "f1", "f2", "p1", "p2"])

    return compose


def members(turns: DataFrame, base: Column, prime: int, multiplier: int) -> tuple[DataFrame, DataFrame]:
    """The prefixes of every rebuilt conversation, and the conversations.

    One row per rebuilt conversation and depth from 1: conv_id, depth, its fingerprint
    (f1, f2), its parent's (p1, p2), its last turn (k1, k2, words), and whether it is whole.
    """
    found = stored(products(turns, prime, multiplier), "trie-products")
    sizes = found.groupBy("conv_id").agg(F.max("pos").alias("n"), F.max("head").alias("head"))
    sizes = sizes.withColumn("base", base)
    lenders = sizes.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
    plan = sizes.join(lenders, "base", "left").withColumn(
        "top", F.least("head", F.coalesce("base_n", F.lit(0)))
    )
    plan = plan.withColumn("size", F.col("top") + F.greatest(F.lit(0), F.col("n") - F.col("head")))
    plan = stored(plan.select("conv_id", "head", "base", "top", "size"), "trie-plan")
    most = plan.agg(F.max("top")).first()[0] or 0
    lent = found.where(F.col("pos") <= most).select(
        F.col("conv_id").alias("base"), "pos", "k1", "k2", "words", "h1", "h2"
    )
    heads = stored(plan.where("top > 0").join(lent, "base").where("pos <= top"), "trie-heads")
    tops = heads.where("pos = top").select("conv_id", F.col("h1").alias("t1"), F.col("h2").alias("t2"))
    from_base = heads.select(
        "conv_id",
        F.col("pos").alias("depth"),
        "k1",
        "k2",
        "words",
        (F.col("pos") == F.col("size")).alias("last"),
        F.lit(None).cast("long").alias("t1"),
        F.lit(None).cast("long").alias("t2"),
        F.lit(0).cast("long").alias("count"),
        F.col("h1").alias("s1"),
        F.col("h2").alias("s2"),
    )
    count = F.col("pos") - F.col("head")
    depth = F.col("top") + count
    own = (
        found.where("pos > head")
        .drop("h1", "h2", "head")
        .join(plan.join(tops, "conv_id", "left"), "conv_id")
        .select(
            "conv_id",
            depth.alias("depth"),
            "k1",
            "k2",
            "words",
            (depth == F.col("size")).alias("last"),
            "t1",
            "t2",
            count.alias("count"),
            "s1",
            "s2",
        )
    )
    composed = from_base.unionByName(own).mapInArrow(
        _composed(prime, multiplier),
        "conv_id long, depth long, k1 long, k2 long, words long, last boolean, "
        "f1 long, f2 long, p1 long, p2 long",
    )
    return stored(composed, "trie-members"), plan


# --- the trie -----------------------------------------------------------------------


def prefix_trie(
    conversations: DataFrame,
    base: Callable[[Column], Column] = base_of,
    head: Callable[[Column], Column] = head_of,
    key_of: Callable = strong_key,
) -> DataFrame:
    """The nodes of the trie of rebuilt conversations.

    ``conversations``: conv_id, turn, role, text.  ``base`` and ``head`` say, from a conv_id,
    which conversation lends its first turns and how many; the rest are the conversation's
    own turns after as many.  Turns are in the order of turn (null first), rows of one turn
    in that of the key of role and text; repeated rows stay.  Null role and text count as
    empty.  Rows without conv_id belong to no conversation and are left out, as an id is
    what a base and a head follow from.  Other columns are not read.  An empty table gives
    no rows, not even a root.

    Columns: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256.

    Nothing gathers a node's members, a conversation or a rebuilt text: aggregates combine in
    each task first, a conversation is scanned in blocks, and the digest of many ids streams
    chunks joined beforehand.
    """
    references = turn_references(conversations, key_of)
    turns = placed(references, "conv_id", ("turn", "k1", "k2"), "trie-placed")
    turns = turns.drop("turn").withColumn("head", head(F.col("conv_id")).cast("long"))
    turns = stored(turns, "trie-order")
    for attempt, prime in enumerate(PRIMES):
        rows, plan = members(turns, base(F.col("conv_id")), prime, _multiplier(attempt, prime))
        groups = stored(_groups(rows), "trie-groups")
        # By induction over the depth, this proves that a group has one sequence of turns.
        if groups.where("p1 <> q1 OR p2 <> q2 OR k1 <> l1 OR k2 <> l2").isEmpty():
            return _nodes(rows, plan, groups)
    raise ArithmeticError("different prefixes keep sharing fingerprints")


def _groups(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*_NODE).agg(
        F.min("conv_id").alias("conv_id"),
        F.count(F.lit(1)).alias("n_convs"),
        F.max("words").alias("words"),
        *(F.min(name).alias(name) for name in ("p1", "p2", "k1", "k2")),
        *(F.max(a).alias(b) for a, b in (("p1", "q1"), ("p2", "q2"), ("k1", "l1"), ("k2", "l2"))),
    )


def _nodes(rows: DataFrame, plan: DataFrame, groups: DataFrame) -> DataFrame:
    zero = F.lit(0).cast("long")
    root = plan.agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), zero.alias("words")
    ).where("n_convs > 0")
    root = root.select(zero.alias("depth"), zero.alias("f1"), zero.alias("f2"), "*")
    kept = groups.select(*_NODE, "conv_id", "n_convs", "words", "p1", "p2")
    above = (F.col("depth") - 1).alias("depth")
    kids = kept.select(above, F.col("p1").alias("f1"), F.col("p2").alias("f2")).groupBy(*_NODE)
    every = kept.unionByName(root, allowMissingColumns=True)
    nodes = every.join(kids.agg(F.count(F.lit(1)).alias("n_children")), list(_NODE), "left")
    nodes = nodes.withColumns(
        {
            "n_children": F.coalesce("n_children", zero),
            "saved": (F.col("n_convs") - 1) * F.col("words"),
        }
    )
    nodes = nodes.withColumn("leaf", (F.col("n_children") == 0).cast("long"))
    nodes = stored(nodes.drop("words"), "trie-nodes")

    sums = _subtree_sums(rows, nodes)
    totals = nodes.agg(F.sum("leaf").alias("n_leaves"), F.sum("saved").alias("saved_tokens")).select(
        zero.alias("depth"), zero.alias("f1"), zero.alias("f2"), "n_leaves", "saved_tokens"
    )
    whole = rows.where("last").select(*_NODE, "conv_id")
    turnless = plan.where("size = 0").select(zero.alias("depth"), zero.alias("f1"), zero.alias("f2"), "conv_id")
    digests = _digests(whole.unionByName(turnless))
    parents = nodes.select(
        F.col("depth").alias("_depth"),
        F.col("f1").alias("p1"),
        F.col("f2").alias("p2"),
        F.col("conv_id").alias("parent_conv_id"),
    )
    return (
        nodes.withColumn("_depth", F.col("depth") - 1)
        .join(parents, ["_depth", "p1", "p2"], "left")
        .join(sums.unionByName(totals), list(_NODE))
        .join(digests, list(_NODE), "left")
        .select(
            "conv_id",
            "depth",
            "parent_conv_id",
            "n_convs",
            "n_children",
            "n_leaves",
            "saved_tokens",
            F.coalesce("ends_sha256", F.lit(_EMPTY)).alias("ends_sha256"),
        )
    )


def _subtree_sums(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """Leaves and saved tokens of all subtrees but the root's.

    Each node counts at its smallest member, at its own depth.  Along one conversation the
    sum of what counts from a depth on is its share in the subtree of its prefix there; the
    shares of a prefix's members add up to the subtree, each node counted once.
    """
    own = nodes.where("depth > 0").select("conv_id", "depth", "leaf", "saved")
    path = rows.select("conv_id", *_NODE).join(own, ["conv_id", "depth"], "left")
    path = path.withColumn("block", F.expr(f"depth div {BLOCK}")).fillna(0, ["leaf", "saved"])
    down = Window.partitionBy("conv_id", "block").orderBy(F.desc("depth"))
    shares = path.select(
        *_NODE, "conv_id", "block", F.sum("leaf").over(down).alias("leaf"), F.sum("saved").over(down).alias("saved")
    )
    if (rows.agg(F.max("depth")).first()[0] or 0) >= BLOCK:
        # From the top row of each block of the conversations that have several.
        deep = bounded(stored(rows.where(f"depth = {BLOCK}").select("conv_id"), "trie-deep"))
        blocks = path.join(deep, "conv_id", "left_semi").groupBy("conv_id", "block")
        later = Window.partitionBy("conv_id").orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
        below = blocks.agg(F.sum("leaf").alias("leaf"), F.sum("saved").alias("saved")).select(
            "conv_id", "block", F.sum("leaf").over(later).alias("_leaf"), F.sum("saved").over(later).alias("_saved")
        )
        below = bounded(stored(below, "trie-below"))
        shares = shares.join(below, ["conv_id", "block"], "left").fillna(0, ["_leaf", "_saved"])
        shares = shares.select(
            *_NODE, (F.col("leaf") + F.col("_leaf")).alias("leaf"), (F.col("saved") + F.col("_saved")).alias("saved")
        )
    return shares.groupBy(*_NODE).agg(F.sum("leaf").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))


def _digests(ends: DataFrame) -> DataFrame:
    """SHA-256 of each node's sorted ids; ranges are joined to chunks, chunks digested in order."""
    ranged = ends.repartitionByRange(*_NODE, "conv_id").sortWithinPartitions(*_NODE, "conv_id")
    node = "depth long, f1 long, f2 long"
    chunks = ranged.mapInArrow(_chunks, f"{node}, first long, ids string")
    together = chunks.repartition(*_NODE).sortWithinPartitions(*_NODE, "first")
    return together.mapInArrow(_digested, f"{node}, ends_sha256 string")


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    own, held, size, done = None, [], 0, []

    def close() -> None:
        if held:
            done.append((*own, held[0], ",".join(map(str, held))))

    for batch in batches:
        for *node, conv_id in zip(*(column.to_pylist() for column in batch.columns)):
            if node != own or size >= CHUNK:
                close()
                own, held, size = node, [], 0
            held.append(conv_id)
            size += 8
        yield _batch(done, "first", "ids")
        done = []
    close()
    yield _batch(done, "first", "ids")


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    own, digest, done = None, None, []
    for batch in batches:
        for *node, _, ids in zip(*(column.to_pylist() for column in batch.columns)):
            if node == own:
                digest.update(b"," + ids.encode())
            else:
                if own is not None:
                    done.append((*own, digest.hexdigest()))
                own, digest = node, hashlib.sha256(ids.encode())
        yield _batch(done, "ends_sha256")
        done = []
    if own is not None:
        yield _batch([(*own, digest.hexdigest())], "ends_sha256")


def _batch(rows: list[tuple], *more: str) -> pa.RecordBatch:
    names = [*_NODE, *more]
    kinds = [pa.string() if name in ("ids", "ends_sha256") else pa.int64() for name in names]
    columns = list(zip(*rows)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)


# CRC-32 of an id's digits, half a byte a step.
_TABLE = """[0, 498536548, 997073096, 651767980, 1994146192, 1802195444, 1303535960, 1342533948,
  3988292384, 4027552580, 3604390888, 3412177804, 2607071920, 2262029012, 2685067896, 3183342108]"""
_CRC = f"""xor(4294967295, list_reduce(
    list_concat([4294967295], list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda d: ord(d)::BIGINT)),
    lambda c, d: xor({_TABLE}[(xor({_TABLE}[(xor(c, d) & 15) + 1], xor(c, d) >> 4) & 15) + 1],
                     xor({_TABLE}[(xor(c, d) & 15) + 1], xor(c, d) >> 4) >> 4)))"""
ORACLE = rf"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  WHERE conv_id IS NOT NULL),
own AS (
  SELECT conv_id, list({{'role': role, 'text': text}} ORDER BY turn NULLS FIRST,
    sha256(length(role) || ':' || role || text)) AS said FROM turns GROUP BY conv_id),
plan AS (SELECT conv_id, said, conv_id - ((conv_id % 20) + 20) % 20 AS base, {_CRC} % 4 AS head FROM own),
rebuilt AS (
  SELECT p.conv_id, list_concat(coalesce(b.said, [])[1:p.head], p.said[p.head + 1:]) AS said
  FROM plan p LEFT JOIN own b ON b.conv_id = p.base),
members AS (
  SELECT conv_id, len(said) AS size, unnest(range(len(said) + 1)) AS depth, said FROM rebuilt),
prefixes AS (SELECT conv_id, depth, size, said[1:depth] AS said FROM members),
nodes AS (
  SELECT depth, said, min(conv_id) AS conv_id, count(*) AS n_convs,
    coalesce(sha256(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (size = depth)),
      sha256('')) AS ends_sha256
  FROM prefixes GROUP BY depth, said),
linked AS (
  SELECT n.*, p.conv_id AS parent_conv_id,
    (SELECT count(*) FROM nodes k WHERE k.depth = n.depth + 1 AND k.said[1:n.depth] = n.said) AS n_children,
    CASE WHEN n.depth = 0 THEN 0 ELSE
      (n.n_convs - 1) * len(regexp_extract_all(n.said[n.depth].text, '[^ 	-
]+')) END AS saved
  FROM nodes n LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.said = n.said[1:n.depth - 1])
SELECT u.conv_id, u.depth, u.parent_conv_id, u.n_convs, u.n_children,
  CAST(count(*) FILTER (v.n_children = 0) AS BIGINT) AS n_leaves, CAST(sum(v.saved) AS BIGINT) AS saved_tokens,
  u.ends_sha256
FROM linked u JOIN linked v ON v.depth >= u.depth AND v.said[1:u.depth] = u.said
GROUP BY ALL
"""
