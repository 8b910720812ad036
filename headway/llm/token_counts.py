"""Token counts that follow edits.

A text is split into pre-tokens, which a byte-level BPE encodes on their own.  Each document
keeps a segment tree over blocks of pre-tokens: a leaf holds the characters, pre-tokens and
tokens of its block, every node above the sums of its children.  An edit descends to the leaf
of its place by the characters, re-encodes the blocks it touches and some characters of
context, until the new pre-tokens meet an old block boundary again; then only the sums above
the changed leaves are updated.
"""

from __future__ import annotations

import base64
import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.llm.common import worker_state

RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the pattern that goes with the ranks.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

# Pre-tokens of a leaf when a tree is built; a leaf grown to four times that is split anew.
LEAF = 32
# A pre-token is settled by itself and at most so many characters behind it, so an edit can
# change the pre-tokens that end this close in front of it.
CONTEXT = 3
# Pre-tokens a worker keeps, and the longest kept.
KEPT_PRETOKENS, KEPT_CHARS = 300_000, 64

TREE = "node_chars array<long>, node_pretokens array<long>, sums array<long>"
EDITS = "array<struct<start: int, end: int, text: string>>"


def load(path: str = RANKS) -> dict[bytes, int]:
    """The vocabulary, read on the driver; tasks get it by broadcast."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


class Counter:
    """Tokens of pre-tokens, with those met before kept."""

    def __init__(self, ranks: dict[bytes, int], pattern: str = PATTERN) -> None:
        self.split = regex.compile(pattern)
        encoding = tiktoken.Encoding(
            "ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}
        )
        self.encode = encoding.encode_ordinary
        self.kept: dict[str, int] = {}

    def tokens(self, pretokens: list[str]) -> list[int]:
        kept = self.kept
        if len(kept) > KEPT_PRETOKENS:
            kept.clear()
        counts = []
        for pretoken in pretokens:
            count = kept.get(pretoken)
            if count is None:
                count = len(self.encode(pretoken))
                if len(pretoken) <= KEPT_CHARS:
                    kept[pretoken] = count
            counts.append(count)
        return counts


class Tree:
    """Segment tree of one text, as three arrays: characters, pre-tokens and tokens.

    Node 1 is the whole, the children of node k are 2 k and 2 k + 1, and the second half of
    each array are the leaves, from left to right.
    """

    def __init__(self, chars: list[int], pretokens: list[int], sums: list[int]) -> None:
        self.chars, self.pretokens, self.sums = chars, pretokens, sums
        self.visited = 0

    @classmethod
    def build(cls, text: str, counter: Counter) -> Tree:
        pretokens = counter.split.findall(text)
        tokens = counter.tokens(pretokens)
        starts = range(0, max(len(pretokens), 1), LEAF)
        size = 1 << (len(starts) - 1).bit_length()
        tree = cls(*([0] * (2 * size) for _ in range(3)))
        for k, start in enumerate(starts):
            block = slice(start, start + LEAF)
            tree._set(size + k, pretokens[block], tokens[block])
        tree._sum(size, 2 * size - 1)
        return tree

    def _set(self, leaf: int, pretokens: list[str], tokens: list[int]) -> None:
        self.chars[leaf] = sum(map(len, pretokens))
        self.pretokens[leaf] = len(pretokens)
        self.sums[leaf] = sum(tokens)

    def _sum(self, low: int, high: int) -> None:
        """The sums of all nodes above some neighbouring leaves."""
        while low > 1:
            low, high = low // 2, high // 2
            self.visited += high - low + 1
            for values in (self.chars, self.pretokens, self.sums):
                for k in range(low, high + 1):
                    values[k] = values[2 * k] + values[2 * k + 1]

    def _leaf(self, place: int) -> tuple[int, int]:
        """The leaf that holds a character, found from the root, and where the leaf begins."""
        node, at, size = 1, 0, len(self.sums) // 2
        while node < size:
            self.visited += 1
            node *= 2
            if at + self.chars[node] <= place and self.chars[node + 1]:
                at += self.chars[node]
                node += 1
        return node, at

    @property
    def total(self) -> int:
        return self.sums[1]

    def edit(
        self, text: str, start: int, end: int, instead: str, counter: Counter
    ) -> tuple[Tree, str, int]:
        """The tree and text after text[start:end] is replaced, and pre-tokens encoded anew.

        The tree is changed in place, or built anew where the edit outgrows its leaves.
        """
        start = min(max(start, 0), len(text))
        end = min(max(end, start), len(text))
        edited = text[:start] + instead + text[end:]
        size = len(self.sums) // 2
        first, at = self._leaf(max(0, start - CONTEXT))
        # The leaf behind the last one changed, and where it began before the edit.
        last, bound = first + 1, at + self.chars[first]
        shift = len(instead) - (end - start)
        found, met = [], False
        for match in counter.split.finditer(edited, at):
            found.append(match[0])
            after = match.end()
            if after < start + len(instead):
                continue
            while last < 2 * size and (bound < end or bound + shift < after):
                bound += self.chars[last]
                last += 1
                self.visited += 1
            if bound >= end and bound + shift == after:
                met = True
                break
        if not met:
            last = 2 * size
        leaves = last - first
        if not edited or len(found) > 4 * LEAF * leaves:
            rebuilt = Tree.build(edited, counter)
            return rebuilt, edited, rebuilt.pretokens[1]
        tokens = counter.tokens(found)
        # The changed leaves share the new pre-tokens evenly; some may become empty.
        each = -(-len(found) // leaves)
        for k in range(leaves):
            block = slice(k * each, (k + 1) * each)
            self._set(first + k, found[block], tokens[block])
        self.visited += leaves
        self._sum(first, last - 1)
        return self, edited, len(found)


def _counter(ranks, pattern: str) -> Counter:
    counters = worker_state("pretoken-counters", dict)
    key = (len(ranks.value), pattern)
    if key not in counters:
        counters[key] = Counter(ranks.value, pattern)
    return counters[key]


def with_trees(docs: DataFrame, ranks: dict[bytes, int], pattern: str = PATTERN) -> DataFrame:
    """All columns of ``docs`` with the tree of every text; null text has the tree of none.

    Columns of these names that ``docs`` has already are replaced.
    """
    names = [part.split()[0] for part in TREE.split(", ")]
    kept = docs.drop(*names)
    shared = docs.sparkSession.sparkContext.broadcast(ranks)  # the vocabulary
    at = kept.columns.index("text")

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(shared, pattern)
        gc.disable()  # no cycles are made
        try:
            for batch in batches:
                trees = [Tree.build(text or "", counter) for text in batch.column(at).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        *batch.columns,
                        *(
                            pa.array([getattr(t, name) for t in trees], pa.list_(pa.int64()))
                            for name in ("chars", "pretokens", "sums")
                        ),
                    ],
                    names=[*batch.schema.names, *names],
                )
        finally:
            gc.enable()

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema)
    return kept.mapInArrow(build, f"{schema}, {TREE}")


def n_tokens(sums: str = "sums") -> Column:
    """The count of a whole text, read from the root of its tree."""
    return F.element_at(F.col(sums), 2)


def edited(state: DataFrame, ranks: dict[bytes, int], pattern: str = PATTERN) -> DataFrame:
    """Apply the column ``edits`` to rows of ``with_trees``: doc_id, text, tree, n_before,
    n_tokens, n_pretokens, n_reencoded.

    Edits follow each other; places are code points of the text that the one before left,
    are clipped to it, and null places or texts count as 0 or empty.  Null edits change
    nothing.  A null text is edited as an empty one.
    """
    shared = state.sparkSession.sparkContext.broadcast(ranks)
    columns = state.select("doc_id", "text", "node_chars", "node_pretokens", "sums", "edits")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(shared, pattern)
        gc.disable()  # no cycles are made
        try:
            for batch in batches:
                yield _edited(batch, counter)
        finally:
            gc.enable()

    return columns.mapInArrow(run, _EDITED)


_EDITED = (
    f"doc_id long, text string, {TREE}, n_before long, n_tokens long, n_pretokens long, "
    "n_reencoded long"
)


def _edited(batch: pa.RecordBatch, counter: Counter) -> pa.RecordBatch:
    rows = []
    for _, text, chars, pretokens, sums, edits in zip(*(c.to_pylist() for c in batch.columns)):
        tree, text, work, before = Tree(chars, pretokens, sums), text or "", 0, sums[1]
        for edit in edits or ():
            if edit is not None:
                tree, text, encoded = tree.edit(
                    text, edit["start"] or 0, edit["end"] or 0, edit["text"] or "", counter
                )
                work += encoded
        rows.append(
            (text, tree.chars, tree.pretokens, tree.sums, before, tree.total, tree.pretokens[1], work)
        )
    kinds = [pa.string(), *[pa.list_(pa.int64())] * 3, *[pa.int64()] * 4]
    arrays = [pa.array([row[k] for row in rows], kind) for k, kind in enumerate(kinds)]
    names = "doc_id text node_chars node_pretokens sums n_before n_tokens n_pretokens n_reencoded"
    return pa.RecordBatch.from_arrays([batch.column(0), *arrays], names=names.split())


def trial_edits(text: str = "text", doc_id: str = "doc_id") -> Column:
    """Three edits that follow from the document itself: an insertion, a replacement and a
    deletion, at places given by a hash of the id."""
    size = F.greatest(F.length(F.coalesce(F.col(text), F.lit(""))), F.lit(1))
    key = F.coalesce(F.col(doc_id), F.lit(0))

    def place(k: int) -> Column:
        return F.pmod(F.xxhash64(key, F.lit(k)), size.cast("long")).cast("int")

    def one(k: int, length: int, instead: Column) -> Column:
        return F.struct(
            place(k).alias("start"), (place(k) + length).alias("end"), instead.alias("text")
        )

    return F.array(
        one(1, 0, F.concat(F.lit(" note "), key.cast("string"), F.lit(". "))),
        one(2, 12, F.lit("it's 42")),
        one(3, 25, F.lit("")),
    )
