"""Personal data, and the terms that give it away.

Base patterns find e-mail addresses, IP addresses, payment cards and phone numbers.  Each
value found is a protected entity.  The words around its mentions are counted over the
corpus, and a term discloses an entity when their pointwise mutual information comes close
to the information content of the entity itself: whoever reads the term learns nearly all
there is to learn from the entity.  Such terms are removed, or generalised where they
reveal less.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.llm.common import BROADCAST_ROWS, stored

KINDS = ("email", "ip", "card", "phone")
TERM = "term"

# Words on either side of a mention that count as its context.
WINDOW = 10
# A term must share this many different contexts with an entity; copies of one text do not
# make evidence.
CONTEXTS = 3
# Shares of an entity's information from which a term is generalised, or removed.
GENERALISED, REMOVED = 0.9, 0.97
# Terms are broadcast up to so many bytes.
BROADCAST_BYTES = 1 << 24

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match can begin at the first digit of a run only, as runs are taken whole.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_EDGE = ".,;:!?\"'()[]{}<>|*$%&#"

Span = tuple[str, int, int]


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """A match is the run of local characters in front of an @ and the domain behind it."""
    end = at = 0
    while (at := text.find("@", at)) >= 0:
        if domain := _DOMAIN.match(text, at + 1):
            start = at
            while start > end and text[start - 1] in _LOCAL:
                start -= 1
            if start < at:
                at = end = domain.end()
                yield start, end
                continue
        at += 1


def _luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2]))
    return not (total + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10


def _digits(match: re.Match) -> str:
    return re.sub("[^0-9]", "", match[0])


def base_spans(text: str) -> list[Span]:
    """Base spans (kind, start, end) by kind, then start; code points, end exclusive."""
    spans = [("email", *span) for span in _emails(text)]
    for match in _IP.finditer(text):
        if all(len(x := part.lstrip("0")) < 4 and int(x or 0) <= 255 for part in match[0].split(".")):
            spans.append(("ip", *match.span()))
    for match in _CARD.finditer(text):
        if 13 <= len(digits := _digits(match)) <= 19 and _luhn(digits):
            spans.append(("card", *match.span()))
    for match in _PHONE.finditer(text):
        if 9 <= len(_digits(match)) <= 15:
            spans.append(("phone", *match.span()))
    return spans


def _terms(text: str) -> Iterator[tuple[str, int, int]]:
    """Lower-cased words with a letter, without the punctuation around them."""
    for match in _WORD.finditer(text):
        word = match[0].lstrip(_EDGE)
        start = match.end() - len(word)
        word = word.rstrip(_EDGE)
        if any(map(str.isalpha, word)):
            yield word.lower(), start, start + len(word)


def _term_set(text: str) -> set[str]:
    """The different terms of a text."""
    words = {word.strip(_EDGE) for word in set(_WORD.findall(text))}
    return {word.lower() for word in words if any(map(str.isalpha, word))}


def _outside(spans: list[Span]) -> Callable[[int, int], bool]:
    return lambda start, end: all(end <= a or start >= b for _, a, b in spans)


_MENTIONS = "entity string, term string, context long, n_entity int, n_both int"


def _mentions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Entity, term and context of every mention, once per document.

    ``n_entity`` and ``n_both`` are 1 in one row of the document for each entity, and for each
    entity and term, so their sums count documents, whatever the documents' ids.
    """
    names = [part.split()[0] for part in _MENTIONS.split(", ")]
    kinds = (pa.string(), pa.string(), pa.int64(), pa.int32(), pa.int32())
    for batch in batches:
        rows = []
        for text in batch.column(0).to_pylist():
            text = text or ""
            spans = base_spans(text)
            if not spans:
                continue
            free, words = _outside(spans), list(_terms(text))
            words = [word for word in words if free(*word[1:])]
            starts = [word[1] for word in words]
            found: dict[str, set] = {}
            for kind, start, end in spans:
                at = bisect_left(starts, start)
                near = [word[0] for word in words[max(0, at - WINDOW) : at + WINDOW]]
                context = xxhash.xxh64_intdigest("\0".join(near).encode()) - (1 << 63)
                found.setdefault(f"{kind}:{text[start:end]}", set()).update((t, context) for t in near)
            for entity, seen in found.items():
                rows.append((entity, None, 0, 1, 0))
                last = None
                for term, context in sorted(seen):
                    rows.append((entity, term, context, 0, int(term != last)))
                    last = term
        columns = list(zip(*rows)) or [()] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def _frequencies(wanted) -> Callable:
    """Per task: the number of documents of each wanted term; all terms without a set."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = wanted.value if wanted else None
        for batch in batches:
            counts: Counter = Counter()
            for text in batch.column(0).to_pylist():
                found = _term_set(text or "")
                counts.update(found if terms is None else found & terms)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())],
                names=["term", "n"],
            )

    return count


def _is_small(terms: DataFrame, few: int = BROADCAST_ROWS) -> bool:
    """Whether terms may be broadcast: by their number and by their bytes."""
    n, size = terms.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("term")), F.lit(0))).first()
    return n <= few and size <= BROADCAST_BYTES


def disclosing_terms(docs: DataFrame, window_contexts: int = CONTEXTS) -> DataFrame:
    """Terms above the threshold: term, kind (of the entity most revealed), share.

    With N documents, c(e) with the entity, c(t) with the term and c(e, t) where the term
    stands near the entity, the share of the entity's information is
    log(N c(e, t) / (c(e) c(t))) / log(N / c(e)).  An entity in every document has no
    information and cannot be disclosed.  Every row is a document, whatever its doc_id; null
    text holds nothing.  Only ``text`` is read.  An empty table gives no rows.
    """
    seen = stored(docs.select("text").mapInArrow(_mentions, _MENTIONS), "privacy-mentions")
    entities = seen.groupBy("entity").agg(F.sum("n_entity").alias("c_entity"))
    pairs = stored(
        seen.where("term is not null")
        .groupBy("entity", "term")
        .agg(F.countDistinct("context").alias("contexts"), F.sum("n_both").alias("c_both"))
        .where(F.col("contexts") >= window_contexts),
        "privacy-pairs",
    )
    terms = stored(pairs.select("term").distinct(), "privacy-terms")
    few = _is_small(terms)
    wanted = docs.sparkSession.sparkContext.broadcast({x[0] for x in terms.collect()}) if few else None
    counts = docs.select("text").mapInArrow(_frequencies(wanted), "term string, n long")
    if not few:
        counts = counts.join(terms, "term", "left_semi")
    frequency = counts.groupBy("term").agg(F.sum("n").alias("c_term"))
    known = pairs.join(entities, "entity").join(frequency, "term")
    known = known.withColumn("total", F.lit(docs.count()))
    information = F.log(F.col("total") / F.col("c_entity"))
    mutual = F.log(F.col("total") * F.col("c_both") / (F.col("c_entity") * F.col("c_term")))
    return stored(
        known.where("total > c_entity")
        .withColumn("share", mutual / information)
        .where(F.col("share") >= GENERALISED)
        .groupBy("term")
        .agg(F.max(F.struct("share", F.substring_index("entity", ":", 1).alias("kind"))).alias("most"))
        .select("term", "most.kind", "most.share"),
        "privacy-disclosing",
    )


def _digest(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def rewritten(text: str, base: list[Span], hits: list[tuple[int, int, str]]) -> str:
    """A text with every span replaced: base spans by their kind, terms by what is given.

    Spans that overlap or touch are replaced together, by the kind of the longest base span
    among them (of the first kind as listed, if several are), or, of terms, by what
    generalises, if any does.
    """
    edits = [(a, b, (0, a - b, KINDS.index(kind)), f"[{kind}]") for kind, a, b in base]
    edits += [(a, b, (1, not by, 0), by) for a, b, by in hits]
    out, at = [], 0
    end, rank, by = -1, None, ""
    for a, b, strength, instead in sorted(edits):
        if a <= end:
            end = max(end, b)
            if strength < rank:
                rank, by = strength, instead
            continue
        if rank is not None:
            out.append(by)
            at = end
        out.append(text[at:a])
        end, rank, by = b, strength, instead
    if rank is not None:
        out.append(by)
        at = end
    return "".join([*out, text[at:]])


_RESULT = (
    "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, "
    "spans string, n_term long, sanitised_sha256 string"
)


def _judged(text: str | None, found: list[tuple[int, int, str]], whole: bool) -> tuple:
    """What _RESULT says of a text; its rewritten form itself if ``whole``."""
    given, text = text, text or ""
    base = base_spans(text)
    free = _outside(base)
    hits = [hit for hit in sorted(found) if free(*hit[:2])]
    new = rewritten(text, base, hits)
    if whole:
        return (None if given is None else new,)
    counts = Counter(kind for kind, _, _ in base)
    return (
        *(counts[kind] for kind in KINDS),
        hashlib.sha256(_digest(base).encode()).hexdigest(),
        _digest(base + [(TERM, a, b) for a, b, _ in hits]),
        len(hits),
        hashlib.sha256(new.encode("utf-8", "surrogatepass")).hexdigest(),
    )


def _find(wanted, schema: str, whole: bool) -> Callable:
    """Rows from (doc_id, text), and the hits of the text where no terms are broadcast."""
    names = [part.split()[0] for part in schema.split(", ")]
    types = [pa.int64() if part.split()[1] == "long" else pa.string() for part in schema.split(", ")]

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = wanted.value if wanted else None
        for batch in batches:
            rows = []
            hits = batch.column(2).to_pylist() if terms is None else [None] * batch.num_rows
            for text, given in zip(batch.column(1).to_pylist(), hits):
                if terms is None:
                    found = [(x["start"], x["end"], x["instead"]) for x in given or ()]
                elif terms and text and not terms.keys().isdisjoint(_term_set(text)):
                    found = [(a, b, terms[word]) for word, a, b in _terms(text) if word in terms]
                else:
                    found = []
                rows.append(_judged(text, found, whole))
            columns = list(zip(*rows)) or [()] * (len(names) - 1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, k) for c, k in zip(columns, types[1:]))], names=names
            )

    return find


def _all_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            found = list(zip(*_terms(text or ""))) or [[], [], []]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([key] * len(found[0]), pa.string()),
                    pa.array(found[0], pa.string()),
                    pa.array(found[1], pa.int32()),
                    pa.array(found[2], pa.int32()),
                ],
                names=["key", "term", "start", "end"],
            )


def _found(docs: DataFrame, few: int, schema: str, whole: bool) -> DataFrame:
    terms = disclosing_terms(docs).select(
        "term",
        F.when(F.col("share") >= REMOVED, "")
        .otherwise(F.concat(F.lit("["), "kind", F.lit("-related]")))
        .alias("instead"),
    )
    texts = docs.select("doc_id", "text")
    if _is_small(terms, few):
        wanted = docs.sparkSession.sparkContext.broadcast(dict(map(tuple, terms.collect())))
        return texts.mapInArrow(_find(wanted, schema, whole), schema)
    # Where terms stand follows from the text alone, so the text's digest is the key.
    keyed = texts.withColumn("key", F.sha2("text", 256))
    hits = (
        keyed.where("text is not null")
        .select("key", "text")
        .mapInArrow(_all_terms, "key string, term string, start int, end int")
        .join(terms, "term")
        .dropDuplicates(["key", "start"])
        .groupBy("key")
        .agg(F.collect_list(F.struct("start", "end", "instead")).alias("hits"))
    )
    joined = keyed.join(hits, "key", "left").select("doc_id", "text", "hits")
    return joined.mapInArrow(_find(None, schema, whole), schema)


def personal_data(docs: DataFrame, few: int = BROADCAST_ROWS) -> DataFrame:
    """One row per row of ``docs``: doc_id, counts per base kind, base_sha256, spans, n_term,
    sanitised_sha256.

    Null text counts as empty and has no spans.  Base spans are always kept; a disclosing term
    adds a span where it does not overlap one.  ``sanitised_sha256`` is the digest of what
    :func:`sanitised` makes of the text.  Rows with no or the same doc_id are found and
    rewritten by their own text.  Repeated rows get equal results; other columns are not read.
    Disclosing terms are broadcast up to ``few`` and a bound of bytes; beyond, the terms of
    all documents meet them in a join, and the result is the same.  An empty table gives no
    rows.
    """
    return _found(docs, few, _RESULT, whole=False)


def sanitised(docs: DataFrame, few: int = BROADCAST_ROWS) -> DataFrame:
    """doc_id and text of every row: entities and weaker terms as their kind, stronger terms
    removed.

    Spans that overlap or touch become one (see :func:`rewritten`), so no part of a value is
    left.  Each text is rewritten by the task that holds it, so rows without an id and rows of
    one id get their own.  Null text stays null.  An empty table gives no rows.
    """
    return _found(docs, few, "doc_id long, text string", whole=True)
