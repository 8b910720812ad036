"""Mixing sources to target weights by entropy balancing.

The rates closest to one in relative entropy that give every source its target number of
words, with no rate above a cap, are r = min(cap, exp(theta * size)), one theta per source:
the convex dual is solved by safeguarded Newton steps.  Documents of one source and size
share a rate, so the steps run on the table of (source, size, documents).  Rates become
whole copies by systematic rounding along the sizes, which keeps every source within a few
documents of its target.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from headway.llm.common import WORD, empty_if_null, packed, stored, unpacked

WEIGHTS = (1, 2, 3)
CAP = 3
# Equal sizes of a source are dealt over this many groups when copies are handed out.
SALTS = 256
# Fractions of copies are whole multiples of this, so sums do not depend on their order.
UNIT = 1 << 20
TOLERANCE = 1e-6
MAX_STEPS = 80

_KEY = ["no_source", "source"]


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, text key, source key, size (number of words; null text has none)."""
    return docs.select(
        "doc_id",
        F.xxhash64("text").alias("text_key"),
        F.col("source").isNull().alias("no_source"),
        empty_if_null("source").alias("source"),
        F.regexp_count(empty_if_null("text"), F.lit(WORD)).cast("long").alias("size"),
    )


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """Add ``target`` to one row per source: no_source, source, source_size.

    Sources in code point order, null last, weigh ``weights`` in turn and share all words.  A
    source stops at ``cap`` times its size and the excess goes to the others by weight, until
    none is above.  A source is capped when size / weight is small, so in that order the
    capped ones are a prefix, found by one running sum.
    """
    # A window over all sources: one row each, not one per document.
    numbered = sources.withColumn("rank", F.row_number().over(Window.orderBy(*_KEY)))
    weighed = numbered.withColumn(
        "weight", F.element_at(F.lit(list(weights)), F.expr(f"int((rank - 1) % {len(weights)}) + 1"))
    )
    up_to = Window.orderBy(F.col("source_size") / F.col("weight"), "rank")
    whole = Window.partitionBy()
    before = up_to.rowsBetween(Window.unboundedPreceding, -1)
    shared = weighed.select(
        "*",
        F.sum("source_size").over(whole).alias("_all"),
        F.coalesce(F.sum("source_size").over(before), F.lit(0)).alias("_capped"),
        (F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0))).alias("_rest"),
    ).withColumn("_each", (F.col("_all") - cap * F.col("_capped")) / F.col("_rest"))
    is_capped = F.col("weight") * F.col("_each") > cap * F.col("source_size")
    each = F.min(F.when(~is_capped, F.struct(F.col("source_size") / F.col("weight"), "rank", "_each")))
    return shared.withColumn("_level", each.over(whole)["_each"]).select(
        *_KEY,
        "source_size",
        F.when(is_capped, cap * F.col("source_size").cast("double"))
        .otherwise(F.col("weight") * F.col("_level"))
        .alias("target"),
    )


def _rate(cap: int) -> Column:
    return F.exp(F.least(F.col("theta") * F.col("x"), F.lit(math.log(cap))))


def solve(sizes: DataFrame, goals: DataFrame, cap: int = CAP) -> DataFrame:
    """Theta of every source by Newton steps on the dual, all sources at once.

    ``sizes`` has (source key, size, n); ``goals`` has (source key, source_size, target,
    documents).  A step sums the words taken and their derivative per source, with map-side
    combining, and moves theta; a step that leaves the bracket halves it instead.  Rates that
    are not balanced after MAX_STEPS are an error.
    """
    scale = F.col("source_size") / F.col("documents")
    state = goals.where("source_size > 0").select(
        *_KEY,
        "target",
        scale.alias("scale"),
        F.log(F.col("target") / F.col("source_size")).alias("theta"),
        F.lit(None).cast("double").alias("low"),
        F.lit(None).cast("double").alias("high"),
    )
    for step in range(MAX_STEPS):
        x = sizes.where("size > 0").join(state, _KEY).withColumn("x", F.col("size") / F.col("scale"))
        r, words = _rate(cap), F.col("n") * F.col("size")
        free = F.when(F.col("theta") * F.col("x") < math.log(cap), words * r * F.col("x"))
        sums = x.groupBy(*_KEY).agg(
            F.sum(words * r).alias("taken"),
            F.coalesce(F.sum(free), F.lit(0.0)).alias("slope"),
            (math.log(cap) / F.min("x")).alias("ceiling"),
        )
        state = stored(_moved(state.join(sums, _KEY)), f"mix-step-{step}")
        if not state.agg(F.max("off")).first()[0]:
            return state.select(*_KEY, "theta", "scale")
        state = state.drop("off")
    raise ArithmeticError(f"rates are not balanced after {MAX_STEPS} steps")


def _moved(state: DataFrame) -> DataFrame:
    """One safeguarded Newton step per source; ``off`` tells that a source is not there yet."""
    gap = F.col("taken") - F.col("target")
    off = F.abs(gap) > TOLERANCE * F.col("target")
    low = F.when(gap < 0, F.greatest("low", "theta")).otherwise(F.col("low"))
    high = F.when(gap > 0, F.least("high", "theta")).otherwise(F.col("high"))
    # At the ceiling every document is at the cap; below, brackets double until they hold.
    bracketed = state.withColumn("low", low).withColumn(
        "high", F.coalesce(high, F.greatest("ceiling", F.lit(0.0)))
    )
    newton = F.col("theta") - gap / F.col("slope")
    inside = (F.col("slope") > 0) & (newton < F.col("high")) & (
        F.col("low").isNull() | (newton > F.col("low"))
    )
    middle = F.when(F.col("low").isNull(), 2 * F.least(F.col("theta"), F.lit(-1.0))).otherwise(
        (F.col("low") + F.col("high")) / 2
    )
    return bracketed.select(
        *_KEY,
        "target",
        "scale",
        F.when(off, F.when(inside, newton).otherwise(middle)).otherwise(F.col("theta")).alias("theta"),
        "low",
        "high",
        (off & (F.col("low").isNull() | (F.col("high") - F.col("low") > 1e-13))).alias("off"),
    )


def mixed(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """One row per row of ``docs``: doc_id, size, source_size, target, taken, copies.

    Null sources form one source, ordered last; null text has size 0, and documents of size
    0 are never taken.  Rows that repeat a doc_id are documents of their own; which of
    them gets a copy does not change the result.  An empty table gives no rows.  Reruns agree:
    copies follow the hash of the doc_id, or of the text where that is null.
    """
    return _placed(docs, weights, cap).select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("copies") * F.col("size")).alias("taken"),
        "copies",
    )


def _placed(docs: DataFrame, weights: tuple[int, ...], cap: int) -> DataFrame:
    """``copies`` and what they follow from, for every row."""
    rows = stored(sized(docs), "mix-sizes")
    sizes = stored(rows.groupBy(*_KEY, "size").agg(F.count(F.lit(1)).alias("n")), "mix-histogram")
    sources = sizes.groupBy(*_KEY).agg(
        F.sum(F.col("n") * F.col("size")).alias("source_size"), F.sum("n").alias("documents")
    )
    goals = stored(
        targets(sources.drop("documents"), weights, cap).join(
            sources.select(*_KEY, "documents"), _KEY
        ),
        "mix-targets",
    )
    thetas = solve(sizes, goals, cap)

    # Copies: the whole part of the rate, and one more where the running sum of the fractions
    # along (size, group of the size, rank in the group) passes a whole number.
    rate = _rate(cap)
    rated = (
        sizes.join(goals, _KEY)
        .join(thetas, _KEY, "left")
        .withColumn("x", F.col("size") / F.col("scale"))
        .withColumn("_units", F.when(F.col("size") > 0, F.round(rate * UNIT).cast("long")).otherwise(0))
        .withColumn("_base", F.expr(f"_units div {UNIT}"))
        .withColumn("_fraction", F.expr(f"_units % {UNIT}"))
    )
    along = Window.partitionBy(*_KEY).orderBy("size").rowsBetween(Window.unboundedPreceding, -1)
    rated = rated.withColumn(
        "_start",
        F.coalesce(F.sum(F.col("n") * F.col("_fraction")).over(along), F.lit(0)) + UNIT // 2,
    )
    hashed = F.when(F.col("doc_id").isNull(), F.col("text_key")).otherwise(F.xxhash64("doc_id"))
    salted = rows.withColumn("_hash", hashed).withColumn("_salt", F.expr(f"pmod(_hash, {SALTS})"))
    group = [*_KEY, "size", "_salt"]
    earlier = (
        Window.partitionBy(*_KEY, "size").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = (
        salted.groupBy(*group)
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_offset", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
        .join(
            rated.select(*_KEY, "size", "source_size", "target", "_base", "_fraction", "_start"),
            [*_KEY, "size"],
        )
    )
    ranked = salted.withColumn(
        "_rank", F.row_number().over(Window.partitionBy(*group).orderBy("_hash", "doc_id", "text_key"))
    )
    end = F.col("_start") + (F.col("_offset") + F.col("_rank")) * F.col("_fraction")
    placed = ranked.join(offsets, group).withColumn("_end", end)
    extra = F.expr(f"_end div {UNIT} - (_end - _fraction) div {UNIT}")
    return placed.withColumn("copies", F.col("_base") + extra)


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it, with all their columns.

    Copies go by doc_id (null included), text and source, so documents without an id get theirs
    too.  Rows alike in these share the copies given to them all as evenly as can be.  Other
    columns may have any name and come back unchanged.  An empty table gives no rows.
    """
    taken = stored(
        _placed(docs, weights, cap)
        .groupBy(
            F.col("doc_id").alias("id"),
            F.col("text_key").alias("of"),
            F.col("no_source").alias("none"),
            F.col("source").alias("from_source"),
        )
        .agg(F.sum("copies").alias("copies"), F.count(F.lit(1)).alias("alike"))
        .where("copies > 0"),
        "mix-taken",
    )
    same = F.expr("own <=> id and key = of and no_source = none and source = from_source")
    keyed = packed(
        docs,
        own=F.col("doc_id"),
        key=F.xxhash64("text"),
        no_source=F.col("source").isNull(),
        source=empty_if_null("source"),
    )
    found = keyed.join(taken.where("alike = 1"), same).select("row", "copies")
    alike = taken.where("alike > 1")
    if not alike.isEmpty():
        group = Window.partitionBy("id", "of", "none", "from_source").orderBy(F.lit(0))
        shared = keyed.join(alike, same).withColumn("rank", F.row_number().over(group))
        each = F.expr("copies div alike + if(rank <= copies % alike, 1, 0)")
        found = found.unionByName(shared.select("row", each.alias("copies")))
    times = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))
    return unpacked(found.where("copies > 0").select("row", times))
