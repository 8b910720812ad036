"""URL filter: a trie over reversed host labels and path segments, longest match first.

The trie of the rules is broadcast up to a checked number of rules.  Beyond it, urls and
rules meet in an equi-join on host suffix and path prefix, which gives the same results.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ALLOW, BLOCK = "allow", "block"
TRIE_RULES = 200_000

_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host(url: str = "url") -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#``; A-Z lower-cased; else empty."""
    found = F.regexp_extract(F.coalesce(F.col(url), F.lit("")), _URL, 1)
    return F.translate(found, _UPPER, _LOWER)


def path(url: str = "url") -> Column:
    """What follows the host up to ``?`` or ``#``; else empty."""
    return F.regexp_extract(F.coalesce(F.col(url), F.lit("")), _URL, 2)


class Trie:
    """Rules by reversed host labels, then by whole path segments, then by a part of one."""

    def __init__(self, rules: list[tuple[str, str, str]]) -> None:
        self.root: dict = {}
        for rule_host, rule_path, verdict in rules:
            node = self.root
            for label in reversed(rule_host.split(".")):
                node = node.setdefault("labels", {}).setdefault(label, {})
            *segments, part = rule_path.split("/")
            for segment in segments:
                node = node.setdefault("segments", {}).setdefault(segment, {})
            ends = node.setdefault("ends", {})
            # Of one rule given twice, a block wins.
            ends[part] = max(ends.get(part, verdict), verdict, key=(ALLOW, BLOCK).index)

    def longest(self, url_host: str, url_path: str) -> tuple[str | None, str | None]:
        """Rule (host and path) and verdict; more host labels win, then the longer path."""
        nodes, node, labels = [], self.root, url_host.split(".")
        for k, label in enumerate(reversed(labels), 1):
            node = node.get("labels", {}).get(label)
            if node is None:
                break
            nodes.append((k, node))
        for k, node in reversed(nodes):
            best, start = None, 0
            while True:
                end = url_path.find("/", start)
                segment = url_path[start:] if end < 0 else url_path[start:end]
                if ends := node.get("ends"):
                    # A rule may end within a segment.
                    for size in range(min(len(segment), max(map(len, ends))), -1, -1):
                        if segment[:size] in ends:
                            best = (start + size, ends[segment[:size]])
                            break
                node = node.get("segments", {}).get(segment)
                if end < 0 or node is None:
                    break
                start = end + 1
            if best is not None:
                return ".".join(labels[-k:]) + url_path[: best[0]], best[1]
        return None, None


def matcher(spark, rules: list[tuple[str, str, str]]) -> Callable[[Column, Column], Column]:
    """A column function: host and path to struct(rule, verdict), nulls without a rule."""
    shared = spark.sparkContext.broadcast(Trie(rules).root)

    @F.pandas_udf("rule string, verdict string")
    def match(hosts: pd.Series, paths: pd.Series) -> pd.DataFrame:
        trie = Trie([])
        trie.root = shared.value
        found = [trie.longest(h, p) for h, p in zip(hosts, paths)]
        return pd.DataFrame(found, columns=["rule", "verdict"], dtype=object)

    return match


def judged(
    pages: DataFrame, rules: DataFrame, default: str = ALLOW, trie_rules: int = TRIE_RULES
) -> DataFrame:
    """One row per row of ``pages``: page_id, host, path, rule, verdict.

    ``rules`` has host, path and verdict (allow or block); rules with a null are ignored, and
    of one given twice a block wins.  A rule fits its host and all subdomains when the path
    starts with the rule's; more host labels win, then the longer path.  Urls without a rule,
    null urls and urls without ``://`` (empty host and path) get ``default``.  Repeated rows
    are judged alike; other columns are not read.  No pages give no rows.
    """
    parted = pages.select("page_id", host().alias("host"), path().alias("path"))
    known = rules.select("host", "path", "verdict").dropna()
    few = known.limit(trie_rules + 1).collect()
    if len(few) <= trie_rules:
        match = matcher(pages.sparkSession, [tuple(row) for row in few])
        found = parted.withColumn("_found", match("host", "path"))
    else:
        found = _joined(parted, known)
    return found.select(
        "page_id",
        "host",
        "path",
        F.col("_found.rule").alias("rule"),
        F.coalesce("_found.verdict", F.lit(default)).alias("verdict"),
    )


def _meetings(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """Where urls may meet rules: key, _k (host labels), _host, _size, _path (a prefix).

    ``urls`` has key, host and path.  A url meets rules at as many labels as a rule's host can
    have, and, of each known host, at the lengths that paths of its rules have; so what a url
    is multiplied by follows from the rules, however long it is.
    """
    labels = F.split("host", r"\.")
    most = rules.agg(F.max(F.size(labels))).first()[0] or 0
    sizes = rules.groupBy(F.col("host").alias("_host")).agg(F.collect_set(F.length("path")).alias("_sizes"))
    counts = F.slice(F.sequence(F.lit(1), F.size(labels)), 1, most)
    suffixes = urls.select("key", "path", labels.alias("_labels"), F.explode(counts).alias("_k")).select(
        "key", "path", "_k", F.array_join(F.expr("slice(_labels, -_k, _k)"), ".").alias("_host")
    )
    return (
        suffixes.join(sizes, "_host")
        .select("key", "path", "_k", "_host", F.explode("_sizes").alias("_size"))
        .where("_size <= length(path)")
        .select("key", "_k", "_host", "_size", F.expr("substring(path, 1, _size)").alias("_path"))
    )


def _joined(parted: DataFrame, rules: DataFrame) -> DataFrame:
    """The longest match of each different (host, path) by equi-joins.

    A host has no ``/`` and a path starts with one, so both in one name a url; its digest
    stands for it in the joins.
    """
    rules = rules.groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
    keyed = parted.withColumn("key", F.sha2(F.concat("host", "path"), 256))
    renamed = rules.select(
        F.col("host").alias("_host"), F.col("path").alias("_path"), F.col("verdict").alias("_verdict")
    )
    best = F.struct("_k", "_size", F.concat("_host", "_path").alias("rule"), F.col("_verdict").alias("verdict"))
    found = (
        _meetings(keyed.select("key", "host", "path").distinct(), rules)
        .join(renamed, ["_host", "_path"])
        .groupBy("key")
        .agg(F.max(best).alias("_found"))
    )
    return keyed.join(found, "key", "left")


# The rules of the registered query.
RULES = (
    ("org", "/", ALLOW),
    ("example.org", "/es/", BLOCK),
    ("example.org", "/en/1", BLOCK),
    ("com", "/fr/", ALLOW),
    ("com", "/de/", BLOCK),
)

ORACLE = r"""
WITH u AS (
  SELECT page_id, strpos(coalesce(url, ''), '://') AS s, coalesce(url, '') AS url FROM pages),
r AS (
  SELECT page_id, CASE WHEN s > 0 THEN substr(url, s + 3) ELSE '' END AS rest FROM u),
p AS (
  SELECT page_id,
    translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM r),
rules(h, t, v) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'),
  ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
hit AS (
  SELECT page_id, host, path, h || t AS rule, v,
    row_number() OVER (PARTITION BY page_id ORDER BY length(h) DESC, length(t) DESC) AS k
  FROM p JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, t))
SELECT p.page_id, p.host, p.path, hit.rule, coalesce(hit.v, 'allow') AS verdict
FROM p LEFT JOIN hit ON hit.page_id = p.page_id AND hit.k = 1
"""
