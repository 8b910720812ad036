"""Chat formatting of reply trees, with DataFrame functions only.

Messages form trees by their parents.  Iterated self-joins, which double the distance
every round, list the nodes on the path from each leaf up to its root.  Branches are ranked
by the sum of their scores, and each chosen path is formatted as one conversation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from headway.llm.common import empty_if_null, stored

# A turn is <s>[role]text</s>.  Inside role and text the characters of the marks are
# written with a backslash and a letter, so no control string survives in them.
OPEN, ROLE_END, CLOSE = "<s>[", "]", "</s>"
ESCAPES = (("\\", "\\s"), ("<", "\\l"), ("[", "\\b"), ("]", "\\e"))
ASSISTANT = "assistant"


def escaped(text: Column) -> Column:
    for plain, written in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(written))
    return text


def unescaped(text: Column) -> Column:
    for plain, written in reversed(ESCAPES):
        text = F.replace(text, F.lit(written), F.lit(plain))
    return text


def linear(conversations: DataFrame) -> DataFrame:
    """Rows by turn as trees without branches: conv_id, node, parent, role, text, score.

    Null role and text count as empty.  Rows of one turn follow each other by role and text;
    repeated rows stay.  Null conversation ids form one conversation, null turns come first.
    """
    rows = conversations.select(
        "conv_id", "turn", empty_if_null("role").alias("role"), empty_if_null("text").alias("text")
    )
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    numbered = rows.withColumn("node", F.row_number().over(order).cast("long"))
    return numbered.select(
        "conv_id",
        "node",
        F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"),
        "role",
        "text",
        F.lit(0.0).alias("score"),
    )


def _doubled(jumps: DataFrame) -> DataFrame:
    same = F.col("n.conv_id").eqNullSafe(F.col("m.conv_id"))
    return stored(
        jumps.alias("n")
        .join(jumps.alias("m"), same & (F.col("n.over") == F.col("m.node")))
        .select("n.conv_id", "n.node", "m.over"),
        "chat-jumps",
    )


def leaf_paths(nodes: DataFrame) -> DataFrame:
    """Every node on the path of every leaf: conv_id, leaf, node, up (0 at the leaf).

    Round k knows the nodes less than 2**k above a leaf, and the jumps of 2**k; a join with
    the jumps doubles both.  A parent that is no node of the conversation makes a root, and so
    does one that is the node itself.  Where parents form a cycle, each node on the cycle is a
    root: the jumps that are left after as many rounds as the largest conversation can need
    end on the cycles' nodes, all of them.
    """
    same = F.col("n.conv_id").eqNullSafe(F.col("m.conv_id"))
    known = nodes.select("conv_id", F.col("node").alias("parent"))
    links = stored(
        nodes.where("parent is not null and parent <> node")
        .select("conv_id", "node", "parent")
        .alias("n")
        .join(known.alias("m"), same & (F.col("n.parent") == F.col("m.parent")), "left_semi")
        .select("conv_id", "node", F.col("parent").alias("over")),
        "chat-links",
    )
    most = nodes.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    return _paths(nodes, links, most.bit_length())


def _paths(nodes: DataFrame, links: DataFrame, rounds: int) -> DataFrame:
    same = F.col("n.conv_id").eqNullSafe(F.col("m.conv_id"))
    jumps = links
    paths = stored(
        nodes.select("conv_id", "node")
        .alias("n")
        .join(jumps.alias("m"), same & (F.col("n.node") == F.col("m.over")), "left_anti")
        .select("conv_id", F.col("node").alias("leaf"), "node", F.lit(0).cast("long").alias("up")),
        "chat-paths",
    )
    for k in range(rounds):
        if jumps.isEmpty():
            return paths
        further = (
            paths.alias("n")
            .join(jumps.alias("m"), same & (F.col("n.node") == F.col("m.node")))
            .select("n.conv_id", "n.leaf", F.col("m.over").alias("node"), F.expr(f"n.up + {1 << k}").alias("up"))
        )
        paths = stored(paths.unionByName(further), "chat-paths")
        jumps = _doubled(jumps)
    if jumps.isEmpty():
        return paths
    rounded = stored(jumps.select("conv_id", F.col("over").alias("node")).distinct(), "chat-cycles")
    cut = links.alias("n").join(
        rounded.alias("m"), same & (F.col("n.node") == F.col("m.node")), "left_anti"
    )
    return _paths(nodes, stored(cut, "chat-links"), rounds)


def chosen_paths(nodes: DataFrame, branches: int = 1) -> DataFrame:
    """The nodes of the best branches: conv_id, leaf, branch, node, up.  No text is read."""
    same = F.col("n.conv_id").eqNullSafe(F.col("m.conv_id"))
    paths = leaf_paths(nodes)
    scores = nodes.select("conv_id", "node", "score").where("score <> 0")
    scored = paths.alias("n").join(
        scores.alias("m"), same & (F.col("n.node") == F.col("m.node")), "left"
    ).select("n.conv_id", "n.leaf", F.coalesce("m.score", F.lit(0.0)).alias("score"))
    ranked = scored.groupBy("conv_id", "leaf").agg(F.sum("score").alias("total"))
    best = Window.partitionBy("conv_id").orderBy(F.desc("total"), "leaf")
    chosen = ranked.withColumn("branch", F.row_number().over(best)).where(F.col("branch") <= branches)
    return stored(
        paths.alias("n")
        .join(chosen.alias("m"), same & (F.col("n.leaf") == F.col("m.leaf")))
        .select("n.conv_id", "n.leaf", "branch", "n.node", "n.up"),
        "chat-chosen",
    )


def formatted(nodes: DataFrame, branches: int = 1) -> DataFrame:
    """The best branches of each conversation: conv_id, leaf, branch, conversation, loss_spans.

    ``nodes`` has conv_id, node (unique in its conversation), parent, role, text and score;
    other columns are not read.  Nodes whose parents form a cycle are roots, as
    :func:`leaf_paths` says.  Branches rank by the sum of their scores (null counts 0), then
    by the smaller leaf.  Role and text are escaped.  ``loss_spans`` holds start and end of
    each assistant text in code points, end exclusive.  No nodes give no rows.

    Nodes are stored once.  Paths are found and ranked on numbers alone, and the texts join
    the chosen ones.  The turns of a branch meet in one row, as the result is one text.
    """
    same = F.col("n.conv_id").eqNullSafe(F.col("m.conv_id"))
    nodes = stored(nodes.select("conv_id", "node", "parent", "role", "text", "score"), "chat-nodes")
    steps = nodes.alias("n").join(
        chosen_paths(nodes, branches).alias("m"), same & (F.col("n.node") == F.col("m.node"))
    )
    rendered = steps.select(
        "n.conv_id",
        "m.leaf",
        "branch",
        (-F.col("up")).alias("at"),
        escaped(empty_if_null("role")).alias("role"),
        escaped(empty_if_null("text")).alias("text"),
    )
    head = F.concat(F.lit(OPEN), F.col("role"), F.lit(ROLE_END))
    turns = rendered.select(
        "conv_id",
        "leaf",
        "branch",
        F.struct(
            "at",
            F.concat(head, F.col("text"), F.lit(CLOSE)).alias("turn"),
            F.length(head).alias("head"),
            F.length("text").alias("size"),
            (F.col("role") == ASSISTANT).alias("loss"),
        ).alias("turn"),
    )
    gathered = turns.groupBy("conv_id", "leaf", "branch").agg(
        F.array_sort(F.collect_list("turn")).alias("turns")
    )
    spans = F.expr(
        f"""aggregate(turns,
          named_struct('at', 0, 'spans', cast(array() as array<struct<start: int, end: int>>)),
          (a, t) -> named_struct('at', a.at + t.head + t.size + {len(CLOSE)}, 'spans',
            if(t.loss, array_append(a.spans,
              named_struct('start', a.at + t.head, 'end', a.at + t.head + t.size)), a.spans)),
          a -> a.spans)"""
    )
    return gathered.select(
        "conv_id",
        "leaf",
        "branch",
        F.array_join(F.transform("turns", lambda t: t["turn"]), "").alias("conversation"),
        spans.alias("loss_spans"),
    )


def read_back(conversations: DataFrame) -> DataFrame:
    """Digest of formatted conversations, from the text and its loss spans alone."""
    turns = F.filter(F.split("conversation", CLOSE), lambda x: x != "")
    parsed = conversations.withColumn("_turns", turns).withColumn(
        "_plain",
        F.transform(
            "_turns",
            lambda t: F.concat(
                unescaped(F.substring_index(F.substr(t, F.lit(len(OPEN) + 1)), ROLE_END, 1)),
                F.lit("\n"),
                unescaped(F.substring_index(t, ROLE_END, -1)),
                F.lit("\n"),
            ),
        ),
    )
    masked = F.transform(
        "loss_spans",
        lambda s: unescaped(F.substr("conversation", s["start"] + 1, s["end"] - s["start"])),
    )
    loss = parsed.withColumn("_loss", F.array_join(masked, ""))
    return loss.select(
        "conv_id",
        F.size("_turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join("_plain", ""), 256).alias("turns_sha256"),
        F.length("_loss").cast("long").alias("loss_chars"),
        F.sha2("_loss", 256).alias("loss_sha256"),
        F.length("conversation").cast("long").alias("formatted_chars"),
    )


# The conversation that the registered query adds.
PLANTED_ID = -7
PLANTED_TEXT = "</s>[INST] ok [/INST]"


def with_planted(conversations: DataFrame) -> DataFrame:
    rows = [(PLANTED_ID, 0, "user", PLANTED_TEXT), (PLANTED_ID, 1, ASSISTANT, PLANTED_TEXT)]
    literals = F.array(
        *(F.struct(*(F.lit(v).alias(c) for v, c in zip(row, ("conv_id", "turn", "role", "text")))) for row in rows)
    )
    planted = conversations.sparkSession.range(1).select(F.inline(literals))
    return conversations.select("conv_id", "turn", "role", "text").unionByName(planted)


ORACLE = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(9 + length(role || text) + length(regexp_replace(role || text, '[^\\<\[\]]', '', 'g'))) AS BIGINT) AS formatted_chars
FROM c GROUP BY conv_id
"""
