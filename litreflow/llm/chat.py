r"""Chat formatting of reply trees, in DataFrame functions only.

``paths`` enumerates root-to-leaf paths by self-joins that double the reach of
each node's parent pointer, so a thread of n turns takes log2(n) rounds and no
list of nodes is built on the way. Branches are ranked by the sum of their
nodes' scores, and each chosen path is formatted as one conversation:

    ### role: text</turn>\n   (once per turn)

Inside roles and texts, "\" is written "\b", "#" "\h", "<" "\l" and, in roles,
":" "\c". No escaped text holds a "#" or "<", so marks are found by splitting,
and ``read_back`` restores every text. The loss mask lists the assistant
texts: turn, place and length within the turn, and place in the conversation.

Inputs: null texts and roles are empty. A node whose parent is null or not in
its tree is a root. Of rows that repeat a node id in a tree, the least by
parent, role, text and score is kept; nodes whose ancestors form a circle
belong to no path. Null scores count as 0; equal scores are ranked by leaf id.
A null ``tree_id`` is a tree of its own. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import checkpointed, table

OPEN, MIDDLE, CLOSE = "### ", ": ", "</turn>\n"
LEARNED_ROLE = "assistant"
_ESCAPES = [("\\", "\\b"), ("#", "\\h"), ("<", "\\l")]
_ROLE_ESCAPES = [*_ESCAPES, (":", "\\c")]
#: The fixed conversation of control strings that the query adds.
PROBE_ID = -7
PROBE_TEXT = "\\### Assistant: </turn> ok"


def escaped(text: Column, escapes: list[tuple[str, str]] = _ESCAPES) -> Column:
    for plain, mark in escapes:
        text = F.replace(text, F.lit(plain), F.lit(mark))
    return text


def unescaped(text: Column, escapes: list[tuple[str, str]] = _ESCAPES) -> Column:
    for plain, mark in reversed(escapes):
        text = F.replace(text, F.lit(mark), F.lit(plain))
    return text


def _unique(nodes: DataFrame) -> DataFrame:
    """One row per (tree, node), empty strings for nulls."""
    return (nodes.filter("node_id IS NOT NULL")
            .groupBy("tree_id", "node_id")
            .agg(F.min(F.struct(
                F.col("parent_id").cast("bigint").alias("parent_id"),
                F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
                F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"))).alias("n"))
            .select("tree_id", F.col("node_id").cast("bigint").alias("node_id"), "n.*"))


def _same(a: DataFrame, b: DataFrame, left: str, right: str) -> Column:
    return a["tree_id"].eqNullSafe(b["tree_id"]) & (a[left] == b[right])


def paths(nodes: DataFrame) -> DataFrame:
    """(tree_id, leaf_id, node_id, up) for every node on the way from each leaf
    up to its root; ``up`` counts from the leaf. ``nodes`` has unique node ids."""
    links = nodes.select("tree_id", "node_id", F.col("parent_id").alias("up_id"))
    known = nodes.select(F.col("tree_id").alias("tree"), F.col("node_id").alias("known_id"))
    edges = links.filter("up_id IS NOT NULL")
    edges = edges.join(known, edges["tree_id"].eqNullSafe(known["tree"]) &
                       (edges["up_id"] == known["known_id"]), "left_semi")
    levels = [checkpointed(edges)]  # level k: each node's 2**k-th ancestor
    bound = levels[0].count().bit_length()  # no path without a circle is longer
    while len(levels) <= bound and not levels[-1].isEmpty():
        a = levels[-1]
        b = a.select(F.col("tree_id").alias("tree"), F.col("node_id").alias("at"), F.col("up_id").alias("next"))
        levels.append(checkpointed(
            a.join(b, a["tree_id"].eqNullSafe(b["tree"]) & (a["up_id"] == b["at"]))
            .select("tree_id", "node_id", F.col("next").alias("up_id"))))
    circular = levels.pop()  # empty, but for nodes under a circle
    leaves = nodes.select("tree_id", "node_id")
    inner = levels[0].select(F.col("tree_id").alias("tree"), "up_id") if levels else None
    for other, name in ((inner, "up_id"), (circular.select(F.col("tree_id").alias("tree"), "node_id"), "node_id")):
        if other is not None:
            leaves = leaves.join(other, leaves["tree_id"].eqNullSafe(other["tree"]) &
                                 (leaves["node_id"] == other[name]), "left_anti")
    found = checkpointed(leaves.select("tree_id", F.col("node_id").alias("leaf_id"), "node_id",
                                       F.lit(0).cast("bigint").alias("up")))
    for k, level in enumerate(levels):
        step = level.select(F.col("tree_id").alias("tree"), F.col("node_id").alias("at"), "up_id")
        found = checkpointed(found.unionByName(
            found.join(step, found["tree_id"].eqNullSafe(step["tree"]) & (found["node_id"] == step["at"]))
            .select("tree_id", "leaf_id", F.col("up_id").alias("node_id"), (F.col("up") + (1 << k)).alias("up"))))
    return found


def chosen_paths(nodes: DataFrame, top: int | None = None) -> DataFrame:
    """(tree_id, leaf_id, rank, depth, role, text) of the ``top`` branches of
    each tree (all, if None) by the sum of their scores."""
    nodes = checkpointed(_unique(nodes))
    steps = paths(nodes)
    own = nodes.select(F.col("tree_id").alias("tree"), F.col("node_id").alias("node"), "role", "text", "score")
    rows = steps.join(own, steps["tree_id"].eqNullSafe(own["tree"]) & (steps["node_id"] == own["node"]))
    branch = rows.groupBy("tree_id", "leaf_id").agg(F.sum("score").alias("total"), F.max("up").alias("length"))
    ranked = branch.withColumn("rank", F.row_number().over(
        Window.partitionBy("tree_id").orderBy(F.desc("total"), "leaf_id")))
    if top is not None:
        ranked = ranked.filter(F.col("rank") <= top)
    ranked = ranked.select(F.col("tree_id").alias("of_tree"), F.col("leaf_id").alias("of_leaf"), "rank", "length")
    return (rows.join(ranked, rows["tree_id"].eqNullSafe(ranked["of_tree"]) &
                      (rows["leaf_id"] == ranked["of_leaf"]))
            .select("tree_id", "leaf_id", "rank", (F.col("length") - F.col("up")).alias("depth"), "role", "text"))


def formatted(turns: DataFrame) -> DataFrame:
    """One row per path: tree_id, leaf_id, rank, formatted, loss."""
    head = F.concat(F.lit(OPEN), escaped(F.col("role"), _ROLE_ESCAPES), F.lit(MIDDLE))
    before = (Window.partitionBy("tree_id", "leaf_id").orderBy("depth")
              .rowsBetween(Window.unboundedPreceding, -1))
    lines = (turns.withColumn("head", head).withColumn("body", escaped(F.col("text")))
             .withColumn("line", F.concat("head", "body", F.lit(CLOSE)))
             .withColumn("at", F.coalesce(F.sum(F.char_length("line").cast("bigint")).over(before), F.lit(0))))
    mask = F.when(F.col("role") == LEARNED_ROLE, F.struct(
        F.col("depth").cast("int").alias("turn"), F.char_length("head").alias("start"),
        F.char_length("body").alias("len"),
        (F.col("at") + F.char_length("head")).cast("bigint").alias("at")))
    rows = lines.groupBy("tree_id", "leaf_id", "rank").agg(
        F.sort_array(F.collect_list(F.struct("depth", "line"))).alias("lines"),
        F.sort_array(F.collect_list(mask)).alias("loss"))
    return rows.select("tree_id", "leaf_id", "rank",
                       F.array_join(F.transform("lines", lambda x: x["line"]), "").alias("formatted"), "loss")


def read_back(rows: DataFrame) -> DataFrame:
    """``rows`` with ``turns`` (role, text) and ``loss_texts`` restored from
    the formatted conversation and its loss mask."""
    def turn(line: Column) -> Column:
        rest = F.substring(line, len(OPEN) + 1, F.char_length(line))
        role = F.substring_index(rest, MIDDLE, 1)
        return F.struct(unescaped(role, _ROLE_ESCAPES).alias("role"), unescaped(F.substring(
            rest, F.char_length(role) + len(MIDDLE) + 1, F.char_length(rest))).alias("text"))

    lines = F.split("formatted", CLOSE)
    lines = F.slice(lines, 1, F.size(lines) - 1)
    return (rows.withColumn("lines", lines)
            .withColumn("turns", F.transform("lines", turn))
            .withColumn("loss_texts", F.transform("loss", lambda m: unescaped(
                F.substring(F.get("lines", m["turn"]), m["start"] + 1, m["len"])))))


def linear_trees(conversations: DataFrame) -> DataFrame:
    """Conversations as trees: each row replies to the one before it (by turn;
    rows of one turn by role and text)."""
    order = Window.partitionBy("conv_id").orderBy(
        F.col("turn").asc_nulls_last(), F.coalesce("role", F.lit("")), F.coalesce("text", F.lit("")))
    return conversations.select("conv_id", "turn", "role", "text").withColumn(
        "node_id", F.row_number().over(order)).select(
        F.col("conv_id").alias("tree_id"), "node_id",
        F.when(F.col("node_id") > 1, F.col("node_id") - 1).alias("parent_id"),
        "role", "text", F.char_length("text").alias("score"))


def op5_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation formatted, and what is read back from the result."""
    probe = spark.range(2).select(
        F.lit(PROBE_ID).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise(LEARNED_ROLE).alias("role"), F.lit(PROBE_TEXT).alias("text"))
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(probe)
    back = read_back(formatted(chosen_paths(linear_trees(rows), top=1)))
    digest = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join("loss_texts", "")
    return back.select(
        F.col("tree_id").alias("conv_id"),
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(digest.cast("binary"), 256).alias("turns_sha256"),
        F.char_length(loss).cast("bigint").alias("loss_chars"),
        F.sha2(loss.cast("binary"), 256).alias("loss_sha256"),
        F.char_length("formatted").cast("bigint").alias("formatted_chars"))


ORACLE = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL
  SELECT -7, t, r, '\### Assistant: </turn> ok' FROM (VALUES (0, 'user'), (1, 'assistant')) AS p(t, r))
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS LAST, role, text))
         AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS LAST, role, text)
                       FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(14 + length(role) + length(text)
                + length(role) - length(replace(role, '\', '')) + length(role) - length(replace(role, '#', ''))
                + length(role) - length(replace(role, '<', '')) + length(role) - length(replace(role, ':', ''))
                + length(text) - length(replace(text, '\', '')) + length(text) - length(replace(text, '#', ''))
                + length(text) - length(replace(text, '<', ''))) AS BIGINT) AS formatted_chars
FROM c GROUP BY conv_id
"""
