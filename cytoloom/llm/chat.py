"""Chat formatting of reply trees.

Messages point to the message they reply to. Every path from a root to a leaf is a branch. Iterative self-joins with
doubled jumps first carry the score of the way to the root on one row per message, so that the
branches of a tree are ranked, and then enumerate the chosen ones; a thread of n messages takes about log2(n)
joins. Each chosen branch becomes one formatted conversation.

The template is ``### role: text</turn>`` and a line end per turn. Inside roles and texts the characters
the control strings are made of are escaped, ``\\`` as ``\\\\``, ``#`` as ``\\h``, ``<`` as ``\\l`` (and ``:`` in a role
as ``\\c``), so no text can imitate a control string and everything can be read back. The loss mask lists
the spans of the assistant's texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cytoloom.session import stored

END = "</turn>"


def escape(text: Column, role: bool = False) -> Column:
    out = F.replace(F.coalesce(text, F.lit("")), F.lit("\\"), F.lit("\\\\"))
    out = F.replace(F.replace(out, F.lit("#"), F.lit("\\h")), F.lit("<"), F.lit("\\l"))
    return F.replace(out, F.lit(":"), F.lit("\\c")) if role else out


def unescape(text: Column) -> Column:
    """The inverse of ``escape``: between doubled backslashes every other escape stands alone."""

    def plain(part: Column) -> Column:
        part = F.replace(F.replace(part, F.lit("\\h"), F.lit("#")), F.lit("\\l"), F.lit("<"))
        return F.replace(part, F.lit("\\c"), F.lit(":"))

    return F.array_join(F.transform(F.split(text, r"\\\\", -1), plain), "\\")


def rooted(messages: DataFrame) -> DataFrame:
    """(node, total, n_turns) of every message that a root is above: the sum of the scores and the number of messages
    from the root down to it.

    Pointers are doubled on one row per message. A round in which no message arrives at a root leaves only
    those whose way up runs into a reply cycle; they belong to no conversation and are left out.
    """
    nodes = messages.select("node", "parent", F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("total"))
    known = nodes.select(F.col("node").alias("parent"), F.lit(True).alias("known")).distinct()
    state = nodes.join(known, "parent", "left").select("node", F.when(F.col("known"), F.col("parent")).alias("up"), "total", F.lit(1).cast("long").alias("n_turns"))
    state, before = stored(state, "roots"), None
    while (waiting := state.where("up IS NOT NULL").count()) not in (0, before):
        above = state.select(F.col("node").alias("up"), F.col("up").alias("top"), F.col("total").alias("more"), F.col("n_turns").alias("turns"))
        moved = state.where("up IS NOT NULL").join(above, "up").select(
            "node", F.col("top").alias("up"), (F.col("total") + F.col("more")).alias("total"), (F.col("n_turns") + F.col("turns")).alias("n_turns"))
        state, before = stored(state.where("up IS NULL").unionByName(moved), "roots"), waiting
    return state.where("up IS NULL").select("node", "total", "n_turns")


def _leaves(messages: DataFrame, found: DataFrame) -> DataFrame:
    """The rooted messages that nobody replies to."""
    return found.join(messages.select(F.col("parent").alias("node")).where("node IS NOT NULL").distinct(), "node", "left_anti")


def branches(messages: DataFrame, leaves: DataFrame | None = None, found: DataFrame | None = None) -> DataFrame:
    """(leaf, node, back) of ``messages(node, parent, score)``: every node of the path that ends at a leaf, ``back`` steps
    before it, for all leaves or those of ``leaves(node)``. A parent that is missing makes a root; messages that reply
    into a cycle have no root and are left out."""
    found = rooted(messages) if found is None else found
    nodes = messages.select("node", "parent").join(found.select("node"), "node", "left_semi")
    known = nodes.select(F.col("node").alias("parent")).distinct()
    jumps = stored(nodes.where("parent IS NOT NULL").join(known, "parent", "left_semi").select("node", F.col("parent").alias("up")), "jumps")
    leaves = _leaves(messages, found) if leaves is None else leaves
    paths = leaves.select(F.col("node").alias("leaf"), "node", F.lit(0).cast("long").alias("back")).distinct()
    paths, step = stored(paths, "paths"), 1
    while not jumps.isEmpty():
        # what is less than `step` steps above a leaf is known; the jump doubles that
        further = paths.join(jumps, "node").select("leaf", F.col("up").alias("node"), (F.col("back") + step).alias("back"))
        paths = stored(paths.union(further), "paths")
        ahead = jumps.select(F.col("node").alias("up"), F.col("up").alias("top"))
        # a jump is only needed while a path still ends below its target
        jumps = stored(jumps.join(ahead, "up").select("node", F.col("top").alias("up")), "jumps")
        step *= 2
    return paths


def select_branches(messages: DataFrame, per_tree: int = 1) -> DataFrame:
    """(leaf, score, n_turns, rank) of the best ``per_tree`` branches per tree of
    ``messages(tree, node, parent, score)``: the mean score of the messages, ties to the smaller leaf.

    Leaves are ranked on one row each; only the chosen paths are written out."""
    found = rooted(messages)
    scored = _leaves(messages, found).join(messages.select("tree", "node"), "node").select(
        "tree", F.col("node").alias("leaf"), (F.col("total") / F.col("n_turns")).alias("score"), "n_turns")
    over = Window.partitionBy("tree").orderBy(F.desc("score"), "leaf")
    # row_number() <= n is limited per task before the shuffle, so a huge tree is no single group
    ranked = stored(scored.withColumn("rank", F.row_number().over(over)).where(F.col("rank") <= per_tree), "ranked")
    paths = branches(messages, ranked.select(F.col("leaf").alias("node")), found)
    return paths.join(ranked, "leaf").select("tree", "leaf", "node", "back", "score", "n_turns", "rank")


def format_branches(messages: DataFrame, per_tree: int = 1) -> DataFrame:
    """(tree, rank, score, formatted, loss_spans) of every chosen branch of
    ``messages(tree, node, parent, role, text, score)``.

    ``node`` is unique over all trees. ``loss_spans`` are (start, end) in code points of ``formatted``. A null role or
    text counts as empty. Other columns are ignored, an empty table gives an empty table.
    """
    own = messages.select("tree", "node", "parent", "score")
    chosen = select_branches(own, per_tree).drop("tree")
    head = F.concat(F.lit("### "), escape(F.col("role"), True), F.lit(": "))
    body = escape(F.col("text"))
    turns = chosen.join(
        messages.select("tree", "node", head.alias("head"), body.alias("body"), (F.coalesce("role", F.lit("")) == "assistant").alias("loss")), "node"
    )
    turn = F.struct(
        (-F.col("back")).alias("order"), "head", "body", "loss", F.char_length("head").alias("head_size"), F.char_length("body").alias("body_size")
    )
    paths = turns.groupBy("tree", "leaf").agg(F.first("rank").alias("rank"), F.first("score").alias("score"), F.sort_array(F.collect_list(turn)).alias("turns"))
    formatted = F.array_join(F.transform("turns", lambda t: F.concat(t["head"], t["body"], F.lit(END + "\n"))), "")
    empty = F.array().cast("array<struct<start:int,end:int>>")

    def walk(acc: Column, t: Column) -> Column:
        start = acc["at"] + t["head_size"]
        end = start + t["body_size"]
        span = F.array(F.struct(start.alias("start"), end.alias("end")))
        return F.struct((end + len(END) + 1).alias("at"), F.when(t["loss"], F.concat(acc["spans"], span)).otherwise(acc["spans"]).alias("spans"))

    spans = F.aggregate("turns", F.struct(F.lit(0).alias("at"), empty.alias("spans")), walk, lambda acc: acc["spans"])
    return paths.select("tree", "rank", "score", formatted.alias("formatted"), spans.alias("loss_spans"))


def threads(conversations: DataFrame) -> DataFrame:
    """The rows of ``conversations(conv_id, turn, role, text)`` as messages: every row replies to the one before it.

    Rows are ordered by turn, then role and text, nulls first, so rows with the same turn all stay; a null
    conv_id is a conversation of its own.
    """
    rows = conversations.select(F.col("conv_id").cast("long").alias("tree"), "turn", "role", "text")
    over = Window.partitionBy("tree").orderBy("turn", "role", "text")
    rows = rows.withColumn("place", F.row_number().over(over))
    # a node is named by its tree and place
    return rows.select(
        "tree", F.struct("tree", "place").alias("node"),
        F.when(F.col("place") > 1, F.struct("tree", (F.col("place") - 1).alias("place"))).alias("parent"),
        "role", "text", F.lit(0.0).alias("score"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """Turns and loss text read from ``formatted`` and ``loss_spans`` alone: adds n_turns, turns_sha256, loss_chars,
    loss_sha256, formatted_chars."""
    parts = F.slice(F.split("formatted", END + "\n", -1), 1, F.size(F.split("formatted", END + "\n", -1)) - 1)

    def turn(part: Column) -> Column:
        at = F.instr(part, ": ")
        role = unescape(F.substring(part, F.lit(5), at - 5))
        return F.concat(role, F.lit("\n"), unescape(F.substring(part, at + 2, F.char_length(part))), F.lit("\n"))

    masked = F.transform("loss_spans", lambda s: unescape(F.substring(F.col("formatted"), s["start"] + 1, s["end"] - s["start"])))
    loss = F.array_join(masked, "")
    return formatted.select(
        "*", F.size(parts).cast("long").alias("n_turns"), F.sha2(F.array_join(F.transform(parts, turn), ""), 256).alias("turns_sha256"),
        F.char_length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )
