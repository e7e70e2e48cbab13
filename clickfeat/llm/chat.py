"""Chat formatting of reply trees, with built-in functions only.

A tree's messages point to the message they answer. Self-joins that double their reach enumerate the path from the root
to every leaf, branches are ranked by score, and each chosen path is formatted as one conversation:

    ### role: text</turn>

with a line feed after each turn. Inside roles and texts a backslash becomes ``\\\\``, ``<`` becomes ``\\l``, ``#``
becomes ``\\h`` and, in roles, ``:`` becomes ``\\c``, so no marker can come from a text and every text can be read back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickfeat.llm.common import stored

TURN_START, ROLE_END, TURN_END = "### ", ": ", "</turn>\n"
_CODES = [("<", "\\l"), ("#", "\\h"), (":", "\\c")]


def _plain(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def escape(text: Column, role: bool = False) -> Column:
    out = F.replace(_plain(text), F.lit("\\"), F.lit("\\\\"))
    for plain, code in _CODES if role else _CODES[:2]:
        out = F.replace(out, F.lit(plain), F.lit(code))
    return out


def unescape(text: Column, role: bool = False) -> Column:
    # Escaped backslashes pair up from the left, so the pieces between them hold only the other codes.
    def piece(part: Column) -> Column:
        for plain, code in _CODES if role else _CODES[:2]:
            part = F.replace(part, F.lit(code), F.lit(plain))
        return part

    return F.array_join(F.transform(F.split(text, r"\\\\"), piece), "\\")


def paths(messages: DataFrame) -> DataFrame:
    """All root-to-leaf paths: (tree, leaf, msg, up), ``up`` counting the answers from ``msg`` down to the leaf.

    ``messages`` has (tree, msg, parent); ``msg`` is unique in its tree and not NULL. A NULL or unknown parent makes a
    root. Messages whose parents form a ring have no root and so no path. Round r joins every path found so far with the
    table of 2^r-fold parents, so a path of n messages takes log2(n) rounds; both tables are written each round.
    """
    nodes = stored(messages.select("tree", "msg", "parent"), "chat-nodes")
    known = nodes.select(F.col("tree").alias("_t"), F.col("msg").alias("_m"))
    same = lambda a, b: F.col(a).eqNullSafe(F.col(b))
    jumps = nodes.join(known, same("tree", "_t") & (F.col("parent") == F.col("_m"))).select("tree", "msg", "parent")
    jumps = stored(jumps, "chat-jumps")
    answered = jumps.select(F.col("tree").alias("_t"), F.col("parent").alias("_m")).distinct()
    leaves = nodes.join(answered, same("tree", "_t") & (F.col("msg") == F.col("_m")), "left_anti")
    found = [stored(leaves.select("tree", F.col("msg").alias("leaf"), "msg", F.lit(0).cast("long").alias("up")), "chat-paths")]
    largest = nodes.groupBy("tree").count().agg(F.max("count")).first()[0] or 0
    step = 1
    while step <= largest:
        far = jumps.select(F.col("tree").alias("_t"), F.col("msg").alias("_m"), F.col("parent").alias("_p"))
        so_far = found[0]
        for more in found[1:]:
            so_far = so_far.unionByName(more)
        longer = so_far.join(far, same("tree", "_t") & (F.col("msg") == F.col("_m")))
        longer = stored(longer.select("tree", "leaf", F.col("_p").alias("msg"), (F.col("up") + step).alias("up")), "chat-paths")
        if longer.isEmpty():
            break
        found.append(longer)
        jumps = stored(
            jumps.join(far, same("tree", "_t") & (F.col("parent") == F.col("_m"))).select("tree", "msg", F.col("_p").alias("parent")),
            "chat-jumps",
        )
        step *= 2
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    if step > largest and len(found) > 1:  # only rings go on past the largest tree
        rings = out.where(F.col("up") >= largest).select(F.col("tree").alias("_t"), F.col("leaf").alias("_m")).distinct()
        out = out.join(rings, same("tree", "_t") & (F.col("leaf") == F.col("_m")), "left_anti")
    return out


def rank_branches(found: DataFrame, messages: DataFrame, keep: int = 1) -> DataFrame:
    """The ``keep`` best paths of each tree with their messages: (tree, leaf, branch, place, role, text).

    A branch's score is the sum of its messages' ``score`` (NULL: 0); ties go to the smaller leaf.
    """
    theirs = messages.select(F.col("tree").alias("_t"), F.col("msg").alias("_m"), "role", "text", "score")
    joined = found.join(theirs, F.col("tree").eqNullSafe(F.col("_t")) & (F.col("msg") == F.col("_m"))).drop("_t", "_m")
    scores = joined.groupBy("tree", "leaf").agg(
        F.sum(F.coalesce("score", F.lit(0.0))).alias("_score"), F.max("up").alias("_depth")
    )
    best = Window.partitionBy("tree").orderBy(F.desc("_score"), "leaf")
    chosen = scores.withColumn("branch", F.row_number().over(best)).where(F.col("branch") <= keep)
    chosen = chosen.select(F.col("tree").alias("_t"), F.col("leaf").alias("_l"), "branch", "_depth")
    out = joined.join(chosen, F.col("tree").eqNullSafe(F.col("_t")) & (F.col("leaf") == F.col("_l")))
    return out.select("tree", "leaf", "branch", (F.col("_depth") - F.col("up")).alias("place"), "role", "text")


def format_turns(turns: DataFrame, trained_role: str = "assistant") -> DataFrame:
    """One row per (tree, leaf, branch): ``formatted`` and ``loss_spans``, the code-point ranges [start, end) of the
    escaped texts of ``trained_role``. ``turns`` has (tree, leaf, branch, place, role, text); NULL role or text is empty."""
    head = F.concat(F.lit(TURN_START), escape(F.col("role"), role=True), F.lit(ROLE_END))
    pieces = turns.select("tree", "leaf", "branch", "place", "role", head.alias("_head"), escape(F.col("text")).alias("_text"))
    pieces = pieces.withColumn("_piece", F.concat("_head", "_text", F.lit(TURN_END)))
    before = Window.partitionBy("tree", "leaf", "branch").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.length("_piece")).over(before), F.lit(0)) + F.length("_head")
    pieces = pieces.withColumn("_start", start.cast("long"))
    span = F.struct(F.col("_start").alias("start"), (F.col("_start") + F.length("_text")).alias("end"))
    trained = F.coalesce(F.col("role") == trained_role, F.lit(False))
    return (
        pieces.groupBy("tree", "leaf", "branch")
        .agg(
            F.sort_array(F.collect_list(F.struct("place", "_piece"))).alias("_pieces"),
            F.sort_array(F.collect_list(F.when(trained, span))).alias("loss_spans"),
        )
        .select("tree", "leaf", "branch", F.array_join("_pieces._piece", "").alias("formatted"), "loss_spans")
    )


def parse(formatted: Column) -> Column:
    """The turns of a formatted conversation, as array<struct<role, text>>."""

    def turn(part: Column) -> Column:
        body = part.substr(F.lit(len(TURN_START) + 1), F.length(part))
        cut = F.instr(body, F.lit(ROLE_END))
        return F.struct(
            unescape(body.substr(F.lit(1), cut - 1), role=True).alias("role"),
            unescape(body.substr(cut + len(ROLE_END), F.length(body))).alias("text"),
        )

    parts = F.split(formatted, TURN_END)
    return F.transform(F.slice(parts, 1, F.size(parts) - 1), turn)


def masked(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    take = lambda s: unescape(formatted.substr((s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))
    return F.array_join(F.transform(spans, take), "")


def format_trees(messages: DataFrame, keep: int = 1, trained_role: str = "assistant") -> DataFrame:
    """The best branches of every reply tree, formatted: (tree, leaf, branch, formatted, loss_spans).

    ``messages`` has (tree, msg, parent, role, text, score); other columns are not read. See ``paths`` for rings and
    unknown parents. NULL tree is a tree of its own. A tree without messages does not exist, so an empty table gives no
    rows.
    """
    return format_turns(rank_branches(paths(messages), messages, keep), trained_role)


def turns_as_tree(conversations: DataFrame) -> DataFrame:
    """Conversations (conv_id, turn, role, text) as trees whose messages answer the turn before.

    NULL turns come first; rows of one turn follow each other by role and text, repeated rows stay apart.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    numbered = conversations.select(
        F.col("conv_id").alias("tree"), F.row_number().over(order).cast("long").alias("msg"), "role", "text"
    )
    return numbered.select(
        "tree", "msg", F.when(F.col("msg") > 1, F.col("msg") - 1).alias("parent"), "role", "text", F.lit(0.0).alias("score")
    )
