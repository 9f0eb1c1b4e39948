"""Reply trees as conversations: paths from root to leaf, ranked, and formatted for training.

Messages have a parent in their tree. Self-joins double the reach of each
message: its parent, the parent's parent, then four up, eight up, until all
reach past their root. The same tables then take the path of a leaf apart into
single messages, the other way round: a stretch of eight messages up from here
is one of four from here and one of four from four up. So a path of a thousand
messages takes ten joins, each on the key of a message, and no row ever holds
more than one message before the text is put together.

Paths are ranked in their tree by the mean score of their messages; the chosen
ones are written with one header for each turn. Control strings inside a text
get a backslash after their first character (one more, if they have some), which
``unescaped`` takes out again. The loss mask lists the spans of the assistant's
texts in the formatted conversation, in code points.

All of it is DataFrame functions.

Defined results: null texts and roles are empty ones; a message whose parent is
null or not in its tree is a root; messages that lead into a circle have no root
and so no path; of rows that share tree and id the smallest counts; rows without
id are a path of their own each, equal ones once; null is a tree like others; a
null score is 0, and equal scores rank by the leaf's id; an empty table gives no
conversation; further columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postlens.llm.common import stored

START, END = "<|im_start|>", "<|im_end|>"
# What is control text in common chat templates, after its first character.
CONTROL = r"(\|im_start\|>|\|im_end\|>|\|endoftext\|>|/?s>|</?SYS>>|/?INST\])"
TRAINED = "assistant"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, rf"([<\[])(\\*){CONTROL}", r"$1\\$2$3")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, rf"([<\[])\\(\\*){CONTROL}", "$1$2$3")


def header(role: Column) -> Column:
    """The start of a turn; a role is one line."""
    line = F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A"))
    return F.concat(F.lit(START), escaped(line), F.lit("\n"))


def role_of(line: Column) -> Column:
    return F.replace(F.replace(unescaped(line), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


# --- trees ------------------------------------------------------------------------


def messages(df: DataFrame, tree: str, id_col: str, parent: str, role: str, text: str, score: str) -> DataFrame:
    """The messages with string keys, one row for each key, stored."""
    key = lambda c: F.col(f"`{c}`").cast("string")
    rows = df.select(
        F.coalesce(key(tree), F.lit("\0")).alias("tree"), F.col(f"`{tree}`").alias("tree_id"), key(id_col).alias("id"), key(parent).alias("parent"),
        F.coalesce(F.col(f"`{role}`"), F.lit("")).alias("role"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"),
        F.coalesce(F.col(f"`{score}`").cast("double"), F.lit(0.0)).alias("score"),
    )
    alone = F.concat(F.lit("\0"), F.sha2(F.concat_ws("\0", "parent", "role", "text", "score"), 256))
    rows = rows.select(
        "tree", "tree_id", F.coalesce("id", alone).alias("id"), F.when(F.col("id").isNotNull(), F.col("parent")).alias("parent"), "role", "text", "score"
    )
    first = F.row_number().over(Window.partitionBy("tree", "id").orderBy("parent", "role", "text", "score"))
    return stored(rows.withColumn("_n", first).where("_n = 1").drop("_n"), "messages")


def reaches(nodes: DataFrame) -> list[DataFrame]:
    """For 1, 2, 4, ... steps, the message so many steps up: ``(tree, id, up)``; rows past the root are left out.

    Messages on a circle, or under one, are left out of all.
    """
    keys = nodes.select("tree", F.col("id").alias("up"))
    reach = [stored(nodes.select("tree", "id", F.col("parent").alias("up")).join(keys, ["tree", "up"]).select("tree", "id", "up"), "reach")]
    count = nodes.count()
    while 2 ** (len(reach) - 1) <= count and not reach[-1].isEmpty():
        last = reach[-1]
        further = last.select("tree", F.col("id").alias("up"), F.col("up").alias("_up"))
        reach.append(stored(last.join(further, ["tree", "up"]).select("tree", "id", F.col("_up").alias("up")), "reach"))
    return reach


def paths(nodes: DataFrame) -> DataFrame:
    """``(tree, leaf, id, above)`` for each message of each path; ``above`` counts from the leaf up."""
    reach = reaches(nodes)
    endless = reach.pop().select("tree", "id")  # empty without circles
    parents = reach[0].select("tree", F.col("up").alias("id")) if reach else endless
    leaves = nodes.select("tree", "id").join(parents, ["tree", "id"], "left_anti").join(endless, ["tree", "id"], "left_anti")
    rows = leaves.select("tree", F.col("id").alias("leaf"), "id", F.lit(0).cast("long").alias("above"))
    for k in reversed(range(len(reach))):
        here, further = F.struct("id", "above"), F.struct(F.col("up").alias("id"), (F.col("above") + 2**k).alias("above"))
        halves = F.when(F.col("up").isNull(), F.array(here)).otherwise(F.array(here, further))
        rows = rows.join(reach[k], ["tree", "id"], "left").select("tree", "leaf", F.inline(halves))
    return rows


def chosen(found: DataFrame, nodes: DataFrame, best: int | None) -> DataFrame:
    """The messages of the ``best`` paths of each tree (all, if None), with ``rank``, role and text; stored."""
    full = stored(found.join(nodes, ["tree", "id"]), "paths")
    scores = full.groupBy("tree", "leaf").agg(F.avg("score").alias("path_score"))
    rank = F.row_number().over(Window.partitionBy("tree").orderBy(F.desc("path_score"), "leaf"))
    ranked = scores.withColumn("rank", rank)
    return full.join(ranked if best is None else ranked.where(F.col("rank") <= best), ["tree", "leaf"])


# --- formatting --------------------------------------------------------------------


def format_trees(
    df: DataFrame, tree: str = "tree", id_col: str = "id", parent: str = "parent", role: str = "role", text: str = "text",
    score: str = "score", best: int | None = 1,
) -> DataFrame:
    """One conversation for each chosen path: ``(tree, leaf, rank, path_score, formatted, loss)``.

    ``loss`` holds ``(start, length)`` of the texts to learn, in code points.
    """
    nodes = messages(df, tree, id_col, parent, role, text, score)
    turns = chosen(paths(nodes), nodes, best).select(
        "tree", "tree_id", "leaf", "rank", "path_score", "above", "role", header(F.col("role")).alias("_head"), escaped(F.col("text")).alias("_text"),
    ).withColumn("_turn", F.concat("_head", "_text", F.lit(f"{END}\n")))
    before = Window.partitionBy("tree", "leaf").orderBy(F.desc("above")).rowsBetween(Window.unboundedPreceding, -1)
    placed = turns.withColumn("_start", F.coalesce(F.sum(F.length("_turn")).over(before), F.lit(0)) + F.length("_head"))
    span = F.struct((-F.col("above")).alias("at"), F.col("_start").alias("start"), F.length("_text").alias("length"))
    return placed.groupBy("tree", "leaf").agg(
        F.first("tree_id").alias("tree_id"), F.first("rank").alias("rank"), F.first("path_score").alias("path_score"),
        F.sort_array(F.collect_list(F.struct((-F.col("above")).alias("at"), "_turn"))).alias("_turns"),
        F.sort_array(F.collect_list(F.when(F.col("role") == TRAINED, span))).alias("_loss"),
    ).select(
        F.col("tree_id").alias(tree), "leaf", "rank", "path_score",
        F.array_join(F.col("_turns")["_turn"], "").alias("formatted"),
        F.transform("_loss", lambda s: F.struct(s["start"].alias("start"), s["length"].alias("length"))).alias("loss"),
    )


def parsed(formatted: Column) -> Column:
    """The turns of a formatted conversation: ``array<struct<role, text>>``."""
    pieces = F.slice(F.split(formatted, r"<\|im_start\|>", -1), 2, F.length(formatted) + 1)
    body = lambda piece: F.substring_index(piece, END, 1)
    line = lambda piece: F.substring_index(piece, "\n", 1)
    return F.transform(
        pieces,
        lambda p: F.struct(
            role_of(line(p)).alias("role"),
            unescaped(F.substr(body(p), F.length(line(p)) + 2, F.length(p) + 1)).alias("text"),
        ),
    )


def loss_text(formatted: Column, loss: Column) -> Column:
    """All text under the mask, unescaped, nothing between."""
    return F.array_join(F.transform(loss, lambda s: unescaped(F.substr(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int")))), "")


def chains(df: DataFrame, conversation: str, turn: str, role: str, text: str) -> DataFrame:
    """Linear conversations as reply trees: each turn answers the one before it; equal turns by role, then text."""
    order = Window.partitionBy(conversation).orderBy(turn, role, text)
    at = F.row_number().over(order)
    return df.select(
        F.col(conversation).alias("tree"), at.alias("id"), (at - 1).alias("parent"), F.col(role).alias("role"),
        F.col(text).alias("text"), F.lit(0.0).alias("score"),
    )
