"""Chat formatting of reply trees, in DataFrame operations only.

Pointer doubling by self-joins finds every message's root, depth and score sum in a number of rounds
that grows with the logarithm of the depth; branches (root-to-leaf paths) are ranked by score within
their tree; the same doubled pointers then enumerate the messages of the chosen branches only, and
each branch becomes one conversation in a template with escaped control strings and a loss mask."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cairn.llm.common import cut

START, END = "<|im_start|>", "<|im_end|>\n"  # fixed values: turn marks of the template
# What follows an opening sign in a control string; fixed values of the public chat templates.
_REST = r"(?=\||/?s>|/?unk>|</?SYS>>|/?INST\])"
MAX_ROUNDS = 40  # paths of up to 2^40 messages


def escape(text: Column) -> Column:
    """Puts one more ``~`` behind the opening sign of every (also already escaped) control string."""
    return F.regexp_replace(text, r"([<\[])(~*)" + _REST, "$1$2~")


def unescape(text: Column) -> Column:
    """Takes that ``~`` away again: the exact inverse of ``escape`` for every text."""
    return F.regexp_replace(text, r"([<\[])(~*)~" + _REST, "$1$2")


def escape_role(role: Column) -> Column:
    """A role ends at its line's end, so line ends inside it are written as %0A."""
    return escape(F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")))


def unescape_role(role: Column) -> Column:
    return F.replace(F.replace(unescape(role), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def branches(nodes: DataFrame, top: int | None = None) -> DataFrame:
    """``(root, leaf, branch_score, branch_rank, node, depth)``: the messages of the chosen branches.

    ``nodes(node, parent, score)``: node ids are unique (of repeated ids any one counts); a null or
    unknown parent makes a root; a null score counts as 0; a null node is no message. A branch's score
    is the mean of its messages' scores; branches of a tree rank by score, ties by the smaller leaf
    id; ``top`` keeps that many per tree (None: all). Messages on or below a cycle have no root and are
    in no branch. Only chosen branches are enumerated, so rows out = the messages they hold."""
    n = (nodes.filter("node IS NOT NULL")
         .groupBy("node").agg(F.min(F.struct("parent", F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"))).alias("x"))
         .select("node", F.col("x.parent").alias("parent"), F.col("x.score").alias("score")))
    n = cut(n)
    known = n.select(F.col("node").alias("parent"), F.lit(True).alias("known"))
    # a row jumps 2^k messages up: up = where it lands (null: beyond the root), top = last message passed
    jump = cut(n.join(known, "parent", "left")
               .select("node", F.when(F.col("known"), F.col("parent")).alias("up"), F.col("node").alias("root"),
                       F.lit(1).cast("long").alias("depth"), "score"))
    jumps = []
    for _ in range(MAX_ROUNDS):
        open_rows = jump.filter("up IS NOT NULL")
        left = open_rows.count()
        if not left:
            break
        if jumps and left == before:  # every path that ends moves on each round: the rest are cycles
            break
        before = left
        jumps.append(open_rows.select("node", "up"))
        step = jump.select(F.col("node").alias("up"), F.col("up").alias("up2"), F.col("root").alias("root2"),
                           F.col("depth").alias("depth2"), F.col("score").alias("score2"))
        jump = cut(jump.filter("up IS NULL").unionByName(
            open_rows.join(step, "up").select("node", F.col("up2").alias("up"), F.col("root2").alias("root"),
                                              (F.col("depth") + F.col("depth2")).alias("depth"),
                                              (F.col("score") + F.col("score2")).alias("score"))))
    rooted = jump.filter("up IS NULL")
    inner = n.select(F.col("parent").alias("node")).filter("node IS NOT NULL").distinct()
    ends = (rooted.join(inner, "node", "left_anti")
            .select("root", F.col("node").alias("leaf"), F.col("depth").alias("leaf_depth"),
                    (F.col("score") / F.col("depth")).alias("branch_score")))
    rank = F.row_number().over(Window.partitionBy("root").orderBy(F.desc("branch_score"), "leaf"))
    ends = ends.withColumn("branch_rank", rank)
    if top is not None:
        ends = ends.filter(F.col("branch_rank") <= top)
    ends = cut(ends)
    path = ends.select("leaf", F.col("leaf").alias("node"), F.col("leaf_depth").alias("depth"))
    for k, up in enumerate(jumps):
        path = cut(path.unionByName(path.join(up, "node").select(
            "leaf", F.col("up").alias("node"), (F.col("depth") - (1 << k)).alias("depth"))))
    return path.join(ends.drop("leaf_depth"), "leaf").select("root", "leaf", "branch_score", "branch_rank", "node", "depth")


def format_branches(chosen: DataFrame, messages: DataFrame, learn_role: str = "assistant") -> DataFrame:
    """One row per branch: ``(root, leaf, branch_score, branch_rank, formatted, loss_spans)``.

    ``messages(node, role, text)``; null role or text: empty. ``loss_spans`` are byte ranges
    (start, length) of ``formatted`` in UTF-8, in order: the escaped texts of ``learn_role``'s turns,
    nothing else. A formatted branch is one value, so it must fit one (2 GB)."""
    said = messages.select("node", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    turns = chosen.join(said, "node").select(
        "root", "leaf", "branch_score", "branch_rank", "depth", (F.col("role") == learn_role).alias("learn"),
        F.concat(F.lit(START), escape_role(F.col("role")), F.lit("\n")).alias("head"), escape(F.col("text")).alias("body"))
    turns = turns.withColumn("head_bytes", F.octet_length("head")).withColumn("body_bytes", F.octet_length("body"))
    before = F.sum(F.col("head_bytes") + F.col("body_bytes") + len(END)).over(
        Window.partitionBy("leaf").orderBy("depth").rowsBetween(Window.unboundedPreceding, -1))
    turns = turns.withColumn("start", (F.coalesce(before, F.lit(0)) + F.col("head_bytes")).cast("long"))
    return (turns.groupBy("root", "leaf", "branch_score", "branch_rank")
            .agg(F.array_sort(F.collect_list(F.struct("depth", "head", "body", "learn", "start", "body_bytes"))).alias("turns"))
            .select("root", "leaf", "branch_score", "branch_rank",
                    F.array_join(F.transform("turns", lambda t: F.concat(t["head"], t["body"], F.lit(END))), "").alias("formatted"),
                    F.transform(F.filter("turns", lambda t: t["learn"]),
                                lambda t: F.struct(t["start"].alias("start"), t["body_bytes"].cast("long").alias("length"))).alias("loss_spans")))


def read_back(formatted: DataFrame) -> DataFrame:
    """``formatted`` with ``turns array<struct<role, text>>`` and ``loss_texts array<string>`` parsed
    from its ``formatted`` and ``loss_spans`` alone."""
    parts = F.slice(F.split("formatted", r"<\|im_start\|>", -1), 2, F.size(F.split("formatted", r"<\|im_start\|>", -1)))
    role = lambda p: F.substring_index(p, "\n", 1)
    turns = F.transform(parts, lambda p: F.struct(
        unescape_role(role(p)).alias("role"),
        unescape(F.substr(p, F.char_length(role(p)) + 2, F.char_length(p) - F.char_length(role(p)) - 1 - len(END))).alias("text")))
    return (formatted.withColumn("turns", turns).withColumn("raw", F.encode("formatted", "utf-8"))
            .withColumn("loss_texts", F.transform("loss_spans", lambda s: unescape(F.decode(
                F.substr(F.col("raw"), (s["start"] + 1).cast("int"), s["length"].cast("int")), "utf-8"))))
            .drop("raw"))


def chains(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text") -> DataFrame:
    """Plain conversations as reply trees: every turn answers the one before it.

    Turns order by turn (null first), ties by role and text; rows of a null conversation id form one
    conversation. Returns ``(node, parent, score, conv_id, role, text)``."""
    key = F.coalesce(F.col(conv_col).cast("string"), F.lit("null"))
    at = F.row_number().over(Window.partitionBy(conv_col).orderBy(turn_col, role_col, text_col))
    t = conversations.select(F.col(conv_col).alias("conv_id"), key.alias("key"), F.col(role_col).alias("role"),
                             F.col(text_col).alias("text"), at.alias("at"))
    name = lambda i: F.concat("key", F.lit(":"), i.cast("string"))
    return t.select(name(F.col("at")).alias("node"), F.when(F.col("at") > 1, name(F.col("at") - 1)).alias("parent"),
                    F.lit(0.0).alias("score"), "conv_id", "role", "text")
