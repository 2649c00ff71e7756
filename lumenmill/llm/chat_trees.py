"""Reply trees to chat text, with DataFrame functions alone.

Nodes have a tree, a number, a parent's number, a role, a text and a score. Iterative self-joins
double the distance that each node sees towards its root: first they sum the scores of every
root-to-leaf path, which ranks a tree's branches, then they list the ancestors of the chosen
leaves. Each chosen path becomes one conversation.

Template: ``<|im_start|>role\\ntext<|im_end|>\\n`` for each turn. In roles and texts ``&`` becomes ``&amp;`` and
``<|`` becomes ``&lt;|``, in roles a new line becomes ``&#10;``; reading back undoes it, so no text can
forge a control string. The loss mask lists code-point ranges of the formatted text: every
assistant text.

Null roles and texts are empty, a null score is 0, a null tree is a tree of its own. A parent that is missing, null or doesn't come
before its node is ignored: such a node is a root, and there are no cycles. Nodes with one number in a tree must have been told apart
before (``linear_nodes`` does: turn, role, text; all rows stay). Branches of equal score rank by their leaf's number. An empty
table gives none; extra columns are ignored. One conversation is one row, so it must fit in a task's memory; nothing else must."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import storage

OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"


def escape(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<|"), F.lit("&lt;|"))


def unescape(c: Column) -> Column:
    return F.replace(F.replace(F.replace(c, F.lit("&#10;"), F.lit("\n")), F.lit("&lt;"), F.lit("<")), F.lit("&amp;"), F.lit("&"))


def linear_nodes(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Every conversation as a tree of one branch."""
    rows = rows.select(F.col(conv_col).cast("long").alias("tree"), F.col(turn_col).cast("long").alias("turn"), F.coalesce(F.col(role_col), F.lit("")).alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    w = Window.partitionBy("tree").orderBy("turn", "role", "text")
    return rows.withColumn("node", F.row_number().over(w).cast("long")).select("tree", "node", (F.col("node") - 1).alias("parent"), "role", "text", F.lit(0.0).alias("score"))


def _steps(start: DataFrame, folder: str) -> list[DataFrame]:
    """Tables of 1, 2, 4, ... steps up (tree, node, up, gain): the node that many steps above, and the scores on the way. The last has the longest steps there are."""
    ups, k = [start], 0
    while True:
        a, k = ups[-1], k + 1
        b = a.select("tree", F.col("node").alias("up"), F.col("up").alias("top"), F.col("gain").alias("more"))
        more = storage.staged(a.join(b, ["tree", "up"]).select("tree", "node", F.col("top").alias("up"), (F.col("gain") + F.col("more")).alias("gain")), f"{folder}/up-{k}")
        if not more.limit(1).count():
            return ups
        ups.append(more)


def branches(nodes: DataFrame, best: int | None = None) -> DataFrame:
    """(tree, leaf, rank, node, depth): the nodes of the ``best`` highest-scored root-to-leaf paths of every tree (None: of all), root first by falling depth."""
    folder = storage.workspace(nodes.sparkSession, "trees")
    slim = nodes.select(F.coalesce(F.col("tree").cast("string"), F.lit("")).alias("tree"), "node", "parent", F.coalesce("score", F.lit(0.0)).alias("score"))
    slim = storage.staged(slim, f"{folder}/nodes")
    known = slim.select("tree", F.col("node").alias("parent"), F.col("score").alias("gain"))
    start = storage.staged(slim.filter("parent < node").join(known, ["tree", "parent"]).select("tree", "node", F.col("parent").alias("up"), "gain"), f"{folder}/up-0")
    leaves = slim.join(start.select("tree", F.col("up").alias("node")).distinct(), ["tree", "node"], "left_anti").select("tree", F.col("node").alias("leaf"), "score")
    ups = _steps(start, folder)
    if best is not None:
        sums = leaves.select("tree", "leaf", F.col("leaf").alias("at"), F.col("score").alias("sum"))
        for up in reversed(ups):  # from the longest steps down: sums of powers of two give every depth
            sums = sums.join(up.select("tree", F.col("node").alias("at"), "up", "gain"), ["tree", "at"], "left").select("tree", "leaf", F.coalesce("up", "at").alias("at"), (F.col("sum") + F.coalesce("gain", F.lit(0.0))).alias("sum"))
        w = Window.partitionBy("tree").orderBy(F.desc("sum"), "leaf")
        chosen = sums.withColumn("rank", F.row_number().over(w).cast("long")).filter(F.col("rank") <= best).select("tree", "leaf", "rank")
    else:
        chosen = leaves.select("tree", "leaf", F.lit(None).cast("long").alias("rank"))
    chosen = storage.staged(chosen, f"{folder}/chosen")
    seen = chosen.select("tree", "leaf", "rank", F.col("leaf").alias("node"), F.lit(0).cast("long").alias("depth"))
    for k, up in enumerate(ups):  # what is seen of each leaf's ancestors doubles
        further = seen.join(up.select("tree", "node", "up"), ["tree", "node"]).select("tree", "leaf", "rank", F.col("up").alias("node"), (F.col("depth") + (1 << k)).alias("depth"))
        seen = storage.staged(seen.unionByName(further), f"{folder}/seen-{k}")
    return seen


def formatted(nodes: DataFrame, best: int | None = 1) -> DataFrame:
    """conv_id, leaf, rank, text, mask: one row for every chosen branch."""
    paths = branches(nodes, best)
    rows = nodes.select(F.col("tree").alias("conv_id"), F.coalesce(F.col("tree").cast("string"), F.lit("")).alias("tree"), "node", "role", "text").join(paths, ["tree", "node"])
    head = F.concat(F.lit(OPEN), F.replace(escape(F.coalesce("role", F.lit(""))), F.lit("\n"), F.lit("&#10;")), F.lit("\n"))
    body = escape(F.coalesce("text", F.lit("")))
    rows = rows.select("conv_id", "tree", "leaf", "rank", (-F.col("depth")).alias("pos"), "role", F.length(head).alias("n_head"), F.length(body).alias("n_body"), F.concat(head, body, F.lit(CLOSE)).alias("piece"))
    w = Window.partitionBy("tree", "leaf").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("at", F.coalesce(F.sum(F.length("piece")).over(w), F.lit(0)) + F.col("n_head"))
    turn = F.struct("pos", "piece", F.when(F.col("role") == "assistant", F.struct(F.col("at").alias("start"), (F.col("at") + F.col("n_body")).alias("end"))).alias("loss"))
    got = rows.groupBy("tree", "leaf", "rank").agg(F.max("conv_id").alias("conv_id"), F.array_sort(F.collect_list(turn)).alias("turns"))
    return got.select("conv_id", "leaf", "rank", F.array_join(F.transform("turns", lambda t: t["piece"]), "").alias("text"), F.array_compact(F.transform("turns", lambda t: t["loss"])).alias("mask"))


def read_back(chats: DataFrame) -> DataFrame:
    """Turns and loss text of formatted conversations, from the text and its mask."""
    pieces = F.filter(F.split("text", r"<\|im_end\|>\n"), lambda p: p != "")
    turns = F.transform(pieces, lambda p: F.concat(unescape(F.substring_index(F.substr(p, F.lit(len(OPEN) + 1)), "\n", 1)), F.lit("\n"), unescape(F.substr(p, F.instr(p, "\n") + 1)), F.lit("\n")))
    loss = F.transform("mask", lambda m: unescape(F.substr(F.col("text"), (m["start"] + 1).cast("int"), (m["end"] - m["start"]).cast("int"))))
    out = chats.select("conv_id", F.size(pieces).cast("long").alias("n_turns"), F.sha2(F.array_join(turns, "").cast("binary"), 256).alias("turns_sha256"), F.array_join(loss, "").alias("loss"), F.length("text").cast("long").alias("formatted_chars"))
    return out.select("conv_id", "n_turns", "turns_sha256", F.length("loss").cast("long").alias("loss_chars"), F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"), "formatted_chars")
