"""Chat formatting: reply trees to conversations, with DataFrame functions only.

Messages form trees (a parent per message, none for a root). Iterative self-joins double the
ancestor each message knows, so a path of n messages takes log2(n) rounds; the rounds also add
up the scores towards the root. Leaves are ranked by the score of their path, the chosen ones
are walked back to the root over the stored jumps, and each path is formatted as one text.

A turn is ``<|im_start|>role\\ntext<|im_end|>\\n``. Inside roles and texts ``&`` becomes ``&amp;`` and
``<|`` becomes ``&lt;|`` (in roles a line feed also becomes ``&#10;``), so no control string can appear
there and ``parse`` gets the turns back exactly. ``loss`` has one span (code points, end
exclusive) for each turn: the text of an assistant turn, empty for all others.

Defined cases: null role or text counts as empty; null tree keys are a tree of their own; a
parent that is null or absent makes a root; equal scores rank by smaller leaf; a tree without
rows gives no conversation; repeated rows must have been given distinct node numbers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

#: Fixed values of the template.
START, END = "<|im_start|>", "<|im_end|>"
MAX_ROUNDS = 40


def escape(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<|"), F.lit("&lt;|"))


def unescape(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("&lt;|"), F.lit("<|")), F.lit("&amp;"), F.lit("&"))


def escape_role(c: Column) -> Column:
    return F.replace(escape(c), F.lit("\n"), F.lit("&#10;"))


def unescape_role(c: Column) -> Column:
    return unescape(F.replace(c, F.lit("&#10;"), F.lit("\n")))


def jumps(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Tables of 1, 2, 4, ... steps up (tree, node, up), and (tree, node, total) to the root."""
    parents = nodes.select(F.col("tree").alias("t"), F.col("node").alias("n"))
    known = nodes.join(parents, F.col("tree").eqNullSafe(F.col("t")) & (F.col("parent") == F.col("n")), "left")
    state = cut_lineage(known.select("tree", "node", F.col("n").alias("up"), F.col("score").cast("double").alias("total")))
    tables = []
    for _ in range(MAX_ROUNDS):
        climbing = state.where("up is not null")
        if climbing.isEmpty():
            return tables, state.select("tree", "node", "total")
        tables.append(climbing.select("tree", "node", "up"))
        above = state.select(F.col("tree").alias("t"), F.col("node").alias("n"), F.col("up").alias("up_up"), F.col("total").alias("more"))
        met = climbing.join(above, F.col("tree").eqNullSafe(F.col("t")) & (F.col("up") == F.col("n")))
        met = met.select("tree", "node", F.col("up_up").alias("up"), (F.col("total") + F.col("more")).alias("total"))
        state = cut_lineage(state.where("up is null").union(met))
    raise ValueError("the parents form a cycle")


def best_paths(nodes: DataFrame, branches: int | None = None) -> DataFrame:
    """(tree, leaf, rank, node, back) for the ``branches`` best root-to-leaf paths of each tree (all: None).

    ``nodes`` has tree, node, parent and score; ``back`` counts steps from the leaf.
    """
    tables, totals = jumps(nodes)
    parents = nodes.select(F.col("tree").alias("t"), F.col("parent").alias("p")).where("p is not null").distinct()
    leaves = totals.join(parents, F.col("tree").eqNullSafe(F.col("t")) & (F.col("node") == F.col("p")), "left_anti")
    by_score = Window.partitionBy("tree").orderBy(F.desc("total"), "node")
    ranked = leaves.withColumn("rank", F.row_number().over(by_score))
    if branches is not None:
        ranked = ranked.where(F.col("rank") <= branches)
    path = ranked.select("tree", F.col("node").alias("leaf"), "rank", "node", F.lit(0).cast("long").alias("back"))
    for k in range(len(tables) - 1, -1, -1):
        path = cut_lineage(path)
        step = tables[k].select(F.col("tree").alias("t"), F.col("node").alias("n"), "up")
        higher = path.join(step, F.col("tree").eqNullSafe(F.col("t")) & (F.col("node") == F.col("n")))
        path = path.union(higher.select("tree", "leaf", "rank", F.col("up").alias("node"), F.col("back") + (1 << k)))
    return path


def format_paths(path: DataFrame, messages: DataFrame, learn: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """(tree, leaf, rank, formatted, loss): one row for each path; ``messages`` has tree, node, role, text."""
    said = messages.select(
        F.col("tree").alias("t"), F.col("node").alias("n"), escape_role(F.coalesce("role", F.lit(""))).alias("role"),
        escape(F.coalesce("text", F.lit(""))).alias("text"), F.coalesce(F.col("role").isin(*learn), F.lit(False)).alias("learn"))
    turns = path.join(said, F.col("tree").eqNullSafe(F.col("t")) & (F.col("node") == F.col("n")))
    head = F.concat(F.lit(START), "role", F.lit("\n"))
    turns = turns.select("tree", "leaf", "rank", "back", head.alias("head"), "text", "learn")
    size = F.length("head") + F.length("text") + len(END) + 1
    before = Window.partitionBy("tree", "leaf").orderBy(F.desc("back")).rowsBetween(Window.unboundedPreceding, -1)
    turns = turns.withColumn("at", F.coalesce(F.sum(size).over(before), F.lit(0)) + F.length("head"))
    end = F.col("at") + F.when(F.col("learn"), F.length("text")).otherwise(0)
    turn = F.struct((-F.col("back")).alias("place"), F.concat("head", "text", F.lit(END + "\n")).alias("piece"),
                    F.struct(F.col("at").alias("start"), end.alias("end")).alias("span"))
    whole = turns.groupBy("tree", "leaf", "rank").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    return whole.select("tree", "leaf", "rank", F.array_join("turns.piece", "").alias("formatted"), F.col("turns.span").alias("loss"))


def parse(formatted: Column) -> Column:
    """The turns of a formatted text, still escaped: array of (role, text)."""
    pieces = F.split(formatted, r"<\|im_end\|>\n")
    turns = F.slice(pieces, F.lit(1), F.size(pieces) - 1)  # what follows the last turn is empty

    def turn(piece: Column) -> Column:
        role = F.substring_index(F.substr(piece, F.lit(len(START) + 1)), "\n", 1)
        return F.struct(role.alias("role"), F.substr(piece, F.length(role) + len(START) + 2).alias("text"))

    return F.transform(turns, turn)


def turns_text(turns: Column) -> Column:
    """Role, line feed, text, line feed of each parsed turn, unescaped."""
    return F.array_join(F.transform(turns, lambda t: F.concat(unescape_role(t["role"]), F.lit("\n"), unescape(t["text"]), F.lit("\n"))), "")


def loss_text(formatted: Column, loss: Column) -> Column:
    """What the loss spans cover in the formatted text, unescaped and in order."""
    def covered(span: Column) -> Column:
        return unescape(F.substr(formatted, (span["start"] + 1).cast("int"), (span["end"] - span["start"]).cast("int")))

    return F.array_join(F.transform(F.filter(loss, lambda s: s["end"] > s["start"]), covered), "")


def reply_chain(turns: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Linear conversations as reply trees: each row answers the one before it in ``order``."""
    place = F.row_number().over(Window.partitionBy(key).orderBy(*order)).cast("long")
    clash = {"tree", "node", "parent", "score"} - {key}
    own = [c for c in turns.columns if c not in clash]  # such columns are replaced
    numbered = turns.withColumn("_place", place).select(*own, "_place").withColumnRenamed(key, "tree").withColumnRenamed("_place", "node")
    return numbered.withColumn("parent", F.when(F.col("node") > 1, F.col("node") - 1)).withColumn("score", F.lit(1.0))
