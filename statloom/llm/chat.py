"""Chat formatting of reply trees: enumerate root-to-leaf paths, rank branches, write conversations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from statloom.session import materialise

START, END, BREAK = "<|im_start|>", "<|im_end|>", "<|nl|>"
LEARNT = "assistant"


def escape(text: Column) -> Column:
    """No `<|` is left: each run `<\\...|` gets one backslash more."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", "<$1|")


def head(role: Column) -> Column:
    return F.concat(F.lit(START), F.replace(escape(role), F.lit("\n"), F.lit(BREAK)), F.lit("\n"))


def key(column: str) -> Column:
    return F.concat(F.lit("i"), F.col(column).cast("string"))


def tree_nodes(nodes: DataFrame, tree: str, node: str, parent: str, role: str, text: str, score: str | None) -> DataFrame:
    """One row per tree and node, with keys that are never null and links to parents that exist."""
    rows = nodes.select(
        F.coalesce(key(tree), F.lit("n")).alias("t"),
        F.coalesce(key(node), F.lit("n")).alias("v"),
        F.col(tree).alias("tree_id"),
        F.col(node).alias("node_id"),
        F.struct(
            key(parent).alias("parent"),
            F.coalesce(F.col(role), F.lit("")).alias("role"),
            F.coalesce(F.col(text), F.lit("")).alias("text"),
            (F.coalesce(F.col(score).cast("double"), F.lit(0.0)) if score else F.lit(0.0)).alias("score"),
        ).alias("body"),
    )
    single = rows.groupBy("t", "v").agg(F.first("tree_id").alias("tree_id"), F.first("node_id").alias("node_id"), F.min("body").alias("body"))
    single = materialise(single.select("t", "v", "tree_id", "node_id", "body.*"), "chat-nodes")
    known = single.select(F.col("t").alias("kt"), F.col("v").alias("kv"))
    linked = single.select("t", "v", "tree_id", "node_id", "parent", "score").join(known, (F.col("t") == F.col("kt")) & (F.col("parent") == F.col("kv")), "left")
    return single, linked.withColumn("anc", F.col("kv")).drop("parent", "kt", "kv")


def climb(linked: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """Depth and score sum of each node by pointer doubling, and the jump tables of 1, 2, 4, ...

    Each round is a self-join that doubles the length of the paths. Nodes on or behind a cycle have
    no root; the number of rounds is bounded by the largest tree, and they are left out then.
    """
    state = linked.select("t", "v", "tree_id", "node_id", F.when(F.col("anc").isNotNull(), 1).otherwise(0).cast("long").alias("depth"), F.col("score").alias("total"), "anc")
    largest = linked.groupBy("t").count().agg(F.max("count")).first()[0] or 0
    jumps = []
    for _ in range(largest.bit_length() + 1):
        state = materialise(state, "chat-climb")
        active = state.where(F.col("anc").isNotNull())
        if active.isEmpty():
            break
        jumps.append(active.select("t", "v", "anc"))
        # `total` leaves out the node jumped to until the jump to it is joined, so nothing counts twice.
        upper = state.select(F.col("t").alias("ut"), F.col("v").alias("uv"), F.col("anc").alias("uanc"), F.col("depth").alias("udepth"), F.col("total").alias("utotal"))
        joined = active.join(upper, (F.col("t") == F.col("ut")) & (F.col("anc") == F.col("uv")))
        grown = joined.select("t", "v", "tree_id", "node_id", (F.col("depth") + F.col("udepth")).alias("depth"), (F.col("total") + F.col("utotal")).alias("total"), F.col("uanc").alias("anc"))
        state = state.where(F.col("anc").isNull()).unionByName(grown)
    return state.where(F.col("anc").isNull()), jumps


def chosen_branches(rooted: DataFrame, linked: DataFrame, top: int) -> DataFrame:
    """The `top` leaves of each tree by score, then length, then smaller id."""
    parents = linked.where(F.col("anc").isNotNull()).select("t", F.col("anc").alias("v")).distinct()
    leaves = rooted.join(parents, ["t", "v"], "left_anti")
    order = W.partitionBy("t").orderBy(F.desc("total"), F.desc("depth"), F.asc_nulls_last("node_id"), "v")
    return leaves.withColumn("branch", F.row_number().over(order)).where(F.col("branch") <= top)


def branch_paths(branches: DataFrame, jumps: list[DataFrame]) -> DataFrame:
    """One row per node of each chosen path; each self-join doubles the stretch above the leaf."""
    path = branches.select("t", F.col("v").alias("leaf"), "v", F.col("depth").alias("place"))
    for k, jump in enumerate(jumps):
        path = materialise(path, "chat-paths")
        above = path.join(jump, ["t", "v"]).select("t", "leaf", F.col("anc").alias("v"), (F.col("place") - (1 << k)).alias("place"))
        path = path.unionByName(above)
    return path


def conversation(turns: Column) -> Column:
    """Formatted text of an array of (role, text)."""
    return F.array_join(F.transform(turns, lambda t: F.concat(head(t["role"]), escape(t["text"]), F.lit(f"{END}\n"))), "")


def loss_spans(turns: Column) -> Column:
    """Code-point spans of the texts of assistant turns within the formatted text."""
    nothing = F.struct(F.lit(0).cast("long").alias("at"), F.expr("cast(array() as array<struct<start:bigint,end:bigint>>)").alias("spans"))

    def step(state: Column, turn: Column) -> Column:
        start = state["at"] + F.char_length(head(turn["role"]))
        end = start + F.char_length(escape(turn["text"]))
        added = F.array_append(state["spans"], F.struct(start.alias("start"), end.alias("end")))
        return F.struct((end + len(END) + 1).alias("at"), F.when(turn["role"] == LEARNT, added).otherwise(state["spans"]).alias("spans"))

    return F.aggregate(turns, nothing, step, lambda state: state["spans"])


def format_trees(
    nodes: DataFrame,
    tree: str = "tree_id",
    node: str = "node_id",
    parent: str = "parent_id",
    role: str = "role",
    text: str = "text",
    score: str | None = None,
    top: int = 1,
) -> DataFrame:
    """One row per chosen branch: `tree_id`, `branch`, `leaf_id`, `score`, `formatted`, `loss_spans`.

    Texts keep no control string: `escape` is reversed by `unescape`. Null texts and roles are empty;
    a node whose parent is null or missing is a root; null tree or node ids are ids of their own;
    of repeated node ids the row with the smallest (parent, role, text, score) stays. Nodes on or
    behind a cycle have no root and form no path. An empty table gives no rows. Other columns are
    ignored. Joins move keys, not texts, and take as many rounds as the deepest path has binary
    digits. A conversation is one output row, so it has to fit into one.
    """
    single, linked = tree_nodes(nodes, tree, node, parent, role, text, score)
    linked = materialise(linked, "chat-links")
    rooted, jumps = climb(linked)
    branches = materialise(chosen_branches(rooted, linked, top), "chat-branches")
    paths = branch_paths(branches, jumps).join(single.select("t", "v", "role", "text"), ["t", "v"])
    turns = paths.groupBy("t", "leaf").agg(F.array_sort(F.collect_list(F.struct("place", "role", "text"))).alias("turns"))
    named = turns.join(branches.withColumnRenamed("v", "leaf"), ["t", "leaf"])
    return named.select(
        "tree_id",
        "branch",
        F.col("node_id").alias("leaf_id"),
        F.col("total").alias("score"),
        conversation(F.col("turns")).alias("formatted"),
        loss_spans(F.col("turns")).alias("loss_spans"),
    )


def read_turns(formatted: Column) -> Column:
    """The array of (role, text) of a formatted conversation."""
    blocks = F.split(formatted, r"<\|im_start\|>", -1)

    def one(block: Column) -> Column:
        role = F.substring_index(block, "\n", 1)
        length = F.char_length(block) - F.char_length(role) - 1 - (len(END) + 1)
        body = F.substring(block, F.char_length(role) + 2, length)
        return F.struct(unescape(F.replace(role, F.lit(BREAK), F.lit("\n"))).alias("role"), unescape(body).alias("text"))

    return F.transform(F.slice(blocks, F.lit(2), F.size(blocks)), one)


def read_loss(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(spans, lambda s: unescape(F.substring(formatted, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))), "")


def chain_nodes(conversations: DataFrame) -> DataFrame:
    """Turns as reply chains: each row answers the one before it by turn, role and text."""
    order = W.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), F.asc_nulls_first("role"), F.asc_nulls_first("text"))
    ranked = conversations.select("conv_id", "role", "text", F.row_number().over(order).alias("node_id"))
    return ranked.withColumn("parent_id", F.expr("nullif(node_id - 1, 0)"))
