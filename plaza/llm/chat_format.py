"""Chat formatting of reply trees, in DataFrame operations only.

Messages form trees through their parent. Root-to-leaf paths are enumerated by self-joins:
each round joins every node's pointer up with the pointer of the node where it ends, so that
pointers double in length and carry along the score of what they pass. A path is ranked by
the mean score of its messages; from the best leaves of each tree the pointers are followed
back, longest first, to the messages of their paths, which become one formatted conversation
each. Rounds are logarithmic in the longest thread, each a table of rows of fixed width.

Template: ``<turn ROLE>TEXT</turn>`` and a line feed for each message, where in role and text
a backslash is written ``\\b``, ``<`` is written ``\\l`` and ``>`` is written ``\\g``. So no
text can hold a control string, and the text can be read back exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

# The control strings of the template, and how characters are written in texts.
OPEN, CLOSE = "<turn ", "</turn>\n"
ESCAPES = (("\\", "\\b"), ("<", "\\l"), (">", "\\g"))


def escaped(text: Column) -> Column:
    for char, written in ESCAPES:
        text = F.replace(text, F.lit(char), F.lit(written))
    return text


def unescaped(text: Column) -> Column:
    for char, written in reversed(ESCAPES):
        text = F.replace(text, F.lit(written), F.lit(char))
    return text


def threads(messages: DataFrame, tree: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(tree, node, parent, role, text, score) of linear threads: each message replies to the one before it.

    Messages are in order of turn (null first), then role and text; ones that repeat stay, one
    after another. score is 0.
    """
    at = F.row_number().over(Window.partitionBy(tree).orderBy(F.col(turn).asc_nulls_first(), F.col(role), F.col(text))).cast("long")
    return messages.select(F.col(tree).alias("tree"), at.alias("node"), F.col(role).alias("role"), F.col(text).alias("text")).select(
        "tree", "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"), "role", "text", F.lit(0.0).alias("score")
    )


def _at(a: DataFrame, b: DataFrame, key: str) -> Column:
    """Join condition: a's ``key`` is the node n of b's tree t."""
    return a["tree"].eqNullSafe(b["t"]) & (a[key] == b["n"])


def ascents(nodes: DataFrame) -> list[DataFrame]:
    """Tables (tree, node, up, total, steps, size), each stored, by pointer doubling: in the k-th, up is the ancestor 2 ** k above, null where there is none, and total and steps are the scores and messages from the node up to it, without it.

    The k-th has the trees of size over 2 ** (k - 1), the first all; so a tree takes part in as
    many rounds as its size asks for, and a row stays as wide however long the thread. In the
    last table that has a tree, steps is the depth and total the score of the way from the
    root. A parent that is null or missing makes a root; nodes on a cycle, or below one, keep
    an up.
    """
    own = nodes.select("tree", "node", "parent", F.coalesce("score", F.lit(0.0)).alias("total"))
    known = own.select(F.col("tree").alias("t"), F.col("node").alias("n"))
    sizes = own.groupBy(F.col("tree").alias("of")).agg(F.count("*").alias("size"))
    first = own.join(known, _at(own, known, "parent"), "left").select("tree", "node", F.col("n").alias("up"), "total", F.lit(1).cast("long").alias("steps"))
    tables = [stored(first.join(sizes, first["tree"].eqNullSafe(sizes["of"])).drop("of"), "ascent")]
    while (now := tables[-1].where(F.col("size") > 1 << (len(tables) - 1))).limit(1).count():
        above = now.select(F.col("tree").alias("t"), F.col("node").alias("n"), F.col("up").alias("up2"), F.col("total").alias("total2"), F.col("steps").alias("steps2"))
        joined = now.join(above, _at(now, above, "up"), "left")
        tables.append(stored(joined.select("tree", "node", F.col("up2").alias("up"), (F.col("total") + F.coalesce("total2", F.lit(0.0))).alias("total"), (F.col("steps") + F.coalesce("steps2", F.lit(0))).alias("steps"), "size"), "ascent"))
    return tables


def branches(nodes: DataFrame, best: int | None = None) -> DataFrame:
    """(tree, leaf, rank, score, node, at): the messages of each tree's ``best`` root-to-leaf paths (all if null), at their places from 1 on.

    nodes(tree, node, parent, score); tree may be null, node may not repeat within a tree. score
    is the mean over the path, null counts as 0; paths rank by score, then leaf. Nodes on a cycle
    have no root and no path. Paths are walked from the chosen leaves only: each round joins
    what is reached with the ancestors half as far above as the round before.
    """
    tables = ascents(nodes)
    last = [t.where(F.col("size") <= 1 << k) for k, t in enumerate(tables)]
    rooted = last[0]
    for t in last[1:]:
        rooted = rooted.unionByName(t)
    rooted = rooted.where("up is null")
    inner = nodes.where("parent is not null").select(F.col("tree").alias("t"), F.col("parent").alias("n")).distinct()
    leaves = rooted.join(inner, _at(rooted, inner, "node"), "left_anti").select("tree", F.col("node").alias("leaf"), (F.col("total") / F.col("steps")).alias("score"), "size")
    leaves = leaves.withColumn("rank", F.row_number().over(Window.partitionBy("tree").orderBy(F.desc("score"), "leaf")))
    names = ("tree", "leaf", "rank", "score", "size")
    reached = stored((leaves if best is None else leaves.where(F.col("rank") <= best)).select(*names, F.col("leaf").alias("node")), "reached")
    for k in reversed(range(len(tables) - 1)):
        above = tables[k].where("up is not null").select(F.col("tree").alias("t"), F.col("node").alias("n"), "up")
        large = reached.where(F.col("size") > 1 << k)
        reached = reached.unionByName(stored(large.join(above, _at(large, above, "node")).select(*names, F.col("up").alias("node")), "reached"))
    depth = rooted.select(F.col("tree").alias("t"), F.col("node").alias("n"), F.col("steps").alias("at"))
    return reached.join(depth, _at(reached, depth, "node")).select("tree", "leaf", "rank", "score", "node", "at")


def paths(nodes: DataFrame) -> DataFrame:
    """(tree, leaf, path array of nodes from the root down, score): all root-to-leaf paths, as ``branches`` has them."""
    by = branches(nodes).groupBy("tree", "leaf", "score").agg(F.array_sort(F.collect_list(F.struct("at", "node"))).alias("steps"))
    return by.select("tree", "leaf", F.col("steps.node").alias("path"), "score")


def format_trees(nodes: DataFrame, best: int = 1, speaker: str = "assistant") -> DataFrame:
    """(tree, leaf, rank, score, n_turns, formatted, loss): the ``best`` paths of each tree, formatted.

    nodes(tree, node, parent, role, text, score). Paths rank by score, then leaf. loss is an
    array of (start, end), in code points of formatted: the texts of the speaker's messages,
    as written, without their control strings. A null text or role is written as an empty one.
    An empty table gives no rows; other columns aren't read.
    """
    nodes = stored(nodes.select("tree", "node", "parent", "role", "text", "score"), "nodes")
    steps = branches(nodes, best)
    words = nodes.select(F.col("tree").alias("t"), F.col("node").alias("n"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    written = steps.join(words, _at(steps, words, "node"))
    written = written.withColumn("head", F.concat(F.lit(OPEN), escaped(F.col("role")), F.lit(">"))).withColumn("body", escaped(F.col("text")))
    size = F.length("head") + F.length("body") + len(CLOSE)
    written = written.withColumn("end", F.sum(size).over(Window.partitionBy("tree", "leaf").orderBy("at")) - len(CLOSE))
    own = F.when(F.col("role") == speaker, F.struct(F.col("at"), (F.col("end") - F.length("body")).alias("start"), "end"))
    turns = written.groupBy("tree", "leaf", "rank", "score").agg(F.array_sort(F.collect_list(F.struct("at", F.concat("head", "body", F.lit(CLOSE)).alias("turn")))).alias("turns"), F.array_sort(F.collect_list(own)).alias("own"))
    return turns.select(
        "tree", "leaf", "rank", "score", F.size("turns").cast("long").alias("n_turns"), F.array_join("turns.turn", "").alias("formatted"),
        F.transform("own", lambda s: F.struct(s["start"].cast("int").alias("start"), s["end"].cast("int").alias("end"))).alias("loss"),
    )


def read_back(formatted: Column) -> Column:
    """array<struct<role, text>> of the turns of a formatted conversation."""
    parts = F.split(formatted, CLOSE, -1)
    turns = F.slice(parts, 1, F.size(parts) - 1)
    return F.transform(
        turns,
        lambda t: F.struct(
            unescaped(F.substring_index(F.substring(t, len(OPEN) + 1, 2**31 - 1), ">", 1)).alias("role"),
            unescaped(F.substring(t, F.position(F.lit(">"), t) + F.lit(1), F.lit(2**31 - 1))).alias("text"),
        ),
    )


def read_loss(formatted: Column, loss: Column) -> Column:
    """The unescaped text under the loss spans, nothing between them."""
    return unescaped(F.array_join(F.transform(loss, lambda s: F.substring(formatted, s["start"] + F.lit(1), s["end"] - s["start"])), ""))
