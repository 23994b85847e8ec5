"""Chat formatting of reply trees: root-to-leaf paths by self-joins, branches ranked by score, chosen paths formatted.

A message names its parent. Iterative self-joins let each message jump twice as far up as the last, adding up the scores on
the way, until all have met their root: a tree of depth d takes log2(d) joins. Leaves are ranked under their root by the mean score of
their branch, then by leaf; only the chosen ones gather their ancestors, by the binary digits of their distance, so
the rows made are those of the paths that are formatted.

The template is ``<|im_start|>ROLE\\nTEXT<|im_end|>\\n`` for each turn. Control strings inside roles and texts (the template's
own and those of other common templates) get a backslash after their first character, one more where backslashes already
stand there, so every text can be read back; the loss mask covers each assistant's text.

Defined results: null texts and roles count as empty; a null message is left out; rows that repeat a message are one, with
the least parent and the greatest score among them; a null score is 0; a parent that does not exist makes its child a root; messages
of a cycle, and those below one, have no root and are left out of paths; an empty table gives no paths; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from placeloom.plans.scratch import Scratch

START, STOP = "<|im_start|>", "<|im_end|>"
#: First character, backslashes, rest of a control string.
_CONTROL = r"([<\[])(\\*)(\||/?s>|/?INST\]|</?SYS>>)"
_ESCAPED = r"([<\[])\\(\\*)(\||/?s>|/?INST\]|</?SYS>>)"


def escape(c: Column) -> Column:
    return F.regexp_replace(c, _CONTROL, r"$1\\$2$3")


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, _ESCAPED, "$1$2$3")


def _role(c: Column) -> Column:
    """A role stands on one line."""
    return escape(F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def _role_back(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(unescape(c), r"(?<!\\)((?:\\\\)*)\\n", "$1\n"), r"\\\\", r"\\")


def paths(nodes: DataFrame, node: str = "node", parent: str = "parent", score: str = "score", top: int = 1) -> DataFrame:
    """(path, rank, depth, node): the messages of the ``top`` best root-to-leaf paths of every root; ``path`` is the leaf.

    Rank 1 is the branch of highest mean score; depth counts from 0 at the root.
    """
    scratch = Scratch(nodes.sparkSession, "paths")
    own = nodes.select(F.col(node).alias("n"), F.col(parent).alias("p"), F.coalesce(F.col(score).cast("double"), F.lit(0.0)).alias("s"))
    one = own.where("n is not null").groupBy("n").agg(F.min("p").alias("p"), F.max("s").alias("s"))
    one = scratch.put(one)
    rows = one.count()
    known = one.select(F.col("n").alias("p"), F.lit(True).alias("has"))
    answers = one.where("p is not null").join(known, "p", "left")  # messages without a parent would all meet in one task
    tree = scratch.put(answers.select("n", F.when(F.col("has"), F.col("p")).alias("p"), "s").unionAll(one.where("p is null").select("n", "p", "s")), rows)
    roots = tree.where("p is null").select(F.col("n").alias("a"), F.lit(True).alias("done"))

    # (n, a, s, d, done): a is d messages above n, s the scores from n up to before a; done once a is a root
    jumps = [scratch.put(tree.where("p is not null").select("n", F.col("p").alias("a"), "s", F.lit(1).alias("d")).join(roots, "a", "left").select("n", "a", "s", "d", F.coalesce("done", F.lit(False)).alias("done")), rows)]
    while 1 << (len(jumps) - 1) <= rows and jumps[-1].where("not done").limit(1).count():
        last = jumps[-1]
        above = last.select(F.col("n").alias("a"), F.col("a").alias("b"), F.col("s").alias("t"), F.col("d").alias("e"), F.col("done").alias("ends"))
        far = last.where("not done").join(above, "a").select("n", F.col("b").alias("a"), (F.col("s") + F.col("t")).alias("s"), (F.col("d") + F.col("e")).alias("d"), F.col("ends").alias("done"))
        jumps.append(scratch.put(last.where("done").unionAll(far), rows))

    leaves = tree.join(tree.where("p is not null").select(F.col("p").alias("n")).distinct(), "n", "left_anti")
    below = leaves.where("p is not null").select("n").join(jumps[-1].where("done"), "n").select(F.col("n").alias("path"), F.col("a").alias("root"), F.col("s").alias("sum"), "d")
    top_score = tree.where("p is null").select(F.col("n").alias("root"), F.col("s").alias("r"))
    branch = below.join(top_score, "root").select("path", "root", ((F.col("sum") + F.col("r")) / (F.col("d") + 1)).alias("mean"), "d")
    branch = branch.unionAll(leaves.where("p is null").select(F.col("n").alias("path"), F.col("n").alias("root"), F.col("s").alias("mean"), F.lit(0).alias("d")))
    best = Window.partitionBy("root").orderBy(F.desc("mean"), "path")
    found = scratch.put(branch.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top).select("path", "rank", F.col("d").alias("last"), F.col("path").alias("n"), F.lit(0).alias("up")), rows)
    for k in range(len(jumps) - 1, -1, -1):
        hop = jumps[k].where(F.col("d") == 1 << k).select("n", "a")
        both = F.array(F.struct("n", "up"), F.when(F.col("a").isNotNull(), F.struct(F.col("a").alias("n"), (F.col("up") + F.lit(1 << k)).alias("up"))))
        found = found.join(hop, "n", "left").select("path", "rank", "last", F.explode(F.array_compact(both)).alias("x")).select("path", "rank", "last", "x.n", "x.up")
    return found.select("path", "rank", (F.col("last") - F.col("up")).alias("depth"), F.col("n").alias(node))


def format_paths(turns: DataFrame, by: str, order: str, role: str = "role", text: str = "text") -> DataFrame:
    """(``by``, formatted): turns joined by the template in ``order``; a conversation is one output row."""
    turn = F.struct(F.col(order).alias("o"), _role(F.coalesce(F.col(role), F.lit(""))).alias("r"), escape(F.coalesce(F.col(text), F.lit(""))).alias("t"))
    one = F.array_join(F.transform(F.array_sort(F.collect_list(turn)), lambda x: F.concat(F.lit(START), x["r"], F.lit("\n"), x["t"], F.lit(STOP + "\n"))), "")
    return turns.groupBy(by).agg(one.alias("formatted"))


def read_back(formatted: Column) -> Column:
    """The turns of a formatted conversation: an array of (role, text), unescaped."""
    part = r"(?s)<\|im_start\|>([^\n]*)\n(.*?)<\|im_end\|>\n"
    return F.zip_with(
        F.regexp_extract_all(formatted, F.lit(part), F.lit(1)),
        F.regexp_extract_all(formatted, F.lit(part), F.lit(2)),
        lambda r, t: F.struct(_role_back(r).alias("role"), unescape(t).alias("text")),
    )


def loss_text(turns: Column) -> Column:
    """All text under the loss mask: each assistant text once, in order, nothing between."""
    return F.array_join(F.transform(F.filter(turns, lambda x: x["role"] == "assistant"), lambda x: x["text"]), "")
