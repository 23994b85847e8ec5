"""Connected components of a link table by contraction; nothing is gathered on the driver but a row count per round."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placeloom.plans.scratch import Scratch

HELD = 1_000_000  # links that a task holds at once (16 MB)


def least_roots(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes of the links (a, b), ascending, and the least node that each is connected with."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    root = np.arange(len(nodes))
    while len(x):
        low, high = np.minimum(root[x], root[y]), np.maximum(root[x], root[y])
        open_ = low != high
        x, y = x[open_], y[open_]
        np.minimum.at(root, high[open_], low[open_])
        while True:
            up = root[root]
            if np.array_equal(up, root):
                break
            root = up
    return nodes, nodes[root]


def _contract(links: DataFrame, tasks: int, held: int) -> DataFrame:
    """(node, root) for each piece of ``held`` links that a task reads: the components inside the piece."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[np.ndarray] = []

        def close() -> pa.RecordBatch:
            both = np.concatenate(parts, axis=1)
            parts.clear()
            return pa.RecordBatch.from_arrays([pa.array(x) for x in least_roots(both[0], both[1])], ["node", "root"])

        for batch in batches:
            ends = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns])
            for i in range(0, batch.num_rows, held):
                if parts and sum(p.shape[1] for p in parts) + min(held, batch.num_rows - i) > held:
                    yield close()
                parts.append(ends[:, i : i + held])
        if parts:
            yield close()

    return links.select("a", "b").coalesce(tasks).mapInArrow(run, "node long, root long")


def components(links: DataFrame, scratch: Scratch, a: str = "a", b: str = "b", held: int = HELD) -> DataFrame:
    """(node, root): for each node of a link, the smallest node of its component; nodes are longs.

    A round first contracts the pieces of ``held`` links that its tasks read; with one piece that is all. Else each node hooks to
    the least node next to it, hooks are followed by doubling until they end, and the links are renamed by what they end in.
    Every node but local minima moves, so at least half of the nodes go in a round, and doubling takes the logarithm of the
    longest chain of hooks, whatever the order of the nodes. A hub is reduced by partial minima before its rows are shuffled.
    """
    ends = links.select(F.least(a, b).cast("long").alias("a"), F.greatest(a, b).cast("long").alias("b"))
    left, roots = scratch.put(ends.where("a <> b").distinct()), None
    while True:
        n = left.count()
        tasks = max(1, -(-n // held))
        tree = scratch.put(_contract(left, tasks, held))
        scratch.drop(left)
        if tasks == 1:
            return _renamed(roots, tree, scratch)
        tied = tree.where("node <> root")
        both = tied.select("node", "root").unionAll(tied.select(F.col("root").alias("node"), F.col("node").alias("root")))
        hook = scratch.put(both.groupBy("node").agg(F.min("root").alias("up")).select("node", F.least("node", "up").alias("up")), 2 * n)
        while True:
            above = hook.select(F.col("node").alias("up"), F.col("up").alias("next"))
            jump = scratch.put(hook.join(above, "up").select("node", F.col("next").alias("up"), (F.col("next") != F.col("up")).alias("moved")), 2 * n)
            scratch.drop(hook)
            hook = jump
            if not hook.where("moved").limit(1).count():
                break
        step = hook.select("node", F.col("up").alias("root"))
        # most links of a star end in one row here, before the hub's own hook is looked up
        near = tied.join(hook.select("node", "up"), "node").select(F.col("up").alias("a"), "root").distinct()
        far = near.join(hook.select(F.col("node").alias("root"), F.col("up").alias("b")), "root")
        left = scratch.put(far.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), n)
        roots, was = _renamed(roots, scratch.put(step, 2 * n), scratch), roots
        scratch.drop(tree, hook)
        if was is not None:
            scratch.drop(was)


def _renamed(roots: DataFrame | None, step: DataFrame, scratch: Scratch) -> DataFrame:
    """``roots`` with each root replaced by that of ``step`` (node, root)."""
    if roots is None:
        return step
    last = step.select(F.col("node").alias("root"), F.col("root").alias("to"))
    return scratch.put(roots.join(last, "root", "left").select("node", F.coalesce("to", "root").alias("root")))
