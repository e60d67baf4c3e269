"""Connected components of a graph given as a frame of edges, by contracting it.

Each task first joins what its own edges connect, so a node goes on at most once from each task, with the smallest node
it knows. Grouping by node then gives every node one smaller node and leaves links between those; these and what the nodes
in them point at are a smaller graph, contracted in turn. The last step points every node
at its root's root. Nothing is keyed by a hub but that join, whose sides Spark may split or broadcast by itself.

The edges never reach the driver, which learns only whether links are left.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickbars.llm.shared import written

BATCH = 1 << 20


def contracted(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All nodes but the roots, each with the smallest node of its component among these edges."""
    names, ends = np.unique(np.concatenate((u, v)), return_inverse=True)
    a, b = ends[: len(u)], ends[len(u) :]
    root = np.arange(len(names))
    while True:
        # Hook the larger root of every edge under the smaller, then shorten all paths.
        x, y = root[a], root[b]
        low, high = np.minimum(x, y), np.maximum(x, y)
        if (low == high).all():
            break
        np.minimum.at(root, high, low)
        while True:
            up = root[root]
            if (up == root).all():
                break
            root = up
    child = np.flatnonzero(root != np.arange(len(names)))
    return names[child], names[root[child]]


def _contracted(batches):
    held, n = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append((batch.column(0).to_numpy(), batch.column(1).to_numpy()))
            n += batch.num_rows
        if n >= BATCH:
            yield from _flushed(held)
            held, n = [], 0
    if held:
        yield from _flushed(held)


def _flushed(held):
    u, v = contracted(*(np.concatenate(x) for x in zip(*held, strict=True)))
    for low in range(0, len(u), 1 << 16):
        part = slice(low, low + (1 << 16))
        yield pa.RecordBatch.from_arrays([pa.array(u[part]), pa.array(v[part])], ["u", "v"])


def components(edges: DataFrame) -> DataFrame:
    """Rows (node, root) for all nodes of the edges (u, v) but the roots; the root is its component's smallest node."""
    own = edges.where("u <> v").select(F.col("u").cast("long"), F.col("v").cast("long"))
    tied = own.mapInArrow(_contracted, "u long, v long").groupBy("u")
    tied = written(tied.agg(F.min("v").alias("m"), F.collect_set("v").alias("vs")), "tied")
    links = tied.where(F.size("vs") > 1).select(F.explode("vs").alias("u"), F.col("m").alias("v")).where("u <> v")
    roots = tied.select(F.explode("vs").alias("u")).distinct()
    chained = tied.select("u", F.col("m").alias("v")).join(roots, "u", "left_semi")
    left = written(links.unionByName(chained), "left")
    found = tied.select(F.col("u").alias("node"), F.col("m").alias("root"))
    if left.isEmpty():
        return found
    above = components(left).toDF("below", "top")
    mapped = found.join(above, F.col("root") == F.col("below"), "left").select("node", F.coalesce("top", "root").alias("root"))
    # Nodes that no task had as a child are in ``above`` alone; for those in both, both ways lead to the same root.
    return written(mapped.unionByName(above.toDF("node", "root")).distinct(), "roots")
