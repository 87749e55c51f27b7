"""Connected components of an edge table."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.shared import saved


def _forest(batches):
    """Edges of a partition, reduced to (member, smallest member of its tree so far)."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        top = x
        while (up := parent.get(top, top)) != top:
            top = up
        while parent.get(x, x) != top:
            parent[x], x = top, parent.get(x, x)
        return top

    for b in batches:
        pairs = np.unique(np.stack([b.column(0).to_numpy(), b.column(1).to_numpy()], axis=1), axis=0) if b.num_rows else []
        for x, y in (pairs.tolist() if len(pairs) else []):
            x, y = root(x), root(y)
            parent[max(x, y)] = parent[min(x, y)] = min(x, y)
    for x in list(parent):
        root(x)
    rows = [(x, root(x)) for x in parent if root(x) != x]
    for i in range(0, len(rows), 100_000):
        a = np.array(rows[i:i + 100_000], np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(a[:, 0]), pa.array(a[:, 1])], names=["a", "b"])


def connected(edges: DataFrame) -> DataFrame:
    """``id`` (every vertex of an edge) and ``component`` (smallest vertex reachable) of bigint edges (a, b).

    Each partition first shrinks its edges to a forest; then every vertex moves to the smallest label next to it and
    on to that label's own label, until nothing changes. All tables lie in the shared folder. Vertices must not be null;
    repeated edges and loops do no harm, a vertex that has only a loop is not listed, no edges give no rows.
    """
    forest = saved(edges.select("a", "b").mapInArrow(_forest, "a bigint, b bigint").distinct(), "forest")
    both = saved(forest.union(forest.select("b", "a")).toDF("id", "other"), "edges")
    label = saved(both.groupBy("id").agg(F.least(F.min("other"), F.col("id")).alias("component")), "labels")
    while True:
        near = both.join(label.withColumnRenamed("id", "other"), "other").groupBy("id").agg(F.min("component").alias("m"))
        step = label.join(near, "id").select("id", F.least("component", "m").alias("c"), F.col("component").alias("was"))
        # pointer jump: a label is itself a vertex
        jump = label.select(F.col("id").alias("c"), F.col("component").alias("up"))
        step = saved(step.join(jump, "c", "left").select(
            "id", F.least("c", F.coalesce("up", "c")).alias("component"), "was"), "labels")
        changed = step.where(F.col("component") != F.col("was")).limit(1).count()
        label = step.select("id", "component")
        if not changed:
            return label
