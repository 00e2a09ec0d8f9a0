"""Connected components of an edge table: union-find within each task, then smallest labels with pointer jumping between them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallgrass.llm.common import written


def _forests(batches):
    """Of the edges (a, b) of one task, a spanning forest as (node, root); memory is bounded by the task's own nodes."""
    import pyarrow as pa

    up: dict[int, int] = {}

    def root(x: int) -> int:
        while (y := up.setdefault(x, x)) != x:
            up[x] = up[y]
            x = up[x]
        return x

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            a, b = root(a), root(b)
            if a != b:
                up[max(a, b)] = min(a, b)
    nodes = list(up)
    for i in range(0, len(nodes), 50_000):
        part = nodes[i : i + 50_000]
        pairs = [(x, root(x)) for x in part]
        pairs = [x for x in pairs if x[0] != x[1]]
        yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in pairs], pa.int64()), pa.array([x[1] for x in pairs], pa.int64())], ["a", "b"])


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for each node of edges (a, b), label being the smallest node that it is connected with.

    Rounds are logarithmic in the longest path. Each is written to the shared folder, and only a count comes to the driver.
    """
    edges = written(edges.select("a", "b").mapInArrow(_forests, "a long, b long"), "forest")
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    labels = written(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least")).select("node", F.least("node", "least").alias("label")), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        next_ = labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        hop = labels.select(F.col("node").alias("label"), F.col("label").alias("hop"))
        next_ = written(next_.join(hop, "label", "left").select("node", "old", F.least("label", "hop").alias("label")), "labels")
        if next_.filter("old <> label").isEmpty():
            return next_.select("node", "label")
        labels = next_.select("node", "label")
