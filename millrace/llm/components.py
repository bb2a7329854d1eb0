"""Connected components of a link table, by contraction: every vertex goes to the neighbour that comes first in an order
of hashes, drawn anew each round, links are rewritten between what is left and shrink from round to round. The order is a
random one, so chains of ascending ids take no more rounds than others. Every round is written to the shared folder; the
last links, a bounded number, are settled by one task; nothing but counts reaches the driver.

Defined cases: links with a null end and links of a node with itself say nothing and give no rows; repeated links count
once; no links, no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

#: So many links are settled in one task.
FEW = 10_000


def settled(edges: DataFrame) -> DataFrame:
    """(v, p): a representative p for every node v of at most ``FEW`` links, by union-find in one task."""

    def work(batches):
        up: dict[int, int] = {}

        def find(x: int) -> int:
            root = x
            while up.setdefault(root, root) != root:
                root = up[root]
            while up[x] != root:
                up[x], x = root, up[x]
            return root

        for batch in batches:
            for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True):
                up[find(a)] = find(b)
        nodes = list(up)
        yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(np.array([find(x) for x in nodes], np.int64))], names=["v", "p"])

    return edges.coalesce(1).mapInArrow(work, "v long, p long")


def components(links: DataFrame, *, least: bool = True) -> DataFrame:
    """(node, label) for every node of ``links`` (a, b): the least node that it reaches; any one, the same for all, if not ``least``."""
    ordered = lambda a, b: [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]
    edges = written(links.select(*ordered("a", "b")).where("a <> b").distinct(), "links")
    labels, n, turn = None, edges.count(), 0
    while n:
        if n <= FEW:
            up = written(settled(edges), "parents")
        else:
            place = lambda c: F.struct(F.xxhash64(F.lit(turn), c).alias("h"), F.col(c).alias("p"))  # noqa: B023, E731
            ends = edges.select(F.col("a").alias("v"), F.col("b").alias("w")).union(edges.select(F.col("b").alias("v"), F.col("a").alias("w")))
            up = written(ends.groupBy("v").agg(F.min(place("w")).alias("m")).select("v", F.least("m", place("v"))["p"].alias("p")), "parents")
            over = up.select(F.col("v").alias("pv"), F.col("p").alias("pp"))
            up = written(up.join(over, F.col("p") == F.col("pv")).select("v", F.col("pp").alias("p")), "parents")  # one jump: a parent has a parent
        if labels is None:
            labels = up.select(F.col("v").alias("node"), F.col("p").alias("label"))
        else:
            labels = labels.join(up, F.col("label") == F.col("v"), "left").select("node", F.coalesce("p", "label").alias("label"))
            labels = written(labels, "labels")
        if n <= FEW:
            break
        first = edges.join(up, F.col("a") == F.col("v")).select(F.col("p").alias("a"), "b")
        both = first.join(up, F.col("b") == F.col("v")).select("a", F.col("p").alias("b"))
        edges = written(both.where("a <> b").select(*ordered("a", "b")).distinct(), "links")
        n, turn = edges.count(), turn + 1
    if labels is None:
        return links.sparkSession.createDataFrame([], "node long, label long")
    if not least:
        return labels
    first = labels.groupBy("label").agg(F.min("node").alias("least"))
    return labels.join(first, "label").select("node", F.col("least").alias("label"))
