"""Connected components of a large undirected graph, by the smallest node."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.workspace import stage


def spanning(links: DataFrame) -> DataFrame:
    """Links that join the same nodes: of those that a task reads, no more than it has nodes."""

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        above: dict[int, int] = {}

        def top(node: int) -> int:
            while (over := above.setdefault(node, node)) != node:
                above[node] = node = above[over]
            return node

        for batch in batches:
            for a, b in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                first, second = top(a), top(b)
                above[max(first, second)] = min(first, second)
        pairs = [(node, top(node)) for node in above]
        yield pa.RecordBatch.from_arrays(
            [pa.array([pair[i] for pair in pairs if pair[0] != pair[1]], pa.int64()) for i in range(2)], ["a", "b"]
        )

    return links.select("a", "b").mapInArrow(joined, "a bigint, b bigint")


def smallest_reachable(links: DataFrame) -> DataFrame:
    """``node`` and ``label``, the smallest node it reaches, for every node of a link.

    ``links`` has the columns a and b (not NULL; order, repeats and loops do
    not matter). No links give an empty result. In each round a node takes the
    smallest label next to it, and then the label of its label, so distances
    halve and a path of n nodes takes about log n rounds. Labels are written
    to the shared folder after each round, which cuts the lineage; only the
    number of changed labels comes to the driver. Neighbours' labels are
    combined in each task before they meet, so a node with very many links
    does not gather them all in one.
    """
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    ends = stage(both.where("a <> b").distinct(), "links").df
    labels = stage(
        ends.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("label")),
        "labels",
    ).df
    while True:
        near = (
            ends.join(labels, ends["b"] == labels["node"])
            .groupBy("a")
            .agg(F.min("label").alias("near"))
        )
        lowered = labels.join(near, F.col("node") == F.col("a")).select(
            "node", F.least("label", "near").alias("lowered"), F.col("label").alias("former")
        )
        jumps = labels.select(F.col("node").alias("over"), F.col("label").alias("jump"))
        step = stage(
            lowered.join(jumps, F.col("lowered") == F.col("over")).select(
                "node", F.least("lowered", "jump").alias("label"), "former"
            ),
            "labels",
        ).df
        labels = step.select("node", "label")
        if step.where("label <> former").isEmpty():
            return labels
