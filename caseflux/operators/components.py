"""Connected components of name and merge graphs, by minimum labels."""

from __future__ import annotations

from itertools import count

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseflux.session import Workspace


def connected_components(edges: DataFrame, work: Workspace, left: str, right: str) -> DataFrame:
    """(node, label): each node of an edge with the least node it hangs together with.

    Each round a whole tree (all nodes of one label) moves to the least label
    beside any of its nodes, and labels follow each other twice; it is written
    to the shared folder.  Labels only fall, so the rounds end however long
    a chain is, and a chain of any order of ids takes few.
    Edges with a null end are left out; no edge gives no row.
    """
    pairs = edges.select(F.col(left).alias("node"), F.col(right).alias("other")).where("node is not null and other is not null")
    graph = work.save(pairs.union(pairs.select("other", "node")).distinct(), "component_edges")
    labels = work.save(graph.groupBy("node").agg(F.least(F.min("node"), F.min("other")).alias("label")), "component_labels0")
    for k in count(1):
        beside = graph.join(labels.withColumnRenamed("node", "other"), "other").groupBy("node").agg(F.min("label").alias("near"))
        moves = labels.join(beside, "node").groupBy("label").agg(F.min("near").alias("to")).where("to < label")
        moves = work.save(moves, f"component_moves{k}")
        if moves.isEmpty():
            return labels
        for _ in range(2):
            hop = moves.select(F.col("label").alias("to"), F.col("to").alias("further"))
            moves = moves.join(hop, "to", "left").select("label", F.coalesce("further", "to").alias("to"))
        labels = work.save(labels.join(moves, "label", "left").select("node", F.coalesce("to", "label").alias("label")), f"component_labels{k}")
        work.drop(f"component_labels{k - 1}")
        work.drop(f"component_moves{k}")
