"""Problem 5: connected components of pairwise matches.

Minimum labels are propagated along the edges and shortened by pointer jumping;
every round is written to the shared folder, until no label changes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseflux.session import Workspace

MAX_ROUNDS = 200


def min_label_components(edges: DataFrame, work: Workspace, src: str = "src", dst: str = "dst") -> DataFrame:
    """(node, label) for every node of ``edges``; label is the least node id reached.

    Works on any orderable id type.  Null ends are left out, self-loops give a
    node its own label, repeated edges count once, no edge gives no row.

    Each round (1) gives every node the least label among its own and its
    neighbours', (2) gives every *label* the least such offer made to any of
    its nodes (hooking of whole trees), and (3) follows label -> label pointers
    twice.  Rounds are logarithmic in the longest chain.  The neighbour step
    aggregates before it joins, so a hub's labels shrink to one row a node
    before anything is moved; stages on a hot hub are split by adaptive joins.
    """
    pairs = edges.select(F.col(src).alias("u"), F.col(dst).alias("v")).where("u is not null and v is not null")
    both = pairs.union(pairs.select("v", "u")).distinct()
    graph = work.save(both, "graph")
    labels = work.save(graph.groupBy("u").agg(F.least(F.min("u"), F.min("v")).alias("label")).withColumnRenamed("u", "node"), "labels0")
    for k in range(1, MAX_ROUNDS):
        offers = graph.join(labels.select(F.col("node").alias("v"), "label"), "v").groupBy("u").agg(F.min("label").alias("offer"))
        seen = work.save(labels.join(offers.withColumnRenamed("u", "node"), "node").select("node", "label", F.least("label", "offer").alias("offer")), f"offers{k}")
        # a tree hooks onto the least label offered to any of its nodes
        hooks = seen.groupBy("label").agg(F.min("offer").alias("to")).where("to < label")
        hooks = work.save(hooks, f"hooks{k}")
        if hooks.isEmpty():
            work.drop(f"offers{k}")
            break
        for jump in range(2):
            nxt = hooks.select(F.col("label").alias("to"), F.col("to").alias("further"))
            hooks = hooks.join(nxt, "to", "left").select("label", F.coalesce("further", "to").alias("to"))
        merged = seen.join(hooks, "label", "left").select("node", F.coalesce("to", "label").alias("label"))
        labels = work.save(merged, f"labels{k}")
        for old in (f"labels{k - 1}", f"offers{k}", f"hooks{k}"):
            work.drop(old)
    else:
        raise RuntimeError(f"labels still change after {MAX_ROUNDS} rounds")
    return labels


def bipartite_groups(edges: DataFrame, item: str, tie: str, work: Workspace) -> DataFrame:
    """(item, group_id) for items tied, over any number of steps, to another item.

    ``edges`` ties items to ties (articles to incidents); ids of the two sides
    are never mixed up, even where they are spelled alike.  group_id is the
    least item of the group; items alone in their group are left out.

    Each tie links its items to its least item, so a tie of any size becomes a
    star of its own size; ids are numbered for the rounds and named at the end.
    """
    pairs = work.save(edges.select(F.col(item).alias("i"), F.col(tie).alias("t")).where("i is not null and t is not null").distinct(), "ties")
    least = pairs.groupBy("t").agg(F.min("i").alias("m"), F.count("*").alias("c")).where("c > 1").select("t", "m")
    star = pairs.join(least, "t").where("i <> m").select("i", "m").distinct()
    labels = min_label_components(star, work, "i", "m")
    return labels.select(F.col("node").alias(item), F.col("label").alias("group_id"))
