"""Merges applied transitively: every chain of merges ends at one incident."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseflux.session import Workspace


def merge_targets(merges: DataFrame, work: Workspace, source: str = "source", target: str = "target", most_rounds: int = 64) -> DataFrame:
    """(incident, final): where each incident ends when all merges are applied.

    A source merged twice follows its least target; a cycle ends at its least
    member.  Each round doubles the distance a pointer spans, so the rounds
    are logarithmic in the longest chain; each is written to the shared folder.
    """
    rows = merges.select(F.col(source).alias("s"), F.col(target).alias("t")).where("s is not null and t is not null and s <> t")
    jump = work.save(rows.groupBy("s").agg(F.min("t").alias("t"), F.least(F.min("t"), F.min("s")).alias("least")), "jump0")
    for k in range(1, most_rounds):
        nxt = jump.select(F.col("s").alias("t"), F.col("t").alias("t2"), F.col("least").alias("least2"))
        # a pointer that ends outside the sources has arrived; "least" is the least incident passed so far
        wider = jump.join(nxt, "t", "left").select("s", F.coalesce("t2", "t").alias("t"), F.least("least", F.coalesce("least2", "least")).alias("least"), F.col("t2").isNotNull().alias("open"))
        jump = work.save(wider, f"jump{k}")
        work.drop(f"jump{k - 1}")
        if 2**k > 2 * jump.count() or jump.where("open").isEmpty():
            break
    # still open after more steps than incidents: it runs in a cycle
    return jump.select(F.col("s").alias("incident"), F.when(F.col("open"), F.col("least")).otherwise(F.col("t")).alias("final"))
