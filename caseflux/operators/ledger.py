"""An append-only decision ledger: merge, split, snapshot, restore, overrides.

A ledger is a DataFrame of decisions; operations return the rows to append.
Nothing is updated: a row is live while no other row supersedes it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

COLUMNS = ("decision_id", "enriched_event_id", "deduplicated_event_id", "action", "certainty", "superseded_by", "created_at")


def live(decisions: DataFrame) -> DataFrame:
    """Live rows, rows delivered twice counted once."""
    return decisions.where("superseded_by is null").dropDuplicates(["decision_id"])


def membership(decisions: DataFrame) -> DataFrame:
    """(deduplicated_event_id, enriched_event_id) of the live merges not taken back later."""
    rows = live(decisions).where("enriched_event_id is not null and deduplicated_event_id is not null and action in ('merge', 'revert')")
    last = rows.groupBy("deduplicated_event_id", "enriched_event_id").agg(F.max_by("action", F.struct("created_at", "decision_id")).alias("action"))
    return last.where("action = 'merge'").select("deduplicated_event_id", "enriched_event_id")


def _decision(members: DataFrame, action: str, at: Column) -> DataFrame:
    key = F.sha2(F.concat_ws("|", F.lit(action), "deduplicated_event_id", "enriched_event_id", at.cast("string")), 256)
    return members.select(
        F.substring(key, 1, 32).alias("decision_id"), "enriched_event_id", "deduplicated_event_id", F.lit(action).alias("action"), F.lit(1.0).alias("certainty"), F.lit(None).cast("string").alias("superseded_by"), at.alias("created_at")
    )


def merge(decisions: DataFrame, target: str, source: str, at: Column) -> DataFrame:
    """Rows that move every member of ``source`` to ``target``; an incident is not merged into itself."""
    if target == source:
        raise ValueError("an incident cannot be merged into itself")
    moved = membership(decisions).where(F.col("deduplicated_event_id") == source)
    return _decision(moved, "revert", at).unionByName(_decision(moved.withColumn("deduplicated_event_id", F.lit(target)), "merge", at))


def split(decisions: DataFrame, incident: str, article: str, new_incident: str, at: Column) -> DataFrame:
    """Rows that take one article out of an incident and give it its own."""
    gone = membership(decisions).where((F.col("deduplicated_event_id") == incident) & (F.col("enriched_event_id") == article))
    return _decision(gone, "revert", at).unionByName(_decision(gone.withColumn("deduplicated_event_id", F.lit(new_incident)), "merge", at))


def snapshot(decisions: DataFrame) -> DataFrame:
    """(deduplicated_event_id, payload_json): the members of every incident."""
    return membership(decisions).groupBy("deduplicated_event_id").agg(F.to_json(F.struct(F.array_sort(F.collect_list("enriched_event_id")).alias("members"))).alias("payload_json"))


def restore(decisions: DataFrame, snapshots: DataFrame, at: Column) -> DataFrame:
    """Rows that bring the incidents of ``snapshots`` back to their members."""
    wanted = snapshots.select("deduplicated_event_id", F.explode(F.from_json("payload_json", "struct<members:array<string>>")["members"]).alias("enriched_event_id"))
    now = membership(decisions)
    named = snapshots.select("deduplicated_event_id").distinct()
    back = wanted.join(now, ["deduplicated_event_id", "enriched_event_id"], "left_anti")
    # members that sit elsewhere since then leave, as do strangers in a restored incident
    elsewhere = now.join(back.select("enriched_event_id").distinct(), "enriched_event_id", "left_semi").join(named, "deduplicated_event_id", "left_anti")
    strangers = now.join(named, "deduplicated_event_id", "left_semi").join(wanted, ["deduplicated_event_id", "enriched_event_id"], "left_anti")
    leave = elsewhere.select("deduplicated_event_id", "enriched_event_id").unionByName(strangers.select("deduplicated_event_id", "enriched_event_id")).distinct()
    return _decision(leave, "revert", at).unionByName(_decision(back, "merge", at))


def keep_latest(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Upsert by key: of rows with equal keys the last by ``order`` stays; nulls come first.

    An aggregate, so that rows of a hot key shrink to one a task before they are moved.
    """
    last = rows.groupBy(*keys).agg(F.max_by(F.struct(*rows.columns), F.struct(*order)).alias("_row"))
    return last.select("_row.*")


def calibrated_threshold(current: float, sample: int, false_merges: int, missed_merges: int) -> float:
    """Merge threshold after review: a step of 0.02 where five or more overrides lean one way."""
    if sample < 5 or false_merges == missed_merges:
        return current
    return round(min(0.97, max(0.60, current + (0.02 if false_merges > missed_merges else -0.02))), 4)
