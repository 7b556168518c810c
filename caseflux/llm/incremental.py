"""Problem 1: which articles of new batches repeat something already there."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseflux.llm import chunks as ch
from caseflux.llm import neardup as nd
from caseflux.llm import wordlookup as wl
from caseflux.session import Workspace, broadcast_if_small


def repeats_of_new_batches(
    decisions: DataFrame, batches: DataFrame, articles: DataFrame, work: Workspace, t: float = nd.THRESHOLD, coverage: float = ch.COVERAGE, index_path: str | None = None
) -> DataFrame:
    """(batch_id, enriched_event_id) of new-batch articles that repeat earlier ones.

    An article repeats if it stands in a batch opened earlier, or if an article
    of such a batch has a summary whose words overlap by ``t``.  Candidates
    come from the chunk table by coverage; classes that these leave undecided
    are looked up by their words, which loses none.  All are verified exactly.

    ``index_path`` names a chunk index that stays: a later call chunks only
    what the index has not seen, asks, and appends what the new batches bring.
    Without it the index is made in the workspace and goes with it.

    Rows with a null or unknown batch or a null article count for nothing,
    rows delivered twice count once, batches opened at the same moment are not
    earlier than each other, articles without a summary repeat by id only.
    """
    articles = articles.select("enriched_event_id", "summary")
    opened = batches.select("batch_id", "opened_at", "state").where("batch_id is not null and opened_at is not null").dropDuplicates(["batch_id"])
    opened = broadcast_if_small(opened, opened.count(), 120)
    stood = decisions.select("batch_id", F.col("enriched_event_id").alias("id")).where("id is not null").join(opened, "batch_id")
    stood = work.save(stood.select("batch_id", "id", "opened_at", "state").distinct(), "standing")
    first = work.save(stood.groupBy("id").agg(F.min("opened_at").alias("first_open"), F.max(F.col("state") == "new").alias("in_new")), "first_open")
    begin = stood.where("state = 'new'").agg(F.min("opened_at")).first()[0]
    fresh = stood.where("state = 'new'").select("batch_id", "id", "opened_at")
    if begin is None:
        return fresh.select("batch_id", F.col("id").alias("enriched_event_id"))

    # what first stands in a new batch asks; all else is history
    asking = work.save(first.where(F.col("in_new") & (F.col("first_open") >= F.lit(begin))).select("id", "first_open"), "asking_ids")
    n = asking.count()
    of_id = F.col("enriched_event_id").cast("string") == F.col("id")
    index = ch.ChunkIndex(work.spark, index_path or f"{work.root}/chunk_index")
    order = index.order(articles, "enriched_event_id", "summary")

    def chunked(rows: DataFrame, name: str) -> DataFrame:
        return work.save(ch.chunk_records(rows, "enriched_event_id", "summary", order, t), name)

    past = articles.join(broadcast_if_small(asking.select("id"), n, 80), of_id, "left_anti")
    seen = index.ids()
    if not seen.isEmpty():
        unseen = past.where("summary is not null").select(F.col("enriched_event_id").cast("string").alias("id")).distinct().join(seen, "id", "left_anti")
        unseen = work.save(unseen, "unseen")
        past = past.join(broadcast_if_small(unseen, unseen.count(), 80), of_id, "left_semi")
    index.append(chunked(past, "history_records"))
    batch = chunked(articles.join(broadcast_if_small(asking.select("id"), n, 80), of_id, "left_semi"), "asking_records")
    mine = work.save(batch.select("id", "h").distinct().join(asking, "id"), "asking_members")
    a = work.save(mine.groupBy("h").agg(F.min("first_open").alias("first_mine"), F.max("first_open").alias("last_mine")), "asking_classes")
    members = index.ids().unionByName(batch.select("id", "h")).distinct()

    def earliest(needed: DataFrame) -> DataFrame:
        """(h, there): when the first article of each class opened."""
        needed = needed.distinct()
        of_class = members.join(broadcast_if_small(needed, needed.count(), 24), "h", "left_semi")
        return of_class.join(first.select("id", "first_open"), "id").groupBy("h").agg(F.min("first_open").alias("there"))

    def verified(pairs: DataFrame, name: str) -> DataFrame:
        """(q, there) of the asking classes that a class opened earlier is near to."""
        pairs = work.save(pairs.select("q", "h").distinct(), f"{name}_pairs")
        when = work.save(earliest(pairs.select("h")), f"{name}_opened")
        # only what opened before the last article of the asking class can matter
        timed = pairs.join(a.select(F.col("h").alias("q"), "last_mine"), "q").join(when, "h").where("there < last_mine")
        links = nd.verify(timed.select(F.least("q", "h").alias("a"), F.greatest("q", "h").alias("b")).distinct(), members, articles, "enriched_event_id", "summary", work, t)
        links = work.save(links.select("a", "b"), f"{name}_links")
        both = links.select(F.col("a").alias("q"), F.col("b").alias("h")).union(links.select("b", "a"))
        return work.save(both.join(when, "h").join(a.select(F.col("h").alias("q")), "q", "left_semi").groupBy("q").agg(F.min("there").alias("there")), f"{name}_near")

    own = work.save(earliest(a.select("h")).select(F.col("h").alias("q"), "there"), "own_opened")
    found = own.unionByName(verified(index.candidates(batch, work, t, coverage), "chunk"))
    # undecided: nothing found so far is earlier than the first article of the class
    known = found.groupBy("q").agg(F.min("there").alias("there"))
    undecided = a.join(known.withColumnRenamed("q", "h"), "h", "left").where("not coalesce(there < first_mine, false)").select("h")
    undecided = work.save(undecided, "undecided")
    words = batch.select("h", "n", "fp", "prefix").where(F.size("prefix") > 0)
    history = index.records().select("h", "n", "fp", "prefix").where(F.size("prefix") > 0)
    left = words.join(broadcast_if_small(undecided, undecided.count(), 24), "h", "left_semi")
    found = found.unionByName(verified(wl.lookup(left, history.unionByName(words), work, t), "word"))

    there = found.groupBy(F.col("q").alias("h")).agg(F.min("there").alias("there"))
    by_text = mine.join(there, "h").groupBy("id").agg(F.min("there").alias("by_text"))
    asked = fresh.join(first.select("id", "first_open"), "id").join(by_text, "id", "left")
    out = work.save(asked.where(F.least("first_open", "by_text") < F.col("opened_at")).select("batch_id", F.col("id").alias("enriched_event_id")).distinct(), "repeats")
    # only an index that stays has a use for what the batches bring
    if index_path:
        again = index.ids().select("id").distinct()
        index.append(batch.join(again, "id", "left_anti") if not seen.isEmpty() else batch)
    return out
