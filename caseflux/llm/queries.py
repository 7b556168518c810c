"""The pN queries of the training-data problems, over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseflux.llm import components, encoding, fusion, incremental, leakage, names, neardup, packing, quality
from caseflux.llm.oracles import ORACLES  # noqa: F401  (part of the catalogue)
from caseflux.session import Workspace
from caseflux.sources.tables import table

RUN1 = "asd_risk_classifications_20251118_153149"
RUN2 = "asd_risk_classifications_20251118_154100"


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    """New-batch articles that repeat something of an earlier batch."""
    read = [table(spark, d, t) for t in ("decisions", "batches", "extracted_event_details")]
    return incremental.repeats_of_new_batches(*read, Workspace(spark, "p1"))


def _garbled(spark: SparkSession, d: str) -> DataFrame:
    work = Workspace(spark, "p2")
    parts = (("summary", table(spark, d, "extracted_event_details"), "enriched_event_id"), ("title", table(spark, d, RUN1), "deduplicated_event_id"))
    # both columns teach: a way of reading seen in one is known in the other
    texts = reduce(DataFrame.unionByName, [rows.select(F.col(field).alias("text")) for field, rows, _ in parts])
    learned = encoding.Learned(encoding.learn_mappings(texts.where("text is not null"), work), work)
    found = [encoding.restore_garbled(rows, key, field, work, learned).select(F.lit(field).alias("field"), F.col("id").alias("record_id"), "restored", "complete") for field, rows, key in parts]
    return reduce(DataFrame.unionByName, found)


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    """Records that hold a sequence read in the wrong encoding."""
    return _garbled(spark, d).select("field", "record_id").distinct()


def p2_restored(spark: SparkSession, d: str) -> DataFrame:
    """The restored text of garbled records; complete is false where characters are lost."""
    return _garbled(spark, d)


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    """Near-duplicate summaries, and match rows with near-duplicate titles."""
    details, evidence = table(spark, d, "extracted_event_details"), table(spark, d, "match_evidence")
    summary = neardup.near_duplicate_pairs(details, "enriched_event_id", "summary", Workspace(spark, "p3"))
    title = neardup.near_duplicate_sides(evidence, "left_enriched_event_id", "right_enriched_event_id", "title_left", "title_right")
    return summary.select(F.lit("summary").alias("field"), "left_id", "right_id").unionByName(title.select(F.lit("title").alias("field"), "left_id", "right_id"))


def p3_groups(spark: SparkSession, d: str) -> DataFrame:
    """One row per article: its class, its number of linked classes, its group."""
    work = Workspace(spark, "p3g")
    members, links = neardup.near_duplicate_classes(table(spark, d, "extracted_event_details"), "enriched_event_id", "summary", work)
    both = links.select(F.col("a").alias("h"), "b").union(links.select("b", "a"))
    degree = both.groupBy("h").agg(F.count("*").alias("links"))
    groups = components.min_label_components(links, work, "a", "b").select(F.col("node").alias("h"), "label")
    rows = members.join(degree, "h", "left").join(groups, "h", "left")
    return rows.select(F.col("id").alias("enriched_event_id"), F.col("h").alias("class_id"), F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("label", "h").alias("group_id"))


def _survivors(spark: SparkSession, d: str, by_belief: bool = False) -> DataFrame:
    work = Workspace(spark, "p4")
    claims = fusion.snapshot_claims(table(spark, d, "snapshots"), table(spark, d, "match_evidence"), work)
    return fusion.survivors(claims, work, by_belief=by_belief)


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    """For each incident and field the member whose value survives."""
    return _survivors(spark, d).select(F.col("group").alias("deduplicated_event_id"), F.col("field").alias("field_name"), F.col("member").alias("enriched_event_id"))


def p4_records(spark: SparkSession, d: str) -> DataFrame:
    """One record per incident, each field filled by the value believed most, with all values judged true."""
    fields = [*fusion.MEMBER_FIELDS, "event_date", "entity_canonical"]
    rows = _survivors(spark, d, by_belief=True).groupBy(F.col("group").alias("deduplicated_event_id")).pivot("field", fields).agg(F.first("value").alias("value"), F.first("kept").alias("kept"))
    return rows.select("deduplicated_event_id", *(F.col(f"{f}_value").alias(f) for f in fields), *(F.col(f"{f}_kept").alias(f"{f}_all") for f in fields))


def _merge_edges(spark: SparkSession, d: str) -> DataFrame:
    live = table(spark, d, "decisions").where("action = 'merge' and superseded_by is null and deduplicated_event_id is not null and enriched_event_id is not null")
    return live.select("enriched_event_id", "deduplicated_event_id")


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    """Group of every article that hangs together with another one."""
    return components.bipartite_groups(_merge_edges(spark, d), "enriched_event_id", "deduplicated_event_id", Workspace(spark, "p5"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    """Typed names that mean a listed entity but are not spelled like it."""
    fields = (("primary_entity", "extracted_event_details", "enriched_event_id"), ("victim_organization_name", RUN2, "deduplicated_event_id"), ("entity_left", "match_evidence", "decision_id"))
    typed = None
    for field, name, key in fields:
        rows = table(spark, d, name).select(F.lit(field).alias("field"), F.col(key).alias("record_id"), F.col(field).alias("name")).where("record_id is not null and trim(name) <> ''")
        typed = rows if typed is None else typed.unionByName(rows)
    entities = table(spark, d, "entities")
    work = Workspace(spark, "p6")
    linked = work.save(names.link_names(typed.select("name"), entities, work), "linked")
    proper = entities.select("entity_id", "entity_name")
    variants = linked.join(proper, "entity_id").where("name <> entity_name").select("name", F.col("entity_id").cast("int").alias("entity_id"))
    return typed.join(variants, "name").select("field", "record_id", "entity_id").distinct()


def p7_containers(spark: SparkSession, d: str) -> DataFrame:
    """The container of 2,048 tokens of each document or piece."""
    return packing.pack_documents(table(spark, d, "documents"), Workspace(spark, "p7"))


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    """Documents that carry at least half of a held-out item."""
    return leakage.find_leaks(table(spark, d, "documents"), table(spark, d, "eval_items"), Workspace(spark, "p8")).select("doc_id", "item_id")


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    """Documents that are not natural prose."""
    return quality.score_documents(table(spark, d, "documents"), table(spark, d, "doc_labels")).where("p_other > 0.5").select("doc_id").distinct()


def p9_statistics(spark: SparkSession, d: str) -> DataFrame:
    """The text statistics of every document."""
    return quality.text_statistics(table(spark, d, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "p1_found": p1_found,
    "p2_found": p2_found,
    "p2_restored": p2_restored,
    "p3_found": p3_found,
    "p3_groups": p3_groups,
    "p4_found": p4_found,
    "p4_records": p4_records,
    "p5_found": p5_found,
    "p6_found": p6_found,
    "p7_containers": p7_containers,
    "p8_found": p8_found,
    "p9_found": p9_found,
    "p9_statistics": p9_statistics,
}
