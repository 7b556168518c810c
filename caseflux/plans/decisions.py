"""Adjudication, titles, costs, models and further distributions."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from caseflux.functions import incidents as inc
from caseflux.plans.registry import query
from caseflux.plans.series import ACTIVE, EV, HALF, MEMBERS, RISK, RISKED, SEV, active, events, members, risks
from caseflux.sources.tables import table

# The ladder's limits.
FAR, NEAR, NEAR_DAYS, TITLE, TITLE_DAYS = 0.55, 0.93, 45, 0.75, 7


@query(
    "d29_adjudication",
    f"""select verdict, decided_by, count(*) as n, round(avg(certainty), 6) as certainty from (select case when len(coalesce(shared_urls, [])) > 0 then 'same' when not coalesce(entity_match, false) then 'different' when embedding_similarity < {FAR} then 'different' when embedding_similarity >= {NEAR} and coalesce(date_delta_days, 0) <= {NEAR_DAYS} then 'same'
    when coalesce(title_similarity, 0) >= {TITLE} and coalesce(nullif(date_delta_days, 0), 999) <= {TITLE_DAYS} then 'same' else 'different' end as verdict,
    case when len(coalesce(shared_urls, [])) > 0 or not coalesce(entity_match, false) then 'rule' when embedding_similarity < {FAR} or (embedding_similarity >= {NEAR} and coalesce(date_delta_days, 0) <= {NEAR_DAYS}) then 'embedding' else 'rule' end as decided_by,
    case when len(coalesce(shared_urls, [])) > 0 then 0.99 when not coalesce(entity_match, false) then 0.9 when embedding_similarity < {FAR} then 0.8 when embedding_similarity >= {NEAR} and coalesce(date_delta_days, 0) <= {NEAR_DAYS} then least(0.95, embedding_similarity) else 0.6 end as certainty
    from (select distinct decision_id, shared_urls, entity_match, embedding_similarity, title_similarity, date_delta_days from match_evidence)) group by 1, 2""",
)
def d29(spark, d):
    """The verdict ladder over stored evidence: shared link, entities, vectors, then titles and days.

    A gap of zero days counts as unknown in the last step, as in the original rule.
    """
    e = table(spark, d, "match_evidence").select("decision_id", "shared_urls", "entity_match", "embedding_similarity", "title_similarity", "date_delta_days").distinct()
    url = F.coalesce(F.size("shared_urls") > 0, F.lit(False))
    other = ~F.coalesce("entity_match", F.lit(False))
    sim = F.col("embedding_similarity")
    near = (sim >= NEAR) & (F.coalesce("date_delta_days", F.lit(0)) <= NEAR_DAYS)
    title = (F.coalesce("title_similarity", F.lit(0.0)) >= TITLE) & (F.coalesce(F.nullif("date_delta_days", F.lit(0)), F.lit(999)) <= TITLE_DAYS)
    ladder = lambda a, b, c, d_, e_, f: F.when(url, a).when(other, b).when(sim < FAR, c).when(near, d_).when(title, e_).otherwise(f)
    verdict = e.select(
        ladder(*(F.lit(x) for x in ("same", "different", "different", "same", "same", "different"))).alias("verdict"),
        ladder(*(F.lit(x) for x in ("rule", "rule", "embedding", "embedding", "rule", "rule"))).alias("decided_by"),
        ladder(F.lit(0.99), F.lit(0.9), F.lit(0.8), F.least(F.lit(0.95), sim), F.lit(0.6), F.lit(0.6)).alias("certainty"),
    )
    return verdict.groupBy("verdict", "decided_by").agg(F.count("*").alias("n"), F.round(F.avg("certainty"), 6).alias("certainty"))












# Price of a thousand classified rows by model.
PRICES = (("model-a", 1.5), ("model-b", 0.6))












@query("a27_matrix_blank_zero", f"select primary_stakeholder_category as stakeholder, " + ", ".join(f"nullif(count(distinct deduplicated_event_id) filter (where severity_category = 'C{k}'), 0) as c{k}" for k in range(1, 7)) + f" from {RISKED} where primary_stakeholder_category is not null group by 1")
def a27(spark, d):
    rows = risks(spark, d).where("primary_stakeholder_category is not null").groupBy(F.col("primary_stakeholder_category").alias("stakeholder"))
    wide = rows.pivot("severity_category", [f"C{k}" for k in range(1, 7)]).agg(F.countDistinct("deduplicated_event_id"))
    return wide.select("stakeholder", *(F.nullif(F.col(f"C{k}"), F.lit(0)).alias(f"c{k}") for k in range(1, 7)))


@query("a39_dedup_statistics", f"select count(distinct deduplicated_event_id) as incidents, count(*) as links, count(distinct enriched_event_id) as articles, round(count(*) * 1.0 / count(distinct deduplicated_event_id), 4) as mean_size from {MEMBERS}")
def a39(spark, d):
    g = F.countDistinct("deduplicated_event_id")
    return members(spark, d).agg(g.alias("incidents"), F.count("*").alias("links"), F.countDistinct("enriched_event_id").alias("articles"), F.round(F.count("*") / g, 4).alias("mean_size"))








@query("f17_forest_filter", None)
def f17(spark, d):
    """Keep/drop of documents by a random forest on hashed term weights, trained on the labelled rows."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.feature import IDF, HashingTF, RegexTokenizer

    docs = table(spark, d, "documents").where("text is not null").select("doc_id", "text")
    labelled = docs.join(table(spark, d, "doc_labels"), "doc_id").withColumn("label", (F.col("kind") == "prose").cast("double"))
    stages = [RegexTokenizer(inputCol="text", outputCol="words", pattern="\\W+"), HashingTF(inputCol="words", outputCol="tf", numFeatures=1 << 10), IDF(inputCol="tf", outputCol="features"), RandomForestClassifier(numTrees=20, maxDepth=5, seed=7)]
    scored = Pipeline(stages=stages).fit(labelled).transform(docs)
    from pyspark.ml.functions import vector_to_array

    # dropped only if the forest says no and gives prose less than 0.4
    keep = (F.col("prediction") == 1.0) | (vector_to_array("probability")[1] >= 0.4)
    return scored.select("doc_id", keep.alias("keep"))
