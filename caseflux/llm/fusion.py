"""Problem 4: the surviving value of each field of a duplicate group.

Members of a group claim values.  A two-sided latent truth model learns, for
each source, how often it states a true value (sensitivity) and how often it
keeps silent on a false one (specificity), by expectation-maximisation over
the claims.  Every value judged true is kept for multi-valued fields; one
survives: by belief, or by a rule of the caller (trust, then recency) that
leaves to the belief what it ties.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseflux.session import Workspace

#: Rounds end when no sensitivity or specificity moves by more than this, or at the latest after so many.
TOLERANCE, ROUNDS = 0.005, 30
#: Sources up to which their quality is written into the plan; more are joined.
MAPPED = 256
PRIOR_TRUE = 0.5
# Pseudo-counts that keep sources of few claims near the start.
SMOOTH_TRUE, SMOOTH_FALSE = (8.0, 2.0), (2.0, 8.0)

# Texts that say that nothing is known.
FILLERS = (
    "", "-", "--", "?", "n/a", "na", "none", "null", "nil", "nan", "unknown", "untitled", "undated", "no title", "[no title]", "not available", "not stated", "not known", "not given", "not specified", "not reported",
    "not disclosed", "not provided", "not applicable", "unspecified", "undisclosed", "missing", "pending", "tbc", "tba", "tbd", "to be confirmed", "to be advised", "to be determined", "(none)", "[unknown]", "n.a.",
)
LAST_DATE = "2025-12-31"
_MONTHS = "janfebmaraprmayjunjulaugsepoctnovdec"


def usable_text(c: Column) -> Column:
    """The trimmed text, null where it is blank or a filler."""
    t = F.trim(F.regexp_replace(c, "[\\s\\u00a0]+", " "))
    return F.when(~F.lower(t).isin(*FILLERS), t)


def usable_count(c: Column) -> Column:
    """A count of at least zero given as a number or as text, else null."""
    t = F.regexp_replace(F.trim(c), "[, _]", "")
    return F.when(t.rlike("^\\+?\\d+(\\.0*)?$"), F.regexp_replace(t, "^\\+|\\..*$", "").try_cast("decimal(38,0)"))


def usable_date(c: Column) -> Column:
    """An existing day up to LAST_DATE, in ISO or written-out notation, else null."""
    t = F.trim(c)
    iso = F.regexp_extract(t, "^(\\d{4}-\\d{1,2}-\\d{1,2})(?:[T ].*)?$", 1).try_cast("date")
    dmy = "^(\\d{1,2})(?:st|nd|rd|th)?[ -]([A-Za-z]{3,9})\\.?,?[ -](\\d{4})$"
    mdy = "^([A-Za-z]{3,9})\\.? (\\d{1,2})(?:st|nd|rd|th)?,? (\\d{4})$"
    slash = "^(\\d{1,2})[/.](\\d{1,2})[/.](\\d{4})$"

    def day(y: Column, m: Column, d: Column) -> Column:
        return F.concat_ws("-", y, F.lpad(m, 2, "0"), F.lpad(d, 2, "0")).try_cast("date")

    def month(name: Column) -> Column:
        at = F.instr(F.lit(_MONTHS), F.lower(F.substring(name, 1, 3)))
        return F.when((at > 0) & (at % 3 == 1), ((at + 2) / 3).cast("int")).cast("string")

    g = lambda p, k: F.regexp_extract(t, p, k)
    when = (
        F.when(t.rlike(dmy), day(g(dmy, 3), month(g(dmy, 2)), g(dmy, 1)))
        .when(t.rlike(mdy), day(g(mdy, 3), month(g(mdy, 1)), g(mdy, 2)))
        .when(t.rlike(slash), day(g(slash, 3), g(slash, 2), g(slash, 1)))
        .otherwise(iso)
    )
    return F.when(when <= F.lit(LAST_DATE).cast("date"), when)


def _topics(claims: DataFrame, keys: list[str], best: Column) -> DataFrame:
    """(keys, facts): one row for each topic, with (value, votes, best) of each value said of it.

    votes: (source, yes, no) of each source that speaks on the topic.  One shuffle by
    the keys at most, none where ``claims`` already lie by some of them.
    """
    said = claims.groupBy(*keys, "value", "source").agg(F.count("*").alias("said"), F.min(best).alias("best"))
    value = said.groupBy(*keys, "value").agg(F.array_sort(F.collect_list(F.struct("source", "said"))).alias("yes"), F.min("best").alias("best"))
    topic = value.groupBy(*keys).agg(F.collect_list(F.struct("value", "yes", "best")).alias("facts"))
    of = "coalesce(aggregate(filter({}, y -> y.source <=> {}), 0L, (n, y) -> n + y.said), 0L)"
    topic = topic.withColumn("every", F.expr("flatten(facts.yes)")).withColumn("sources", F.expr("array_sort(array_distinct(every.source))"))
    topic = topic.withColumn("spoke", F.expr(f"transform(sources, s -> struct(s as source, {of.format('every', 's')} as n))"))
    votes = f"transform(spoke, p -> struct(p.source as source, {of.format('f.yes', 'p.source')} as yes, p.n - {of.format('f.yes', 'p.source')} as no))"
    return topic.select(*keys, F.expr(f"transform(facts, f -> struct(f.value as value, {votes} as votes, f.best as best))").alias("facts"))


class Quality:
    """How often each source states a true value (sens) and a false one (fall).

    Up to MAPPED sources are constants of the plan, so a belief is worked out in
    the row that has the votes; more are a table that the votes are joined with.
    """

    def __init__(self, rows: DataFrame, work: Workspace, name: str):
        few = rows.limit(MAPPED + 1).collect()
        self.mapped = {r["source"]: (r["sens"], r["fall"]) for r in few} if len(few) <= MAPPED else None
        self.table = work.spark.createDataFrame([tuple(r) for r in few], rows.schema) if self.mapped is not None else work.save(rows, name)

    def moved(self, before: Quality) -> float:
        """The largest step of any sensitivity or specificity since ``before``."""
        if self.mapped is not None:
            return max((abs(x - y) for s, now in self.mapped.items() for x, y in zip(now, before.mapped[s])), default=0.0)
        old = before.table.select("source", F.col("sens").alias("s0"), F.col("fall").alias("f0"))
        return self.table.join(old, "source").agg(F.max(F.greatest(F.abs(F.col("sens") - F.col("s0")), F.abs(F.col("fall") - F.col("f0"))))).first()[0] or 0.0

    def _belief(self, llr: Column) -> Column:
        return 1 / (1 + F.exp(-llr + math.log((1 - PRIOR_TRUE) / PRIOR_TRUE)))

    def belief(self, votes: Column) -> Column:
        """The belief in a fact by its votes; for mapped sources."""
        known = [(s, r) for s, r in sorted(self.mapped.items(), key=lambda x: str(x[0])) if s is not None]
        if not known:
            return F.lit(PRIOR_TRUE)
        yes = F.create_map(*(F.lit(x) for s, (sens, fall) in known for x in (s, math.log(sens / fall))))
        no = F.create_map(*(F.lit(x) for s, (sens, fall) in known for x in (s, math.log((1 - sens) / (1 - fall)))))
        weigh = lambda v: v["yes"] * F.coalesce(F.try_element_at(yes, v["source"]), F.lit(0.0)) + v["no"] * F.coalesce(F.try_element_at(no, v["source"]), F.lit(0.0))
        return self._belief(F.aggregate(votes, F.lit(0.0), lambda s, v: s + weigh(v)))

    def believe(self, rows: DataFrame) -> DataFrame:
        """``rows`` with the belief in their votes."""
        if self.mapped is not None:
            return rows.withColumn("belief", self.belief(F.col("votes")))
        v = rows.select("votes").distinct().withColumn("v", F.explode("votes")).select("votes", "v.*")
        odds = F.col("yes") * F.log(F.col("sens") / F.col("fall")) + F.col("no") * F.log((1 - F.col("sens")) / (1 - F.col("fall")))
        llr = v.join(self.table, "source").groupBy("votes").agg(F.sum(odds).alias("llr"))
        return rows.join(llr, "votes", "left").withColumn("belief", self._belief(F.coalesce("llr", F.lit(0.0)))).drop("llr")


def _settled(topics: DataFrame, work: Workspace, rounds: int, tolerance: float) -> Quality:
    """The quality of the sources by expectation-maximisation, until it settles.

    Facts with the same votes are counted together before the rounds, so a
    round's work follows the number of distinct vote patterns.
    """
    patterns = work.save(topics.select(F.explode("facts.votes").alias("votes")).groupBy("votes").agg(F.count("*").alias("n")), "patterns")
    start = patterns.select(F.explode("votes.source").alias("source")).distinct()
    quality = Quality(start.select("source", F.lit(SMOOTH_TRUE[0] / sum(SMOOTH_TRUE)).alias("sens"), F.lit(SMOOTH_FALSE[0] / sum(SMOOTH_FALSE)).alias("fall")), work, "quality")
    for k in range(rounds):
        w = quality.believe(patterns).select("n", "belief", F.explode("votes").alias("v")).select("n", "belief", "v.*")
        total = F.col("yes") + F.col("no")
        t, f = F.col("n") * F.col("belief"), F.col("n") * (1 - F.col("belief"))
        rates = w.groupBy("source").agg(F.sum(t * F.col("yes")).alias("ty"), F.sum(t * total).alias("ta"), F.sum(f * F.col("yes")).alias("fy"), F.sum(f * total).alias("fa"))
        now = rates.select("source", ((F.col("ty") + SMOOTH_TRUE[0]) / (F.col("ta") + sum(SMOOTH_TRUE))).alias("sens"), ((F.col("fy") + SMOOTH_FALSE[0]) / (F.col("fa") + sum(SMOOTH_FALSE))).alias("fall"))
        before, quality = quality, Quality(now, work, f"quality{k}")
        if quality.moved(before) <= tolerance:
            break
    return quality


def source_quality(claims: DataFrame, work: Workspace, rounds: int = ROUNDS, tolerance: float = TOLERANCE) -> tuple[DataFrame, DataFrame]:
    """(facts with belief, sources with sensitivity and specificity).

    ``claims``: (topic, value, source), what is spoken of and what is said.
    A source that speaks on a topic denies the values it does not state.
    """
    topics = work.save(_topics(claims, ["topic"], F.lit(0)), "topics")
    quality = _settled(topics, work, rounds, tolerance)
    facts = topics.select("topic", F.explode("facts").alias("f")).select("topic", "f.value", "f.votes")
    return quality.believe(facts).select("topic", "value", "belief"), quality.table.select("source", F.col("sens").alias("sensitivity"), (1 - F.col("fall")).alias("specificity"))


def survivors(claims: DataFrame, work: Workspace, rounds: int = ROUNDS, by_belief: bool = False) -> DataFrame:
    """(group, field, member, value, belief, kept): one row for each field with a usable value.

    ``claims``: (group, field, value, member, source, weight, updated_at).
    Order: highest weight, latest update, highest belief, least member id;
    unknown weights and times come last.  With ``by_belief`` the belief comes
    first and decides wherever sources disagree.  ``kept`` lists every value judged
    true (belief of at least a half), the survivor's among them.  Null groups,
    fields, members and values claim nothing; repeated claims count once.
    """
    claims = claims.where("group is not null and field is not null and member is not null and value is not null").distinct()
    w, u = -F.coalesce("weight", F.lit(-1.0)), -F.coalesce(F.unix_micros(F.col("updated_at").cast("timestamp")), F.lit(-(2**62)))
    # all claims of a value have one belief, so the first of them by the rest of the order stands for it
    topics = work.save(_topics(claims, ["group", "field"], F.struct(w.alias("w"), u.alias("u"), "member")), "topics")
    quality = _settled(topics, work, rounds, TOLERANCE)
    if quality.mapped is not None:
        believed = topics.withColumn("facts", F.transform("facts", lambda f: F.struct(f["value"].alias("value"), f["best"].alias("best"), quality.belief(f["votes"]).alias("belief"))))
    else:
        facts = topics.select("group", "field", F.explode("facts").alias("f")).select("group", "field", "f.*")
        believed = quality.believe(facts).groupBy("group", "field").agg(F.collect_list(F.struct("value", "best", "belief")).alias("facts"))

    def order(f: Column) -> Column:
        rule, belief = [f["best"]["w"].alias("w"), f["best"]["u"].alias("u")], [(-F.round(f["belief"], 9)).alias("b")]
        return F.struct(*(belief + rule if by_belief else rule + belief), f["best"]["member"].alias("member"), f["value"].alias("value"))

    kept = F.array_sort(F.transform(F.filter("facts", lambda f: f["belief"] >= 0.5), lambda f: f["value"]))
    one = believed.select("group", "field", F.array_min(F.transform("facts", order)).alias("s"), kept.alias("kept"))
    return one.select("group", "field", "s.member", "s.value", (-F.col("s.b")).alias("belief"), F.array_union("kept", F.array("s.value")).alias("kept"))


MEMBER_FIELDS = ("title", "severity", "records_affected", "attack_method")
_PAYLOAD = "struct<members:array<struct<enriched_event_id:string,contribution_type:string,data_source_weight:string,updated_at:string,title:string,severity:string,records_affected:string,attack_method:string>>>"


def snapshot_claims(snapshots: DataFrame, evidence: DataFrame, work: Workspace) -> DataFrame:
    """Claims of the members of each incident's latest readable snapshot.

    A payload that is null or no JSON cannot be read.  Values that say nothing
    (absent, blank, fillers, negative counts, dates that do not exist or lie
    after 2025) are no claims.  Source: the member's contribution and trust.
    """
    readable = snapshots.where("deduplicated_event_id is not null and created_at is not null").where(F.try_parse_json("payload_json").isNotNull())
    parsed = readable.select("deduplicated_event_id", "created_at", "snapshot_id", F.from_json("payload_json", _PAYLOAD)["members"].alias("members"))
    latest = parsed.groupBy("deduplicated_event_id").agg(F.max_by("members", F.struct("created_at", "snapshot_id")).alias("members"))
    m = latest.select(F.col("deduplicated_event_id").alias("group"), F.explode("members").alias("m")).select("group", "m.*").where("enriched_event_id is not null")
    m = work.save(
        m.select(
            "group",
            F.col("enriched_event_id").alias("member"),
            F.concat_ws("@", "contribution_type", "data_source_weight").alias("source"),
            F.col("data_source_weight").try_cast("double").alias("weight"),
            F.col("updated_at").try_cast("timestamp_ntz").alias("updated_at"),
            usable_text(F.col("title")).alias("title"),
            usable_text(F.col("severity")).alias("severity"),
            usable_count(F.col("records_affected")).cast("string").alias("records_affected"),
            usable_text(F.col("attack_method")).alias("attack_method"),
        ),
        "members",
    )
    seen = evidence.select(F.col("left_enriched_event_id").alias("member"), usable_date(F.col("date_left")).cast("string").alias("event_date"), usable_text(F.col("entity_canonical_left")).alias("entity_canonical"))
    seen = seen.where("member is not null").groupBy("member").agg(F.max("event_date").alias("event_date"), F.min("entity_canonical").alias("entity_canonical"))
    claim = ("group", "member", "source", "weight", "updated_at")
    # only ids and trust travel to the evidence; what is known by member then meets the payload's values by group
    known = m.select(*claim).join(seen, "member").where("event_date is not null or entity_canonical is not null")
    both = m.unionByName(known, allowMissingColumns=True).repartition("group")
    fields = (*MEMBER_FIELDS, "event_date", "entity_canonical")
    claimed = F.filter(F.array(*(F.struct(F.lit(f).alias("field"), F.col(f).alias("value")) for f in fields)), lambda x: x["value"].isNotNull())
    return both.select(*claim, F.explode(claimed).alias("c")).select("group", "c.field", "c.value", "member", "source", "weight", "updated_at")
