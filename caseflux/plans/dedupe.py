"""Grouping, merging and reviewing duplicate records.

Records are compared only in blocks: one organisation, one title and day, or a
word that few records have.  Records of one organisation and day are one class
(the first rule merges them), so a block holds at most as many classes as there
are days and organisations in it, however many records it has.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseflux.operators.stars import greedy_stars
from caseflux.plans.dialect import run, sql_query, to_spark
from caseflux.plans.identity import ALIASES
from caseflux.plans.kernels import acronym_of, canonical, hits, jaccard, parts, word_set, words
from caseflux.plans.registry import query
from caseflux.plans.resolution import KEY
from caseflux.plans.series import EV, MEMBERS, RISKED
from caseflux.session import Workspace, broadcast_if_small

#: One row an article, whatever was delivered.
ONE = "(select enriched_event_id as id, min(title) as title, min(summary) as summary, min(nullif(trim(primary_entity), '')) as entity, max(event_date) as day, max(records_affected) as records, min(event_type) as kind from extracted_event_details where enriched_event_id is not null group by 1)"
KEYED = f"(select id, title, summary, entity, day, records, kind, {KEY.format('entity')} as k from {ONE})"
#: Classes: records of one organisation and day, shown by their first record.
CLASS = f"(select id, min(id) over (partition by case when k <> '' and day is not null then k || '@' || day::varchar else id end) as rep from {KEYED})"
NODES = f"(select id, title, k, day, {word_set('title')} as tw, {word_set('summary')} as sw, row_number() over (order by day desc nulls last, id) as place from {KEYED} where id in (select rep from {CLASS}))"
_RARE = f"(select w from (select id, unnest(sw) as w from {NODES}) group by w having count(*) between 2 and greatest(3, (select floor(count(*) * 0.005) from {NODES})))"
BLOCKS = f"(select id, 'e' || k as b from {NODES} where k <> '' union select id, 't' || lower(trim(title)) || '@' || day::varchar from {NODES} where title is not null and day is not null union select x.id, 'w' || x.w from (select id, unnest(sw) as w from {NODES}) x join {_RARE} r on r.w = x.w)"
_PAIRS = f"(select distinct a.id as i, b.id as j from {BLOCKS} a join {BLOCKS} b on a.b = b.b where a.id <> b.id)"
_FEATURES = f"""(select a.place as pi, b.place as pj, a.id as i, b.id as j, a.k <> '' and b.k <> '' and (a.k = b.k or (length(a.k) >= 5 and length(b.k) >= 5 and (contains(a.k, b.k) or contains(b.k, a.k)))) as same, lower(trim(a.title)) = lower(trim(b.title)) as same_title, abs(date_diff('day', a.day, b.day)) as gap,
 {jaccard('a.tw', 'b.tw')} as title_sim, {jaccard('a.sw', 'b.sw')} as text_sim from {_PAIRS} p join {NODES} a on a.id = p.i join {NODES} b on b.id = p.j where a.place < b.place)"""
TEMPORAL = "case when {g} is null then 0.5 when {g} = 0 then 1.0 when {g} <= 7 then 0.8 when {g} <= 30 then 0.6 when {g} <= 90 then 0.4 when {g} <= 365 then 0.2 else 0.0 end"
#: The rule that ties two records, the first that holds; null where none does.
RULE = f"case when same and gap = 0 then '1' when same_title and gap = 0 then 'exact' when same and title_sim >= 0.15 then '2' when same and text_sim >= 0.2 then '2b' when text_sim >= 0.35 and gap <= 90 then '3' when not same and gap > 365 then null when title_sim < 0.3 then null when 0.4 * title_sim + 0.3 * (same)::int + 0.2 * text_sim + 0.1 * ({TEMPORAL.format(g='gap')}) >= 0.75 then 'score' end"
EDGES = f"(select pi, pj, i, j, rule from (select pi, pj, i, j, {RULE} as rule from {_FEATURES}) where rule is not null)"


def _hashed(rows: DataFrame) -> DataFrame:
    """Word sets as 64-bit hashes: an eighth of the bytes, and compared without text."""
    return rows.withColumns({c: F.transform(c, lambda w: F.xxhash64(w)) for c in ("tw", "sw")})


#: Rows of a block that meet in one task.
BLOCK_ROWS = 1024
# Word sets of n and m words at Jaccard 0.35 differ in at most this share of n + m.
_APART = 1 - 2 * 0.35 / 1.35


def _slim_nodes(spark: SparkSession, d: str, work: Workspace) -> DataFrame:
    """NODES, whose place is found over ids and days alone, before any text is read; views dedupe_nodes and dedupe_classes."""
    classes = work.save(run(spark, d, f"select c.id, c.rep, x.day from {CLASS} c join (select id, day from {KEYED}) x on x.id = c.id"), "classes")
    classes.createOrReplaceTempView("dedupe_classes")
    place = work.save(run(spark, d, "select id, row_number() over (order by day desc nulls last, id) as place from (select id, day from dedupe_classes where id = rep)"), "places")
    place.createOrReplaceTempView("dedupe_places")
    nodes = run(spark, d, f"select x.id, x.title, x.k, x.day, {word_set('title')} as tw, {word_set('summary')} as sw, p.place::bigint as place from {KEYED} x join dedupe_places p on p.id = x.id")
    nodes = work.save(nodes, "nodes")
    nodes.createOrReplaceTempView("dedupe_nodes")
    return nodes


def _without_frequent(rows: DataFrame, nodes: int, work: Workspace) -> DataFrame:
    """``rows`` (w, ...), one for each node and word, without words too frequent to make a block.

    Such words stand in more than one node of 200, so they are at most 200 times the mean
    words of a node; a word of one node alone stays, meets nobody and costs a row.
    """
    counts = rows.groupBy("w").agg(F.count("*").alias("c")).where(F.col("c") > max(3, int(nodes * 0.005)))
    often = work.save(counts.select("w"), "frequent")
    return rows.join(broadcast_if_small(often, often.count(), 40), "w", "left_anti")


def _key_pairs(nodes: DataFrame, work: Workspace, of: list[str], *columns: str) -> DataFrame:
    """``of`` the pairs of nodes of one organisation, the lower place as a, in parts of bounded size."""
    keyed = nodes.where("k <> ''").select("place", "k", *columns)
    # organisations above the bound are at most one for every BLOCK_ROWS nodes
    hot = keyed.groupBy("k").agg(F.ceil(F.count("*") / BLOCK_ROWS).cast("int").alias("parts")).where("parts > 1")
    hot = work.save(hot, "hot_keys")
    n = hot.count()
    cold = keyed.join(broadcast_if_small(hot.select("k"), n, 80), "k", "left_anti") if n else keyed
    found = [cold.alias("a").join(cold.alias("b"), "k")]
    if n:
        both = keyed.join(broadcast_if_small(hot, n, 90), "k")
        a = both.withColumn("part", F.pmod(F.xxhash64("place"), F.col("parts")).cast("int")).drop("parts")
        b = both.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")
        found.append(a.alias("a").join(b.alias("b"), ["k", "part"]))
    pairs = [x.where("a.place < b.place").selectExpr(*of) for x in found]
    return pairs[0].unionByName(pairs[1]) if n else pairs[0]


# Of an organisation; 0 where none is named.
_KEY_HASH = "case when k <> '' then xxhash64(k) else 0L end"


def _title_pairs(nodes: DataFrame) -> DataFrame:
    """Pairs of nodes of one title and day that are not of one organisation, the lower place as a."""
    titled = nodes.where("title is not null and day is not null").select("place", F.expr(_KEY_HASH).alias("kh"), F.expr("lower(trim(title))").alias("t"), "day")
    return titled.alias("a").join(titled.alias("b"), ["t", "day"]).where("a.place < b.place and (a.kh <> b.kh or a.kh = 0)")


def _tied(spark: SparkSession, d: str) -> DataFrame:
    """EDGES (pi, pj, rule), without a row for each pair of a block.

    Pairs of one organisation are judged where they meet.  Of the others a rule
    can tie only those whose keys contain each other, those of one title and
    day, and those of 0.35 shared words within 90 days: a sum of scores without one
    victim is 0.7 at most.  The last are sifted by parity fingerprints of 256 bits, which differ in no
    more bits than the sets in words; what is left meets the text of the rules.
    """
    work = Workspace(spark, "dedupe")
    nodes = _slim_nodes(spark, d, work)
    words = _hashed(nodes)
    one = _key_pairs(words, work, ["a.place as pi", "b.place as pj", "true as same", "lower(trim(a.title)) = lower(trim(b.title)) as same_title", "abs(datediff(DAY, a.day, b.day)) as gap", f"{to_spark(jaccard('a.tw', 'b.tw'))} as title_sim", f"{to_spark(jaccard('a.sw', 'b.sw'))} as text_sim"], "day", "tw", "sw", "title")
    one = one.selectExpr("pi", "pj", f"{to_spark(RULE)} as rule").where("rule is not null")
    # keys that contain another key of five letters or more: by the first five letters of the inner one
    keys = nodes.where("length(k) >= 5").select("k").distinct()
    grams = keys.select("k", F.explode(F.expr("array_distinct(transform(sequence(1, length(k) - 4), i -> substr(k, i, 5)))")).alias("g"))
    inner = keys.select(F.col("k").alias("inner"), F.expr("substr(k, 1, 5)").alias("g"))
    nested = grams.join(inner, "g").where("k <> inner and contains(k, inner)").select("k", "inner")
    nested = work.save(nested, "nested_keys")
    involved = nested.select("k").union(nested.select("inner")).distinct().withColumn("kc", F.col("k"))
    involved = work.save(involved, "involved_keys")
    rows = words.join(broadcast_if_small(involved, involved.count(), 160), "k", "left")
    fp = [f"aggregate(filter(sw, h -> pmod(h, 4) = {q}), 0L, (s, h) -> s ^ shiftleft(1L, cast(pmod(shiftright(h, 2), 64) as int))) as f{q}" for q in range(4)]
    marked = rows.select("place", "k", "kc", "day", "sw", F.size("sw").alias("n"), *(F.expr(x) for x in fp))
    w = marked.select("place", "kc", F.datediff("day", F.lit("2000-01-01")).alias("day"), "n", "f0", "f1", "f2", "f3", F.expr(_KEY_HASH).alias("kh"), F.explode("sw").alias("w"))
    w = _without_frequent(w, nodes.count(), work)
    apart = " + ".join(f"bit_count(a.f{q} ^ b.f{q})" for q in range(4))
    near = f"(abs(a.day - b.day) <= 90 and {apart} <= (a.n + b.n) * {_APART} + 0.001)"
    nest = "(contains(a.kc, b.kc) or contains(b.kc, a.kc))"
    far = w.alias("a").join(w.alias("b"), "w").where(f"a.place < b.place and (a.kh <> b.kh or a.kh = 0) and ({near} or coalesce({nest}, false))").selectExpr("a.place as pi", "b.place as pj")
    twins = _title_pairs(nodes).selectExpr("a.place as pi", "b.place as pj")
    sifted = work.save(far.unionByName(twins).distinct(), "sifted")
    sifted.createOrReplaceTempView("dedupe_sifted")
    words.createOrReplaceTempView("dedupe_words")
    judged = EDGES.replace(_FEATURES, _FEATURES.replace(_PAIRS, "dedupe_sifted").replace("a.id = p.i", "a.place = p.pi").replace("b.id = p.j", "b.place = p.pj").replace(NODES, "dedupe_words"))
    other = run(spark, d, f"select pi, pj, rule from {judged}")
    return one.unionByName(other)


@query("j15_fuzzy_pairs", f"select i, j, rule from {EDGES}")
def j15(spark, d):
    """Pairs of records that a rule ties, the earlier of the input order first."""
    tied = _tied(spark, d)
    names = spark.table("dedupe_nodes").select("place", "id")
    left, right = names.toDF("pi", "i"), names.toDF("pj", "j")
    return tied.join(left, "pi").join(right, "pj").select("i", "j", "rule")


@query(
    "d20_greedy_groups",
    f"""with recursive n as (select id, place from {NODES}), e as (select pi, pj from {EDGES}), g as (select pj, list(pi) as before from e group by pj), m as (select n.place, coalesce(g.before, []) as before from n left join g on g.pj = n.place),
    s(place, seeds) as (select 0, []::bigint[] union all select s.place + 1, case when len(list_intersect(m.before, s.seeds)) = 0 then list_append(s.seeds, s.place + 1) else s.seeds end from s join m on m.place = s.place + 1), f as (select seeds from s order by place desc limit 1),
    r as (select m.place, coalesce(list_min(list_intersect(m.before, f.seeds)), m.place) as seed from m, f), q as (select a.id as rep, b.id as seed from r join n a on a.place = r.place join n b on b.place = case when list_contains((select seeds from f), r.place) then r.place else r.seed end) select c.id as enriched_event_id, q.seed as group_id from {CLASS} c join q on q.rep = c.rep""",
)
def d20(spark, d):
    """Greedy groups in input order (latest first): a record joins the first earlier seed that a rule ties it to, else it is a seed itself.

    Not transitive: ties to members that are no seed count for nothing.
    """
    edges = _tied(spark, d)
    names = spark.table("dedupe_nodes").select("place", "id")
    stars = greedy_stars(names.select("place"), edges, Workspace(spark, "d20"), "place", "pi", "pj")
    seeds = stars.join(names.withColumnRenamed("id", "rep"), "place").join(names.select(F.col("place").alias("seed"), F.col("id").alias("group_id")), "seed")
    return spark.table("dedupe_classes").select("id", "rep").join(seeds, "rep").select(F.col("id").alias("enriched_event_id"), "group_id")


_EVIDENCE = "(select distinct decision_id, title_left as tl, title_right as tr, entity_left as l, entity_right as r, left_enriched_event_id as i, right_enriched_event_id as j, date_delta_days as gap from match_evidence where decision_id is not null)"
_PLAIN = "trim(regexp_replace(regexp_replace(lower({x}), '[^a-z0-9 ]+', ' ', 'g'), ' +', ' ', 'g'))"
_NEAR = "regexp_replace(replace(replace(replace({x}, ' - ', ' '), ' | ', ' '), '...', ''), ' +', ' ', 'g')"
sql_query(
    "d18_title_similarity",
    f"select decision_id, round(greatest(case when a = b then 1.0 when {_NEAR.format(x='lower(tl)')} = {_NEAR.format(x='lower(tr)')} then 0.95 else 0.0 end, case when contains(a, b) or contains(b, a) then 0.8 else 0.0 end, {jaccard(word_set('a'), word_set('b'))}), 6)::double as similarity from (select *, {_PLAIN.format(x='tl')} as a, {_PLAIN.format(x='tr')} as b from {_EVIDENCE} where tl is not null and tr is not null)",
    "Best of: equal, equal but for separators (0.95), one in the other (0.8), shared words. The sequence ratio stands in x17.",
)
# Words whose presence in both titles counts as naming one organisation.
SECTOR_WORDS = "university|council|hospital|health"
sql_query(
    "d19_same_entity",
    f"""select decision_id, coalesce(list_has_any(pl, pr), false) or coalesce(cl = cr and cl <> '', false) or coalesce(length(cl) >= 5 and length(cr) >= 5 and (contains(cl, cr) or contains(cr, cl)), false) or coalesce({' or '.join(f"(contains(lower(tl), '{w}') and contains(lower(tr), '{w}'))" for w in SECTOR_WORDS.split('|'))}, false) as same
    from (select e.decision_id, e.tl, e.tr, list_transform({parts("coalesce(e.l, '')")}, lambda x: {KEY.format('x')}) as pl, list_transform({parts("coalesce(e.r, '')")}, lambda x: {KEY.format('x')}) as pr, coalesce(al.canonical, {canonical('e.l')}) as cl, coalesce(ar.canonical, {canonical('e.r')}) as cr from {_EVIDENCE} e left join {ALIASES} al on al.raw_name = e.l left join {ALIASES} ar on ar.raw_name = e.r)""",
    "One victim: shared component, alias, canonical form, containment from five letters on, or a sector word in both titles.",
)
_V1 = f"(select e.*, a.summary as sl, b.summary as sr, a.kind as kl, b.kind as kr, a.records as nl, b.records as nr from {_EVIDENCE} e join {ONE} a on a.id = e.i join {ONE} b on b.id = e.j where e.tl is not null and e.tr is not null)"
_BARE = "array_to_string(list_filter({w}, lambda t: t not in ('group', 'company', 'corp', 'corporation', 'inc', 'incorporated', 'ltd', 'limited', 'llc', 'pty', 'bank', 'insurance', 'holding', 'holdings')), ' ')"
V1_ENTITY = f"(case when l is null or r is null then null when lower(trim(l)) = lower(trim(r)) then 1.0 when {acronym_of(words('l'), words('r'))} or {acronym_of(words('r'), words('l'))} then 0.98 when contains({_BARE.format(w=words('l'))}, {_BARE.format(w=words('r'))}) or contains({_BARE.format(w=words('r'))}, {_BARE.format(w=words('l'))}) then 0.95 else {jaccard('list_distinct(' + words('l') + ')', 'list_distinct(' + words('r') + ')')} end)"
sql_query("d26_v1_entity_similarity", f"select decision_id, round({V1_ENTITY}, 6)::double as similarity from {_EVIDENCE}", "First engine's name similarity: equal, initialism 0.98, one in the other without suffixes 0.95, else shared words. An empty remainder is in everything, as in the original rule.")
KEY_TERMS = "ransomware|breach|phishing|malware|customers|records|accounts|personal|archive|leak|stolen|encrypted|password|server|contractor|forum"
_V1_FLAGS = f"""(select v.*, {V1_ENTITY} as entity_sim, {jaccard(word_set('tl'), word_set('tr'))} as title_words, {jaccard(word_set('sl'), word_set('sr'))} as text_sim, {hits("coalesce(sl, '')", KEY_TERMS)} as ta, {hits("coalesce(sr, '')", KEY_TERMS)} as tb,
 {hits("coalesce(tl, '')", 'summary|report|weekly|statistics|roundup')} > 0 and {hits("coalesce(tr, '')", 'summary|report|weekly|statistics|roundup')} > 0 as both_generic, coalesce(nl > 0 and nr > 0 and greatest(nl, nr) > 10 * least(nl, nr), false) as other_scale, coalesce({hits("tl || ' ' || coalesce(sl, '')", 'update|further|now')} > 0 or {hits("tr || ' ' || coalesce(sr, '')", 'update|further|now')} > 0, false) as is_update from {_V1} v)"""
sql_query("d27_v1_rules", f"select decision_id, both_generic, other_scale, is_update, case when entity_sim >= 0.95 and nl = nr then 0.9 when entity_sim >= 0.95 and is_update then 0.8 else 0.0 end::double as indicator, least(ta, tb) as shared_terms from {_V1_FLAGS}", "Rules of the first engine: both summaries of a period, another scale, an update, strong indicators, key terms.")
DATE_FACTOR = "case when gap is null then 0.8 when gap = 0 then 1.0 when gap <= 1 then 0.98 when gap <= 7 then 0.9 when gap <= 30 then 0.8 when gap <= 90 then 0.7 when gap <= 180 then 0.6 else greatest(0.4, 1 - gap / 1000) end"
V1_MATCH = f"""case when tl <> tr and coalesce(entity_sim, 0) < 0.7 then false when both_generic then true when other_scale and not is_update then false when indicator >= 0.8 then (0.2 * title_words + 0.1 * greatest(text_sim, 0.3) + 0.5 * terms + 0.2 * indicator) * factor >= 0.6 else (0.3 * title_words + 0.2 * text_sim + 0.4 * terms + 0.1 * (case when kl = kr then 1.0 else 0.7 end)) * factor >= 0.7 end"""
_V1_SCORED = f"(select *, case when entity_sim >= 0.95 and nl = nr then 0.9 when entity_sim >= 0.95 and is_update then 0.8 else 0.0 end as indicator, case when greatest(ta, tb) = 0 then 0.0 else least(ta, tb)::double / greatest(ta, tb) end as terms, case when tl = tr then greatest(0.95, {DATE_FACTOR}) else {DATE_FACTOR} end as factor from {_V1_FLAGS})"
sql_query("d25_v1_matches", f"select decision_id, round(factor, 6)::double as date_factor, round(terms, 6) as terms, {V1_MATCH} as same from {_V1_SCORED}", "First engine's verdict: entity gate, weights, date factor; a lower bar where strong indicators hold. Titles are compared by shared words (the sequence ratio stands in x17).")
sql_query("z29_v1_gate", f"select decision_id, case when tl = tr then 'same title' when l is null or r is null then 'no entity' when {V1_ENTITY} >= 0.7 then 'pass' else 'different' end as gate from {_EVIDENCE} where tl is not null and tr is not null", "Gate before the first engine: equal titles pass, a missing entity does not.")
sql_query(
    "d28_v1_merged_records",
    f"""with m as (select m.deduplicated_event_id as g, o.* from {MEMBERS} m join {ONE} o on o.id = m.enriched_event_id), v as (select g, list_sort(list(records)) as r from m where records between 0 and 30000000 group by g)
    select m.g as deduplicated_event_id, max_by(m.summary, (length(coalesce(m.summary, '')), m.id)) as summary, coalesce(min(case when day(m.day) <> 1 then m.day end), min(m.day))::varchar as event_date, max(list_extract(v.r, (floor(len(v.r) / 2) + 1)::int)) as records_affected, round(0.5 + least(0.3, 0.1 * (count(*) - 1)), 4)::double as confidence from m left join v on v.g = m.g group by m.g""",
    "Merge of the first engine: longest text, earliest day that is no placeholder, upper median of plausible counts, 0.1 a further source up to 0.3.",
)
sql_query("d22_merged_fields", f"select m.deduplicated_event_id, max_by(o.summary, (length(coalesce(o.summary, '')), o.id)) as summary, max(case when o.records between 1 and 1000000000 then o.records end) as records_affected, min(o.day)::varchar as event_date, min_by(o.entity, (o.entity is null, o.day is null, o.day, o.id)) as organisation, count(*) as sources from {MEMBERS} m join {ONE} o on o.id = m.enriched_event_id group by 1", "Longest summary, largest plausible count, earliest day, first organisation in order of days.")
sql_query(
    "d24_record_checks",
    f"select check_name, n from (select 'no title' as check_name, count(*) filter (where title is null or trim(title) = '') as n from {ONE} union all select 'title too long', count(*) filter (where length(title) > 500) from {ONE} union all select 'date in future', count(*) filter (where day > date '2025-12-31') from {ONE} union all select 'negative records', count(*) filter (where records < 0) from {ONE} union all select 'merged into two incidents', (select count(*) from (select enriched_event_id from {MEMBERS} group by 1 having count(distinct deduplicated_event_id) > 1))::bigint from (select 1) o union all select 'member without record', (select count(*) from {MEMBERS} m where not exists (select 1 from extracted_event_details e where e.enriched_event_id = m.enriched_event_id))::bigint from (select 1) o)",
    "Validators of what goes into deduplication and what comes out of it.",
)
_TOKENS = f"(select distinct id, w from (select id, unnest(list_distinct(regexp_extract_all(lower(title), '[a-z0-9]+', 0))) as w from {ONE} where title is not null) where length(w) >= 4)"
_TOKEN_COUNTS = f"(select w, count(*) as n from {_TOKENS} group by w having count(*) between 2 and greatest(3, (select floor(count(*) * 0.03) from {ONE})))"
CAP = 12
BUCKETS = f"(select 't:' || t.w as bucket, t.id from {_TOKENS} t join {_TOKEN_COUNTS} c on c.w = t.w union select 'e:' || k, id from {KEYED} where k <> '')"
SIZED = f"(select bucket, count(*) as n, array_to_string(list_sort(list(id)), '|') as ids, list_sort(list(id)) as members from {BUCKETS} where bucket in (select bucket from {BUCKETS} group by bucket having count(*) between 2 and {2 * CAP}) group by bucket)"
sql_query(
    "d30_cluster_buckets",
    f"select min(bucket) as bucket, n, ids from {SIZED} s where not exists (select 1 from (select s2.bucket, s2.n, s2.members, m.id from {SIZED} s2 join {BUCKETS} m on m.bucket = s2.bucket) o where o.id = list_extract(s.members, 1) and o.n > s.n and len(list_intersect(o.members, s.members)) = s.n) group by n, ids",
    "Buckets by organisation or rare title word, at most twice the cap of twelve; a bucket inside a larger one is left out, as are equal ones.",
)
sql_query("o10_pruned_clusters", f"select bucket, n from (select min(bucket) as bucket, n from {SIZED} group by n, ids) order by n desc, bucket limit 50", "The fifty largest buckets.")
sql_query("d31_partition_coverage", f"select bucket, n, case when seen < n then 'missing' when given > seen then 'twice' else 'covered' end as coverage from (select s.bucket, s.n, count(p.place) as given, count(distinct p.place) as seen from {SIZED} s join (select bucket, row_number() over (partition by bucket order by id) as place from {BUCKETS}) p on p.bucket = s.bucket group by s.bucket, s.n)", "Does a partition give each place from 1 to n exactly once?")
sql_query("d32_chunks", f"select bucket, id, cast(floor((row_number() over (partition by bucket order by id) - 1) / {CAP}) as bigint) as chunk from {BUCKETS}", "Buckets above the cap in chunks, each record once; a chunk of one is its own group.")
_RUNS = f"(select k, id, day, gap, sum(case when gap is null or gap >= 90 then 1 else 0 end) over (partition by k order by day, id rows between unbounded preceding and current row) as run from (select k, id, day, date_diff('day', lag(day) over (partition by k order by day, id), day) as gap from {KEYED} where k <> '' and day is not null and id in (select rep from {CLASS})))"
sql_query(
    "d33_run_findings",
    f"select r.k, r.run::bigint as run, count(*) as records, max_by(r.id, (coalesce(s.n, 0), -date_diff('day', date '2000-01-01', r.day), r.id)) as target, coalesce(max(case when r.gap < 90 then r.gap end), 0) as widest_gap from {_RUNS} r left join (select rep, count(*) as n from {CLASS} group by rep) s on s.rep = r.id group by r.k, r.run having count(*) >= 2",
    "A finding for each run of one organisation: the target has most members, then is earliest.",
)
sql_query(
    "d34_consolidated",
    f"select k, day::varchar as day, min(id) as keep, count(*) as records from (select k, id, day, max(anchor) over (partition by k order by day, id rows between unbounded preceding and current row) as anchored from (select k, id, day, case when prev is null or date_diff('day', prev, day) > 3 then day end as anchor from (select k, id, day, lag(day) over (partition by k order by day, id) as prev from {KEYED} where k <> '' and day is not null))) group by k, anchored, day having count(*) > 1",
    "Records of one organisation on one day within a chain of days at most three apart (the earliest of a chain starts it).",
)


@query(
    "d35_transitive_merges",
    f"with recursive e as (select distinct a.deduplicated_event_id as s, b.deduplicated_event_id as t from {MEMBERS} a join {MEMBERS} b on a.enriched_event_id = b.enriched_event_id where a.deduplicated_event_id <> b.deduplicated_event_id), r(s, t) as (select s, t from e union select r.s, e.t from r join e on r.t = e.s) select s as incident, least(s, min(t)) as final from r group by s",
)
def d35(spark, d):
    """Incidents that share an article merge, and so on over any number of steps."""
    from caseflux.operators.components import connected_components

    least = f"select m.deduplicated_event_id as s, l.t from {MEMBERS} m join (select enriched_event_id, min(deduplicated_event_id) as t from {MEMBERS} group by 1) l on l.enriched_event_id = m.enriched_event_id where m.deduplicated_event_id <> l.t"
    return connected_components(run(spark, d, least), Workspace(spark, "d35"), "s", "t").select(F.col("node").alias("incident"), F.col("label").alias("final"))


_DIRECTED = "case when {a} is null or {b} is null then 'unknown' when contains(lower({a}), lower({b})) then 'same' else 'different' end"
sql_query("d36_order_stability", f"select decision_id, {_DIRECTED.format(a='l', b='r')} as forward, {_DIRECTED.format(a='r', b='l')} as backward, {_DIRECTED.format(a='l', b='r')} = {_DIRECTED.format(a='r', b='l')} as stable from {_EVIDENCE}", "A verdict counts only if both orders of presentation give it.")
_FIRST = "(select x.enriched_event_id as id, min(b.opened_at) as opened, min(case when b.state = 'accepted' then b.opened_at end) as accepted from decisions x join batches b on b.batch_id = x.batch_id where x.enriched_event_id is not null group by 1)"
_NEW = f"(select k.* from {KEYED} k join {_FIRST} f on f.id = k.id where f.accepted is null)"
_OLD = f"(select k.k, k.day, lower(trim(k.title)) as t, min(m.deduplicated_event_id) as g, min_by(k.title, k.id) as title, min_by(k.summary, k.id) as summary from {KEYED} k join {MEMBERS} m on m.enriched_event_id = k.id join {_FIRST} f on f.id = k.id where f.accepted is not null and k.k <> '' group by k.k, k.day, lower(trim(k.title)))"
#: Stored records of one organisation that a new article meets in one task.
PART_ROWS = 512


@query(
    "d41_incremental_matches",
    f"""with p as (select n.id, o.g, case when n.day = o.day then '1' when lower(trim(n.title)) = o.t and n.day = o.day then 'exact' when {jaccard(word_set('n.title'), word_set('o.title'))} >= 0.15 then '2a' when {jaccard(word_set('n.summary'), word_set('o.summary'))} >= 0.2 then '2b' end as rule from {_NEW} n join {_OLD} o on o.k = n.k)
    select id as enriched_event_id, min(g) as deduplicated_event_id, min_by(rule, (g, rule)) as rule from p where rule is not null group by id""",
)
def d41(spark, d):
    """New articles against stored incidents: the first incident that a rule ties, by organisation, day, title or text.

    Words are parted and hashed once a record, not once a pair; the stored
    records of an organisation are cut into parts, each met by all its new articles.
    """
    work = Workspace(spark, "d41")
    sides = f"{word_set('title')} as tw, {word_set('summary')} as sw"
    new = work.save(_hashed(run(spark, d, f"select id, k, day, lower(trim(title)) as t, {sides} from {_NEW} where k <> ''")), "new")
    old = run(spark, d, f"select k, day, t, g, {sides} from {_OLD}").join(new.select("k").distinct(), "k", "left_semi")
    old = work.save(_hashed(old), "old")
    parts = old.groupBy("k").agg(F.ceil(F.count("*") / PART_ROWS).cast("int").alias("parts"))
    a = new.join(parts, "k").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")
    b = old.join(parts, "k").withColumn("part", F.pmod(F.xxhash64("g", "day", "t"), F.col("parts")).cast("int")).drop("parts")
    rule = f"case when n.day = o.day then '1' when {jaccard('n.tw', 'o.tw')} >= 0.15 then '2a' when {jaccard('n.sw', 'o.sw')} >= 0.2 then '2b' end"
    pairs = a.alias("n").join(b.alias("o"), ["k", "part"]).select("id", "g", F.expr(to_spark(rule)).alias("rule")).where("rule is not null")
    return pairs.groupBy("id").agg(F.min(F.struct("g", "rule")).alias("s")).select(F.col("id").alias("enriched_event_id"), F.col("s.g").alias("deduplicated_event_id"), "s.rule")


sql_query("j16_first_existing_match", f"select n.id as enriched_event_id, min(o.g) as deduplicated_event_id from {_NEW} n join {_OLD} o on o.k = n.k and o.day = n.day group by n.id", "First stored incident of the same organisation and day.")
sql_query("d42_duplicate_probe", f"select id, place, other from (select a.id, b.id as other, row_number() over (partition by a.id order by b.id) as place from {KEYED} a join {ONE} b on b.day = a.day and a.id <> b.id where length(trim(a.entity)) >= 4 and contains(lower(b.title), lower(trim(a.entity)))) where place <= 5", "Records of the same day whose title names the organisation; five at most are shown, as the probe asks.")
# J13: industries by the first keyword that stands in a name
_GROUPS = "(values (1, 'hospital|health|medical|pharmacy', 'Health'), (2, 'school|university|college', 'Education'), (3, 'council|department|authority|government', 'Government'), (4, 'bank|insurance|superannuation', 'Finance'), (5, 'gas|energy|water|power', 'Utilities'), (6, 'software|telecom|analytics', 'Technology')) g(display_order, words, category)"
sql_query("j13_keyword_categories", f"select coalesce(c.category, 'Others') as category, count(*) as n from (select e.entity_id, min_by(g.category, g.display_order) as category from entities e left join {_GROUPS} on regexp_matches(lower(e.entity_name), g.words) group by e.entity_id) c group by 1", "Category of a name by the first keyword list it meets; the lists are fixed and few.")


@query("j14_candidate_pairs", f"select distinct least(i, j) as left_id, greatest(i, j) as right_id from {_PAIRS}")
def j14(spark, d):
    """Candidate pairs of the blocks, each once; records of one organisation and day count as one.

    A pair is given by its first common block alone (organisation, title and day, then the words in order of their
    hashes), so the pairs are never moved to find those that several blocks give.
    """
    work = Workspace(spark, "j14")
    nodes = _slim_nodes(spark, d, work).withColumn("place", F.col("id"))
    told = F.expr("case when title is not null and day is not null then xxhash64(lower(trim(title)), day) end").alias("th")
    rows = nodes.select("place", F.expr(_KEY_HASH).alias("kh"), told, F.explode("sw").alias("w")).withColumn("w", F.xxhash64("w"))
    rows = _without_frequent(rows, nodes.count(), work)
    lists = rows.groupBy("place").agg(F.first("kh").alias("kh"), F.first("th").alias("th"), F.array_sort(F.collect_set("w")).alias("ws"))
    rows = lists.select("place", "kh", "th", "ws", F.posexplode("ws").alias("at", "w")).withColumn("before", F.expr("slice(ws, 1, at)"))
    # one bit a word: most pairs show by it that they share none of the words before
    rows = rows.select("w", "place", "kh", "th", "before", F.expr("aggregate(before, 0L, (s, h) -> s | shiftleft(1L, cast(pmod(h, 64) as int)))").alias("bits"))
    fresh = "(a.kh <> b.kh or a.kh = 0) and coalesce(a.th <> b.th, true) and (a.bits & b.bits = 0 or not arrays_overlap(a.before, b.before))"
    by_word = rows.alias("a").join(rows.alias("b"), "w").where(f"a.place < b.place and {fresh}")
    ids = ["a.place as left_id", "b.place as right_id"]
    return _key_pairs(nodes, work, ids).unionByName(_title_pairs(nodes).selectExpr(*ids)).unionByName(by_word.selectExpr(*ids))


sql_query(
    "j18_blocked_merges",
    f"select distinct a.deduplicated_event_id as target, b.deduplicated_event_id as source from (select distinct least(e.left_enriched_event_id, e.right_enriched_event_id) as i, greatest(e.left_enriched_event_id, e.right_enriched_event_id) as j from match_evidence e join decisions x on x.decision_id = e.decision_id where x.action in ('keep_separate', 'revert') and x.decided_by = 'human') o join {MEMBERS} a on a.enriched_event_id = o.i join {MEMBERS} b on b.enriched_event_id = o.j where a.deduplicated_event_id <> b.deduplicated_event_id",
    "Incidents that a human kept apart, by any pair of their members.",
)
sql_query("j19_restored_by_stable_id", f"select n.deduplicated_event_id as new_id, min(o.deduplicated_event_id) as old_id, min(o.severity_category) as severity_category from (select deduplicated_event_id, min(enriched_event_id) as master from {MEMBERS} group by 1) n join (select r.deduplicated_event_id, r.severity_category, m.master from {RISKED} r join (select deduplicated_event_id, min(enriched_event_id) as master from {MEMBERS} group by 1) m on m.deduplicated_event_id = r.deduplicated_event_id) o on o.master = n.master group by 1", "Stored classes brought back by the master article; the worst of several stays.")
sql_query("j20_sibling_industry", "select name, max_by(industry, (n, industry)) as industry, sum(n)::bigint as votes from (select a.victim_organization_name as name, b.victim_organization_industry as industry, count(*) as n from (select distinct victim_organization_name, list_extract(string_split(lower(trim(victim_organization_name)), ' '), 1) as stem from asd_risk_classifications_20251118_154100 where length(trim(victim_organization_name)) >= 5) a join (select distinct deduplicated_event_id, victim_organization_name, victim_organization_industry, list_extract(string_split(lower(trim(victim_organization_name)), ' '), 1) as stem from asd_risk_classifications_20251118_154100 where victim_organization_industry is not null) b on b.stem = a.stem and contains(lower(b.victim_organization_name), lower(a.stem)) group by 1, 2) group by name", "Industry by vote of the names that hold the same stem.")
# write path, adjudication runs, reviews
sql_query("d23_stored_incidents", f"select deduplicated_event_id, min(enriched_event_id) as master, count(*) as members, min(first_seen) as first_seen from (select m.deduplicated_event_id, m.enriched_event_id, min(e.discovered_at::date)::varchar as first_seen from {MEMBERS} m join extracted_event_details e on e.enriched_event_id = m.enriched_event_id group by 1, 2) group by 1", "What a stored incident consists of.")
sql_query("z45_cluster_rows", f"select substr(sha256(deduplicated_event_id), 1, 16) as cluster_id, deduplicated_event_id, n as cluster_size, round(sim, 6)::double as average_similarity from (select m.deduplicated_event_id, count(*) as n, avg(x.certainty) as sim from {MEMBERS} m left join (select enriched_event_id, deduplicated_event_id, max(certainty) as certainty from decisions where action = 'merge' group by 1, 2) x on x.enriched_event_id = m.enriched_event_id and x.deduplicated_event_id = m.deduplicated_event_id group by 1) where n >= 2", "Cluster rows of the write path.")
sql_query("z46_master_lineage", f"select m.deduplicated_event_id, m.enriched_event_id, case when m.enriched_event_id = f.master then 'primary' else 'supporting' end as contribution from {MEMBERS} m join (select deduplicated_event_id, min(enriched_event_id) as master from {MEMBERS} group by 1) f on f.deduplicated_event_id = m.deduplicated_event_id", "Map rows with the master's part.")
sql_query("z48_merged_into_existing", f"select m.deduplicated_event_id, least(min(r.event_date), min(o.day))::varchar as event_date, count(distinct m.enriched_event_id) as mapped from {MEMBERS} m join {ONE} o on o.id = m.enriched_event_id left join {RISKED} r on r.deduplicated_event_id = m.deduplicated_event_id group by 1", "The earlier date wins when an article joins a stored incident.")
sql_query("z49_run_mode", f"select case when stored = 0 then 'full' when fresh = 0 then 'skip' when fresh > stored then 'full' else 'incremental' end as mode, stored, fresh from (select (select count(distinct deduplicated_event_id) from {MEMBERS}) as stored, (select count(*) from {_NEW}) as fresh)", "Full, incremental or no run, by what is new.")
sql_query("z27_run_statistics", f"select records, groups, merged, round(merged::double / greatest(records, 1), 6) as merge_rate from (select count(*) as records, count(distinct rep) as groups, count(*) - count(distinct rep) as merged from {CLASS})", "Statistics of a run by the first rule.")
sql_query("z28_entity_overlap", f"select decision_id, round({jaccard('a', 'b')}, 6) as similarity, concat_ws('; ', case when gap is null then 'no dates' when gap = 0 then 'same day' when gap <= 30 then 'near in time' else 'far apart' end, case when len(list_intersect(a, b)) > 0 then 'shared entities' end) as reasoning from (select decision_id, gap, list_distinct({words('l')}) as a, list_distinct({words('r')}) as b from {_EVIDENCE} where l is not null and r is not null)", "Entity overlap with a line of reasoning.")
_VERDICT = "case when len(coalesce(shared_urls, list_value()::varchar[])) > 0 then 0.99 when not coalesce(entity_match, false) then 0.1 when embedding_similarity >= 0.93 and coalesce(date_delta_days, 0) <= 45 then least(0.95, embedding_similarity) when coalesce(title_similarity, 0) >= 0.75 and coalesce(nullif(date_delta_days, 0), 999) <= 7 then 0.8 else 0.4 end"
sql_query("z67_missed_merges", f"select left_id, right_id, round(max(c), 6)::double as certainty from (select least(left_enriched_event_id, right_enriched_event_id) as left_id, greatest(left_enriched_event_id, right_enriched_event_id) as right_id, {_VERDICT} as c from match_evidence where left_enriched_event_id is not null and right_enriched_event_id is not null) p where c >= 0.8 and not exists (select 1 from {MEMBERS} a join {MEMBERS} b on a.deduplicated_event_id = b.deduplicated_event_id where a.enriched_event_id = p.left_id and b.enriched_event_id = p.right_id) group by 1, 2", "Pairs judged the same that no incident holds together.")
sql_query("z68_legacy_review", f"select m.deduplicated_event_id, count(*) as members, count(*) filter (where {jaccard(word_set('a.title'), word_set('b.title'))} < 0.1 and a.k <> b.k) as doubtful from {MEMBERS} m join (select deduplicated_event_id, min(enriched_event_id) as master from {MEMBERS} group by 1) f on f.deduplicated_event_id = m.deduplicated_event_id join {KEYED} a on a.id = m.enriched_event_id join {KEYED} b on b.id = f.master where m.enriched_event_id <> f.master group by 1", "Members held against their master.")
sql_query("z70_adjudicated_clusters", f"select s.bucket, s.n, count(distinct k.k) as organisations, case when count(distinct k.k) = 1 then 'one' when count(distinct k.k) = s.n then 'all apart' else 'mixed' end as verdict from {SIZED} s join {BUCKETS} b on b.bucket = s.bucket join {KEYED} k on k.id = b.id group by s.bucket, s.n", "Buckets judged by organisation: the stand-in of a model.")
sql_query("z71_recurrence_run", f"select r.k, r.run::bigint as run, count(*) as records, count(*) >= 2 and max(coalesce(v.n, 0)) = 0 as merge from {_RUNS} r left join (select enriched_event_id as id, count(*) as n from decisions where action = 'keep_separate' and decided_by = 'human' group by 1) v on v.id = r.id group by r.k, r.run having count(*) >= 2", "Runs that would be merged, unless a human kept a record apart.")
sql_query("z72_retitled", f"select m.deduplicated_event_id, max_by(o.title, (least(3, len(list_distinct(regexp_extract_all(lower(o.title), 'breach|attack|ransom|leak|exposed', 0)))), -length(o.title), o.title)) as title from {MEMBERS} m join {ONE} o on o.id = m.enriched_event_id where o.title is not null group by 1", "New titles of all incidents.")
sql_query("z54_merged_cluster", f"select k, max_by(id, (entity is not null, -date_diff('day', date '2000-01-01', coalesce(day, date '2099-01-01')), length(title), id)) as keep, count(*) - 1 as merged from {KEYED} where k <> '' group by k having count(*) >= 2", "Of a cluster named by hand the record with a name, the earliest day and the longest title stays.")
sql_query("z26_validation_runs", f"select id, len(list_filter(list_value(case when title is null then 'title' end, case when day > date '2025-12-31' then 'future' end, case when records < 0 then 'count' end), lambda e: e is not null)) as errors, len(list_filter(list_value(case when entity is null then 'victim' end, case when summary is null or length(summary) < 50 then 'text' end, case when dup.n > 1 then 'duplicate' end), lambda e: e is not null)) as warnings from {KEYED} x left join (select k as dk, day as dday, count(*) as n from {KEYED} where k <> '' and day is not null group by 1, 2) dup on dup.dk = x.k and dup.dday = x.day", "Six checks of a record, the duplicate probe among them.")
sql_query("w04_run_spans", f"select k, run::bigint as run, date_diff('day', min(day), max(day)) as span_days, coalesce(max(case when gap < 90 then gap end), 0) as widest_gap from {_RUNS} group by k, run having count(*) >= 2", "Span and widest gap of each run.")
