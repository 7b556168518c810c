"""Problem 6: variant spellings of names, linked to the listed entity they mean.

Names become weighted character n-gram vectors; a sparse top-n cosine join
against the listed entities gives candidates.  All candidates of an entity,
good and bad, are clustered by average linkage together with its proper name
and the distinctive part of that; only those that cluster with either stay.  Of these a name is linked
to the entity whose parts agree best (distinctive part within a typing slip,
other parts compatible), if there is one.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseflux.session import Workspace

TOP_N = 6
MIN_COSINE = 0.2
#: Average similarity below which two clusters of an entity's candidates stay apart.
LINKAGE = 0.25
#: Candidates of one entity that are clustered at a time, with its proper name; larger groups are cut by hash.
GROUP_ROWS = 1000
#: Listed entities are joined in blocks of this many; only a block is broadcast.
BLOCK = 20_000
#: A word found in this share of the listed names, and in so many at least, is ordinary and not distinctive.
ORDINARY_SHARE, ORDINARY = 0.002, 6

# Legal forms, titles, fillers, short forms and nicknames.
LEGAL = {"pty", "ltd", "limited", "inc", "incorporated", "pl", "llc", "plc", "corp", "corporation", "co", "holdings", "holding", "group", "gmbh", "nl", "the"}
TITLES = {"mr", "mrs", "ms", "miss", "dr", "prof", "professor", "sir", "dame", "hon", "rev", "jr", "sr"}
FILLERS = {"", "na", "none", "null", "unknown", "not stated", "not available", "tbc", "tba", "untitled", "undisclosed", "various", "multiple", "unnamed", "anonymous", "confidential", "not disclosed", "n a"}
SHORT = {
    "mgt": "management", "mgmt": "management", "serv": "services", "svcs": "services", "svc": "services", "srv": "services", "grp": "group", "assn": "association", "assoc": "association",
    "dept": "department", "dep": "department", "fdn": "foundation", "found": "foundation", "cmty": "community", "comm": "commission", "reg": "regional", "hosp": "hospital", "intl": "international",
    "int": "international", "univ": "university", "uni": "university", "inst": "institute", "govt": "government", "natl": "national", "mfg": "manufacturing", "ctr": "centre", "center": "centre",
    "cntr": "centre", "med": "medical", "tech": "technology", "coll": "college", "sch": "school", "eng": "engineering", "engg": "engineering", "ind": "industries", "inds": "industries", "auth": "authority",
    "cncl": "council", "ins": "insurance", "fin": "financial", "telecoms": "telecom", "comms": "communications", "log": "logistics", "co": "company",
    "cty": "city", "edu": "education", "educ": "education", "supt": "support", "org": "organisation", "soc": "society", "bros": "brothers", "st": "saint",
    "archs": "architects", "wlth": "wealth", "prop": "property", "pharm": "pharmacy", "sys": "systems", "syst": "systems", "gov": "government", "acad": "academy", "admin": "administration",
}
NICKNAMES = {
    "liz": "elizabeth", "beth": "elizabeth", "lizzie": "elizabeth", "betty": "elizabeth", "kate": "katherine", "kathy": "katherine", "katie": "katherine", "cathy": "katherine", "chris": "christopher", "kit": "christopher",
    "rob": "robert", "bob": "robert", "bobby": "robert", "rick": "richard", "rich": "richard", "dick": "richard", "bill": "william", "will": "william", "billy": "william", "liam": "william", "tony": "anthony",
    "ed": "edward", "ted": "edward", "eddie": "edward", "ned": "edward", "maggie": "margaret", "meg": "margaret", "peggy": "margaret", "alex": "alexandra", "sandra": "alexandra", "lexi": "alexandra", "sue": "susannah",
    "susie": "susannah", "susan": "susannah", "anna": "susannah", "fran": "francis", "frank": "francis", "dot": "dorothy", "dottie": "dorothy", "dolly": "dorothy", "penny": "penelope", "jim": "james", "mike": "michael",
    "dave": "david", "dan": "daniel", "nick": "nicholas", "tom": "thomas", "joe": "joseph", "sam": "samuel", "steve": "stephen", "matt": "matthew", "ben": "benjamin", "jo": "joanna", "wi": "wiremu",
    "sasha": "alexandra", "theo": "theodore", "teddy": "theodore", "jamie": "james", "jimmy": "james", "joan": "joanna", "jack": "john", "harry": "henry", "charlie": "charles", "betsy": "elizabeth", "eliza": "elizabeth", "kath": "katherine", "kitty": "katherine", "topher": "christopher", "marg": "margaret", "peg": "margaret", "suzie": "susannah", "nell": "penelope", "mick": "michael", "mikey": "michael", "misha": "michael", "drew": "andrew", "andy": "andrew", "pete": "peter", "greg": "gregory", "jen": "jennifer", "jenny": "jennifer", "vicky": "victoria", "becky": "rebecca", "pat": "patricia", "ron": "ronald", "don": "donald", "ken": "kenneth", "jeff": "jeffrey", "larry": "lawrence", "gabe": "gabriel", "franky": "francis", "ward": "edward",
}
#: Nicknames of a second name.
ALSO = {"ted": "theodore", "teddy": "edward", "alex": "alexander", "sandy": "alexandra", "chris": "christine", "sam": "samantha", "jo": "joanne", "pat": "patrick", "fran": "frances", "kit": "katherine"}
_JOINERS = {"and", "of", "for"}


def plain(name: str) -> str:
    """Lower case without accents; unlettered signs inside a word close up."""
    s = unicodedata.normalize("NFKD", name.replace("ø", "o").replace("Ø", "O").replace("ł", "l").replace("Ł", "L").replace("đ", "d").replace("ß", "ss"))
    s = "".join(c for c in s if not unicodedata.combining(c)).lower().replace("&", " and ").replace("+", " and ")
    s = re.sub(r"\bp\s*/\s*l\b", " pl ", s)
    s = re.sub(r"(?<=\w)['’.](?=\w)", "", s).replace("_", " ")
    return re.sub(r"\s+", " ", re.sub(r"[^\w\s,-]", " ", s)).strip()


def words(name: str) -> list[str]:
    """Words of a name in the order a list would have, short forms written out."""
    s = plain(name)
    if "," in s:
        first, _, rest = s.partition(",")
        rest = rest.replace(",", " ").strip()
        if rest and not set(rest.split()) <= LEGAL:
            s = f"{rest} {first}"
    s = s.replace(",", " ")
    s = re.sub(r"^the-", "", s)
    out = [SHORT.get(w, w) for w in s.replace(" - ", " ").split()]
    while out and out[0] in TITLES:
        out.pop(0)
    return [w for w in out if w not in ("-",)]


def is_filler(name: str | None) -> bool:
    return name is None or re.sub(r"[^a-z]+", " ", name.lower()).strip() in FILLERS


def letters(ws: list[str]) -> str:
    kept = [w for w in ws if w not in LEGAL] or ws
    return "".join(w.replace("-", "") for w in kept)


def grams(text: str) -> list[str]:
    t = f"^{text}$"
    return [t[i : i + 3] for i in range(len(t) - 2)] + [t[i : i + 2] for i in range(len(t) - 1)]


def slips(a: str, b: str, most: int) -> int:
    """Typing slips (insert, drop, change, swap of neighbours); most + 1 if more."""
    if a == b:
        return 0
    if abs(len(a) - len(b)) > most or len(set(a) ^ set(b)) > 2 * most:
        return most + 1
    two, one = [], list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            c = min(one[j] + 1, row[-1] + 1, one[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                c = min(c, two[j - 2] + 1)
            row.append(c)
        if min(row) > most:
            return most + 1
        two, one = one, row
    return one[-1]


def allowed(length: int) -> int:
    return 0 if length < 4 else 1 if length < 8 else 2


class EntityBlock:
    """Inverted n-gram index of a block of listed names, and their parts."""

    def __init__(self, ids: list[int], names: list[str], ordinary: set[str], person: list[bool], idf: dict[str, float] | None = None):
        self.ids, self.names, self.ordinary = ids, set(names), ordinary
        self.words = [words(n) for n in names]
        self.person = person
        self.parts = [self.split(w) for w in self.words]
        self.texts = [letters(w) for w in self.words]
        bags = [grams(t) for t in self.texts]
        df: dict[str, int] = {}
        for bag in bags:
            for g in set(bag):
                df[g] = df.get(g, 0) + 1
        self.n = len(names)
        # the weights of all blocks, where they are given, so that cosines do not depend on the cut
        self.idf = idf or {g: float(np.log(1 + self.n / d)) for g, d in df.items()}
        self.rare = max([*self.idf.values(), float(np.log(1 + self.n))])
        posting: dict[str, tuple[list[int], list[float]]] = {}
        for k, bag in enumerate(bags):
            v = self.vector(bag)
            for g, x in v.items():
                p = posting.setdefault(g, ([], []))
                p[0].append(k), p[1].append(x)
        self.post = {g: (np.array(a, np.int32), np.array(x, np.float32)) for g, (a, x) in posting.items()}
        by_head: dict[str, int] = {}
        for h, _ in self.parts:
            by_head[h] = by_head.get(h, 0) + 1
        self.by_head = by_head
        self.by_words: dict[str, int] = {}
        for k, t in enumerate(self.texts):
            self.by_words[t] = -1 if t in self.by_words else k

    def split(self, ws: list[str]) -> tuple[str, list[str]]:
        """(distinctive letters, ordinary words) of a name."""
        kept = [w for w in ws if w not in LEGAL and w not in _JOINERS]
        return distinctive(ws, self.ordinary), [w for w in kept if w in self.ordinary]

    def vector(self, bag: list[str]) -> dict[str, float]:
        v: dict[str, float] = {}
        for g in bag:
            v[g] = v.get(g, 0.0) + self.idf.get(g, self.rare)
        norm = float(np.sqrt(sum(x * x for x in v.values()))) or 1.0
        return {g: x / norm for g, x in v.items()}

    def nearest(self, text: str, n: int = TOP_N, least: float = MIN_COSINE) -> list[tuple[int, float]]:
        score = np.zeros(self.n, np.float32)
        for g, x in self.vector(grams(text)).items():
            p = self.post.get(g)
            if p is not None:
                score[p[0]] += np.float32(x) * p[1]
        k = min(n, self.n)
        top = np.argpartition(-score, k - 1)[:k]
        return sorted(((int(i), float(score[i])) for i in top if score[i] >= least), key=lambda p: -p[1])

    def agrees(self, ws: list[str], k: int) -> float:
        """How well the parts of a name fit entity k; 0 where they do not."""
        mine = [w for w in ws if w not in LEGAL]
        if not mine:
            return 0.0
        if self.person[k]:
            return self._person(mine, [w for w in self.words[k] if w not in LEGAL])
        text, whole = letters(ws), self.texts[k]
        s = slips(text, whole, allowed(len(self.parts[k][0])))
        if s <= allowed(len(self.parts[k][0])):
            # the slips may not turn one distinctive part into another listed one
            return 3.0 - 0.5 * s
        head, tail = self.parts[k]
        m_head, m_tail = self.split(ws)
        if not head:
            return 0.0
        most = allowed(len(head))
        best, rest = most + 1, m_tail
        joined = [w.replace("-", "") for w in mine if w not in _JOINERS]
        # the distinctive part may be torn apart or stuck to the next word
        for i in range(len(joined)):
            for j in range(i + 1, min(len(joined), i + 2) + 1):
                part = "".join(joined[i:j])
                d = slips(part, head, most)
                if d < best:
                    best, rest = d, joined[:i] + joined[j:]
        if best > most:
            return 0.0
        if not rest:  # the distinctive part alone
            return 1.5 - 0.5 * best if self.by_head.get(head, 0) == 1 else 0.0
        mates = [w for w in self.words[k] if w not in LEGAL and w not in _JOINERS and w not in (head,)]
        for w in rest:
            if w in _JOINERS or w in LEGAL:
                continue
            near = any(w == m or (len(w) >= 3 and m.startswith(w)) or slips(w, m, allowed(len(m))) <= allowed(len(m)) for m in mates)
            if not near:
                return 0.0
        return 2.0 - 0.5 * best

    @staticmethod
    def _person(mine: list[str], theirs: list[str]) -> float:
        if len(theirs) < 2:
            return 3.0 if mine == theirs else 0.0
        first, last = theirs[0], theirs[-1]
        text = "".join(mine).replace("-", "")
        s = slips(text, "".join(theirs), 1)
        if s <= 1:
            return 3.0 - 0.5 * s
        best = 0.0
        mine = [w.replace("-", "") for w in mine]
        options = [(mine[0], "".join(mine[1:])), (mine[-1], "".join(mine[:-1]))] if len(mine) > 1 else []
        for f, l in options:
            most = allowed(len(last))
            d = slips(l, last, most)
            if d > most:
                continue
            if first in (f, NICKNAMES.get(f), ALSO.get(f)) or f == first[: len(f)] and len(f) <= 4 or slips(f, first, 1) <= 1 and len(first) > 3:
                best = max(best, 2.0 - 0.5 * d)
        return best

    def candidates(self, name: str) -> list[tuple[int, float, float]]:
        """(index, cosine, agreement) of the entities whose vectors are nearest to a name's."""
        if is_filler(name):
            return []
        ws = words(name)
        text = letters(ws)
        if not text:
            return []
        exact = self.by_words.get(text, -1)
        if exact >= 0:  # the same letters: cosine 1 with this entity alone
            return [(exact, 1.0, 4.0)]
        out = [(k, c, self.agrees(ws, k)) for k, c in self.nearest(text)]
        head = self.split(ws)[0]
        if head and head != text and not any(a > 0 for _, _, a in out):
            # candidates by the distinctive part alone, which long ordinary parts drown
            seen = {k for k, _, _ in out}
            out += [(k, c, a) for k, c in self.nearest(head) if k not in seen and (a := self.agrees(ws, k)) > 0]
        return out

    def link(self, name: str) -> tuple[int, float] | None:
        """(index, cosine) of the entity a name means by its parts; none if unlisted or in doubt."""
        scored = sorted(((a, c, -k) for k, c, a in self.candidates(name) if a > 0), reverse=True)
        if not scored or (len(scored) > 1 and scored[0][0] == scored[1][0] and abs(scored[0][1] - scored[1][1]) < 1e-6):
            return None
        return -scored[0][2], scored[0][1]


def average_linkage(vectors: np.ndarray, least: float = LINKAGE) -> np.ndarray:
    """Cluster number of each row by average linkage, cut at the similarity ``least``.

    Rows are unit vectors.  Chains of nearest neighbours find the pairs that
    merge; as an average never exceeds its parts, a cluster whose nearest
    neighbour is below ``least`` is final.
    """
    n = len(vectors)
    s = vectors @ vectors.T
    np.fill_diagonal(s, -1)
    size, open_, parent = np.ones(n), np.ones(n, bool), np.arange(n)
    chain: list[int] = []
    while open_.any():
        chain = chain or [int(open_.argmax())]
        a = chain[-1]
        b = int(s[a].argmax())
        if s[a, b] < least:
            open_[a] = False
            s[a], s[:, a] = -1, -1
            chain.pop()
        elif len(chain) > 1 and s[a, chain[-2]] >= s[a, b]:
            b = chain[-2]
            both = (size[a] * s[a] + size[b] * s[b]) / (size[a] + size[b])
            s[b], s[:, b] = both, both
            s[b, b] = -1
            s[a], s[:, a] = -1, -1
            size[b] += size[a]
            open_[a], parent[a] = False, b
            chain = chain[:-2]
        else:
            chain.append(b)
    while (parent[parent] != parent).any():
        parent = parent[parent]
    return parent


def distinctive(ws: list[str], ordinary: set[str]) -> str:
    """Letters of a name's words that are neither ordinary nor legal forms."""
    return "".join(w.replace("-", "") for w in ws if w not in LEGAL and w not in _JOINERS and w not in ordinary)


def _group(idf: dict[str, float], ordinary: set[str], least: float):
    rare = max([*idf.values(), 1.0])

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        """The candidates of one entity (and part) in the cluster of its proper name, or of its distinctive part."""
        proper = words(rows["entity_name"].iloc[0])
        bags = [grams(t) for t in (letters(proper), distinctive(proper, ordinary), *(letters(words(n)) for n in rows["name"]))]
        known = {g: k for k, g in enumerate(sorted({g for b in bags for g in b}))}
        m = np.zeros((len(bags), len(known)), np.float32)
        for r, b in enumerate(bags):
            for g in b:
                m[r, known[g]] += idf.get(g, rare)
        m /= np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-9)
        of = average_linkage(m, least)
        return rows[(of[2:] == of[0]) | (of[2:] == of[1])][["name", "entity_id", "cosine", "agrees"]]

    return run


def cluster_variants(candidates: DataFrame, entities: DataFrame, idf: dict[str, float], ordinary: set[str], rows: int = GROUP_ROWS, least: float = LINKAGE) -> DataFrame:
    """The (name, entity_id, cosine, agrees) that cluster with the entity's proper name or its distinctive part.

    Names whose letters are the entity's own are in it by definition.  Groups
    are cut into parts of about ``rows`` candidates by hash; every part has the
    entity's proper name.
    """
    same = candidates.where("cosine >= 0.999999")
    rest = candidates.where("cosine < 0.999999")
    sizes = rest.groupBy("entity_id").agg(F.ceil(F.count("*") / rows).cast("int").alias("parts"))
    proper = entities.select(F.col("entity_id").cast("long").alias("entity_id"), "entity_name")
    placed = rest.join(sizes, "entity_id").join(proper, "entity_id").withColumn("part", F.pmod(F.xxhash64("name"), F.col("parts")))
    # minutes of clustering in few bytes: a partition count of its own keeps groups from being coalesced
    placed = placed.repartition(4 * rest.sparkSession.sparkContext.defaultParallelism, "entity_id", "part")
    kept = placed.groupBy("entity_id", "part").applyInPandas(_group(idf, ordinary, least), "name string, entity_id long, cosine double, agrees double")
    return same.unionByName(kept)


def best_links(accepted: DataFrame) -> DataFrame:
    """(name, entity_id, cosine): the accepted entity that agrees best, then the nearest; none where two are equal."""
    order = F.struct((-F.col("agrees")).alias("a"), (-F.col("cosine")).alias("c"), "entity_id")
    two = accepted.where("agrees > 0").groupBy("name").agg(F.slice(F.array_sort(F.collect_set(order)), 1, 2).alias("t"))
    doubt = (F.size("t") > 1) & (F.col("t")[0]["a"] == F.try_element_at("t", F.lit(2))["a"]) & (F.abs(F.col("t")[0]["c"] - F.try_element_at("t", F.lit(2))["c"]) < 1e-6)
    return two.where(~F.coalesce(doubt, F.lit(False))).select("name", F.col("t")[0]["entity_id"].alias("entity_id"), (-F.col("t")[0]["c"]).alias("cosine"))


#: The index that this worker built last, by the key of its block.
_BUILT: dict[str, EntityBlock] = {}


def _index(key: str, block: dict) -> EntityBlock:
    if key not in _BUILT:
        _BUILT.clear()
        _BUILT[key] = EntityBlock(**block)
    return _BUILT[key]


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        yield pa.RecordBatch.from_arrays([pa.array([sorted(set(grams(letters(words(n))))) for n in b.column(0).to_pylist()], pa.list_(pa.string()))], ["g"])


def gram_weights(listed: DataFrame) -> dict[str, float]:
    """Weight of each n-gram over all listed names; at most as many as there are n-grams of three letters."""
    n = listed.count()
    df = listed.select("entity_name").mapInArrow(_count_grams, "g array<string>").select(F.explode("g").alias("g")).groupBy("g").agg(F.count("*").alias("df"))
    return {r["g"]: float(np.log(1 + n / r["df"])) for r in df.collect()}


def _linker(key: str, sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = _index(key, sent.value)
        for b in batches:
            out = [(name, index.ids[k], c, a) for name in b.column(0).to_pylist() for k, c, a in index.candidates(name)]
            n, e, c, a = zip(*out) if out else ((), (), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(n, pa.string()), pa.array(e, pa.int64()), pa.array(c, pa.float64()), pa.array(a, pa.float64())], ["name", "entity_id", "cosine", "agrees"])

    return run


def link_names(names: DataFrame, entities: DataFrame, work: Workspace) -> DataFrame:
    """(name, entity_id, cosine): the listed entity each distinct name means.

    ``names`` has one string column.  Null, blank and filler names, names of
    unlisted entities and names that fit two entities equally give no row; a
    name equal to an entity's proper name is linked to it.

    The entities are joined in blocks of BLOCK (id order), so what is sent to
    the executors is bounded; weights and ordinary words are those of all
    blocks, and the candidates of all blocks compete.
    """
    spark, col = names.sparkSession, names.columns[0]
    distinct = work.save(names.select(F.col(col).alias("name")).where("trim(name) <> ''").distinct(), "names")
    listed = entities.select("entity_id", "entity_name", F.coalesce(F.col("entity_kind") == "individual", F.lit(False)).alias("person")).where("entity_id is not null and trim(entity_name) <> ''")
    often = max(ORDINARY, int(ORDINARY_SHARE * listed.count()))
    vocabulary = listed.where("not person").select(F.explode(F.array_distinct(F.split(F.lower("entity_name"), "[^\\p{L}\\p{N}]+"))).alias("w")).groupBy("w").agg(F.count("*").alias("c")).where(F.col("c") >= often)
    ordinary, idf = {r["w"] for r in vocabulary.collect()}, gram_weights(listed)
    # the search is long and its input short: spread it over all cores
    spread = distinct.repartition(4 * spark.sparkContext.defaultParallelism)
    lower, found = None, None
    while True:
        page = listed if lower is None else listed.where(F.col("entity_id") > lower)
        rows = page.orderBy("entity_id").limit(BLOCK).collect()
        if not rows:
            break
        block = {"ids": [r[0] for r in rows], "names": [r[1] for r in rows], "ordinary": ordinary, "person": [r[2] for r in rows], "idf": idf}
        part = spread.mapInArrow(_linker(f"{work.root}/{rows[0][0]}", spark.sparkContext.broadcast(block)), "name string, entity_id long, cosine double, agrees double")
        found = part if found is None else found.unionByName(part)
        lower = rows[-1][0]
        if len(rows) < BLOCK:
            break
    if found is None:
        return distinct.select("name", F.lit(None).cast("long").alias("entity_id"), F.lit(None).cast("double").alias("cosine")).where("false")
    return best_links(cluster_variants(work.save(found, "candidates"), listed, idf, ordinary))
