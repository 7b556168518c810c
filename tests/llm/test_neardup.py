import random

from caseflux.llm import components, incremental, neardup
from caseflux.llm.wordsets import jaccard


def edited(rng, words, k):
    out = list(words)
    for _ in range(k):
        at = rng.randrange(len(out))
        kind = rng.randrange(3)
        if kind == 0:
            out[at] = f"e{rng.randrange(10**6)}"
        elif kind == 1:
            out.insert(at, f"i{rng.randrange(10**6)}")
        else:
            out[at - 1], out[at] = out[at], out[at - 1]
    return out


def make(seed, groups=60, per=3, size=40, hot=0):
    rng = random.Random(seed)
    common = [f"c{k}" for k in range(60)]
    rows = []
    for g in range(groups):
        base = [rng.choice(common) if rng.random() < 0.6 else f"r{rng.randrange(600)}" for _ in range(size)]
        for j in range(per):
            rows.append((f"g{g:03d}-{j}", " ".join(edited(rng, base, rng.choice((0, 1, 3, 8))))))
    base = [f"h{k}" for k in range(size)]
    rows += [(f"hot-{k:03d}", " ".join(edited(rng, base, 4))) for k in range(hot)]
    return rows


def brute(rows, t):
    return {(a, b) for k, (a, x) in enumerate(rows) for b, y in rows[k + 1 :] if jaccard(x, y) >= t for a, b in [sorted((a, b))]}


def pairs(df):
    return {(r["left_id"], r["right_id"]) for r in df.collect()}


SCHEMA = "id string, text string, h string, n string"


def test_pairs_equal_brute_force(spark, work):
    rows = make(3)
    df = spark.createDataFrame([(i, t, "clash", "clash") for i, t in rows] + [(rows[0][0], rows[0][1], "again", ""), ("null", None, "", ""), ("blank", "", "", ""), ("signs", "?!", "", ""), (None, rows[1][1], "", "")], SCHEMA)
    assert pairs(neardup.near_duplicate_pairs(df, "id", "text", work)) == brute(rows, 0.6)


def test_hot_group_is_split_and_whole(spark, work):
    rows = make(5, groups=20, hot=60)
    df = spark.createDataFrame(rows, "id string, text string")
    assert pairs(neardup.near_duplicate_pairs(df, "id", "text", work, shard_rows=8)) == brute(rows, 0.6)


def test_hot_words_beside_a_rare_one_in_every_class(spark, work):
    rows = [(f"hot-{k:02d}", " ".join([f"h{j}" for j in range(30)] + [f"edit{k}"])) for k in range(40)]
    # the edit words stand in one unrelated text each, so they are shared and rare
    rows += [(f"own-{k:02d}", f"edit{k} " + " ".join(f"o{k}x{j}" for j in range(8))) for k in range(40)]
    df = spark.createDataFrame(rows, "id string, text string")
    want = brute(rows, 0.6)
    assert len(want) == 40 * 39 // 2
    assert pairs(neardup.near_duplicate_pairs(df, "id", "text", work, shard_rows=8)) == want


def test_pairs_that_share_only_frequent_words_behind_many_rare_ones(spark, work):
    # the nine edits of each text stand in one unrelated text each: shared, rarer than all that ties the pairs
    rows = [(f"near-{k:02d}", " ".join([f"c{j}" for j in range(55)] + [f"edit{k}x{j}" for j in range(9)])) for k in range(30)]
    rows += [(f"own-{k:02d}", " ".join([f"edit{k}x{j}" for j in range(9)] + [f"o{k}x{j}" for j in range(30)])) for k in range(30)]
    df = spark.createDataFrame(rows, "id string, text string")
    want = brute(rows, 0.6)
    assert len(want) == 30 * 29 // 2
    assert pairs(neardup.near_duplicate_pairs(df, "id", "text", work)) == want
    assert pairs(neardup.near_duplicate_pairs(df, "id", "text", type(work)(spark, "parts"), shard_rows=8)) == want


def test_shards_lose_no_pair_within_the_bounds():
    import numpy as np

    from caseflux.llm import vptree as vp

    rng = np.random.default_rng(5)
    fp = rng.integers(0, 1 << 63, (40, 4)).astype(np.uint64)[rng.integers(0, 40, 900)]
    for _ in range(12):
        fp[np.arange(900), rng.integers(0, 4, 900)] ^= np.uint64(1) << rng.integers(0, 63, 900).astype(np.uint64)
    size = rng.integers(20, 90, 900)
    most = (size * rng.uniform(0.6, 1.7, 900)).astype(np.int64)
    i, j = np.triu_indices(900, 1)
    near = (vp.hamming(fp[i], fp[j]) <= 0.25 * (size[i] + size[j])) & (size[i] <= most[j]) & (size[j] <= most[i])
    for side in (None, rng.integers(1, 3, 900)):
        ok = near if side is None else near & (side[i] != side[j])
        want = set(zip(i[ok].tolist(), j[ok].tolist()))
        got = {tuple(sorted(p)) for p in zip(*(x.tolist() for x in vp.range_pairs(fp, size, most, 0.6, side)))}
        assert len(want) > 500 and want <= got
        assert all(vp.hamming(fp[a], fp[b]) <= 0.25 * (size[a] + size[b]) and (side is None or side[a] != side[b]) for a, b in got)


def test_long_texts_and_exact_copies(spark, work):
    long = " ".join(f"w{k}" for k in range(20_000))
    rows = [("a", long), ("b", long + " one more"), ("c", long), ("d", "short text of few words"), ("e", "short text of few Words!")]
    df = spark.createDataFrame(rows, "id string, text string")
    assert pairs(neardup.near_duplicate_pairs(df, "id", "text", work)) == {("a", "b"), ("a", "c"), ("b", "c"), ("d", "e")}


def test_empty_table(spark, work):
    df = spark.createDataFrame([], "id string, text string")
    assert neardup.near_duplicate_pairs(df, "id", "text", work).count() == 0


def test_two_sides(spark):
    rows = [("b", "a", "one two three four", "one two three four five"), ("c", "d", "one", "two"), ("e", "f", None, "x"), ("g", "h", "", ""), (None, "x", "q", "q"), ("b", "a", "one two three four", "one two three four five")]
    df = spark.createDataFrame(rows, "l string, r string, x string, y string")
    assert pairs(neardup.near_duplicate_sides(df, "l", "r", "x", "y")) == {("a", "b")}


def union_find(edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        parent[y] = x
    return {x: find(x) for x in parent}


def test_components_of_random_graph_and_long_chain(spark, work):
    rng = random.Random(4)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)] + [(1000 + k, 1001 + k) for k in range(70)] + [(5000, 5000 + k) for k in range(1, 60)]
    rng.shuffle(edges)
    df = spark.createDataFrame([*edges, (7, None), edges[0]], "src long, dst long")
    got = {r["node"]: r["label"] for r in components.min_label_components(df, work).collect()}
    assert got == union_find(edges)


def test_bipartite_groups(spark, work):
    rows = [("a", "X"), ("b", "X"), ("b", "Y"), ("c", "Y"), ("d", "Z"), ("X", "Q"), ("e", None), (None, "X"), ("a", "X")]
    got = {(r["i"], r["group_id"]) for r in components.bipartite_groups(spark.createDataFrame(rows, "i string, t string"), "i", "t", work).collect()}
    assert got == {("a", "a"), ("b", "a"), ("c", "a")}
    assert components.bipartite_groups(spark.createDataFrame([], "i string, t string"), "i", "t", work).count() == 0


def test_new_batches_against_history(spark, work):
    import datetime as dt

    rows = make(9, groups=12, per=2)
    t = {i: x for i, x in rows}
    batches = [("b1", dt.datetime(2024, 1, 1), "accepted"), ("b2", dt.datetime(2024, 2, 1), "new"), ("b3", dt.datetime(2024, 3, 1), "new")]
    ids = sorted(t)
    stands = [("b1", i) for i in ids[:8]] + [("b2", i) for i in ids[6:16]] + [("b3", i) for i in ids[14:]] + [("b2", "no-text"), ("b3", "no-text"), (None, ids[0]), ("zz", ids[0]), ("b2", None)]
    opened = {b: o for b, o, _ in batches}
    first = {}
    for b, i in stands:
        if b in opened and i is not None:
            first[i] = min(first.get(i, opened[b]), opened[b])
    want = set()
    for b, i in stands:
        if b in ("b2", "b3") and i is not None:
            near = [j for j in first if j != i and j in t and i in t and jaccard(t[i], t[j]) >= 0.6]
            if first[i] < opened[b] or any(first[j] < opened[b] for j in near):
                want.add((b, i))
    got = incremental.repeats_of_new_batches(
        spark.createDataFrame([(*s, "x") for s in stands], "batch_id string, enriched_event_id string, h string"),
        spark.createDataFrame(batches, "batch_id string, opened_at timestamp, state string"),
        spark.createDataFrame([(*r, "clash") for r in (*rows, rows[0])], "enriched_event_id string, summary string, id string"),
        work,
    )
    assert {tuple(r) for r in got.collect()} == want


def test_new_batch_texts_reordered_or_at_the_limit(spark, work):
    import datetime as dt

    rng = random.Random(12)
    history, new = {}, {}
    for k in range(60):
        words = [f"w{rng.randrange(900)}" for _ in range(60)]
        history[f"old-{k:02d}"] = " ".join(words)
        edit = list(words)
        for at in rng.sample(range(60), 1 if k % 2 else 14):
            edit[at] = f"e{rng.randrange(10**6)}"
        if k % 2:
            rng.shuffle(edit)
        new[f"new-{k:02d}"] = " ".join(edit)
    want = {("b2", i) for i, x in new.items() if any(jaccard(x, y) >= 0.6 for y in history.values())}
    assert len(want) > 40
    got = incremental.repeats_of_new_batches(
        spark.createDataFrame([*(("b1", i) for i in history), *(("b2", i) for i in new)], "batch_id string, enriched_event_id string"),
        spark.createDataFrame([("b1", dt.datetime(2024, 1, 1), "accepted"), ("b2", dt.datetime(2024, 2, 1), "new")], "batch_id string, opened_at timestamp, state string"),
        spark.createDataFrame([*history.items(), *new.items()], "enriched_event_id string, summary string"),
        work,
    )
    assert {tuple(r) for r in got.collect()} == want


def test_two_appends_equal_one_and_repeat_nothing(spark, work):
    from caseflux.llm import chunks

    rows = make(31, groups=20, per=2)
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "id string, text string, h string")
    one, two = chunks.ChunkIndex(spark, f"{work.root}/one"), chunks.ChunkIndex(spark, f"{work.root}/two")
    order = one.order(df, "id", "text")
    assert all((x == y).all() for x, y in zip(order, one.order(df.where("false"), "id", "text")))  # fixed when made
    records = work.save(chunks.chunk_records(df, "id", "text", order, 0.6), "both_records")
    one.append(records)
    two.append(records.where("id < 'g010'"))
    before = two.table(list(range(chunks.BUCKETS))).count()
    two.append(records.where("id >= 'g010'"))
    every = lambda index: sorted(tuple(r) for r in index.table(list(range(chunks.BUCKETS))).distinct().collect())
    assert every(one) == every(two)
    added = sum(len(set(r["chunks"])) for r in records.where("id >= 'g010' and size(chunks) > 0").collect())
    assert two.table(list(range(chunks.BUCKETS))).count() == before + added
    assert one.table([3]).count() < one.table(list(range(chunks.BUCKETS))).count()


def test_an_index_that_stays(spark, work):
    import datetime as dt

    rows = make(33, groups=8, per=3)
    ids = [i for i, _ in rows]
    articles = spark.createDataFrame([(*r, "x") for r in rows], "enriched_event_id string, summary string, chunks string")

    def run(stands, states, path):
        return {tuple(r) for r in incremental.repeats_of_new_batches(
            spark.createDataFrame(stands, "batch_id string, enriched_event_id string"),
            spark.createDataFrame([(b, dt.datetime(2024, k + 1, 1), s) for k, (b, s) in enumerate(states)], "batch_id string, opened_at timestamp, state string"),
            articles, type(work)(spark, "again"), index_path=path).collect()}

    stay = f"{work.root}/stays"
    first = [("b1", i) for i in ids[::3]] + [("b2", i) for i in ids[1::3]]
    later = [*first, *(("b3", i) for i in ids[2::3]), ("b3", ids[0])]
    run(first, [("b1", "accepted"), ("b2", "new")], stay)
    n = spark.read.parquet(f"{stay}/ids").count()
    want = run(later, [("b1", "accepted"), ("b2", "accepted"), ("b3", "new")], None)
    assert run(later, [("b1", "accepted"), ("b2", "accepted"), ("b3", "new")], stay) == want and ("b3", ids[0]) in want
    kept = spark.read.parquet(f"{stay}/ids")
    assert n <= len(ids) and kept.count() == kept.select("id").distinct().count() == len(ids)
    assert run(first, [("b1", "accepted"), ("b2", "accepted")], None) == set()


def test_new_batches_without_any_broadcast(spark, work, monkeypatch):
    """Beyond the broadcast bound all joins are shuffled; the rows stay the same."""
    from caseflux import session

    monkeypatch.setattr(session, "BROADCAST_BYTES", -1)
    test_new_batches_against_history(spark, work)


def test_word_lookup_loses_no_pair():
    import numpy as np

    from caseflux.llm import wordlookup
    from caseflux.llm import wordsets as ws

    texts = [t for _, t in make(21, groups=50, hot=30)]
    flat, counts = ws.flat_hashes(texts)
    h, fp = ws.set_hashes(flat, counts), ws.fingerprints(flat, counts).view(np.uint64)
    words, kept = wordlookup.prefixes(flat, counts, (np.zeros(0, np.int64), np.zeros(0, np.int64)), 0.6)
    found = {(int(a), int(b)) for q, d in wordlookup.Postings(h, counts, fp, words, kept, 0.6).pairs(h, counts, fp, words, kept) for a, b in zip(q, d)}
    want = {(int(h[i]), int(h[j])) for i, x in enumerate(texts) for j, y in enumerate(texts) if h[i] != h[j] and jaccard(x, y) >= 0.6}
    assert want and want <= found
