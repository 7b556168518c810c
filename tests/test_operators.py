"""Operators that SQL cannot express, against small fixtures and golden numbers."""

import datetime as dt
import random

import numpy as np
from pyspark.sql import functions as F

from caseflux.functions import names as nm
from caseflux.functions import text as tx
from caseflux.operators import ledger as lg
from caseflux.operators import runs
from caseflux.operators import survival as sv
from caseflux.operators.vectors import cosine, nearest_vectors
from caseflux.sources import sinks


def day(n):
    return dt.date(2024, 1, 1) + dt.timedelta(days=n)


def test_gap_runs_chain_and_break(spark):
    rows = [("a", day(0)), ("a", day(60)), ("a", day(120)), ("b", day(0)), ("b", day(90)), ("c", day(0)), ("c", day(89)), (None, day(1)), ("d", None)]
    got = {r["k"]: r["events"] for r in runs.gap_runs(spark.createDataFrame(rows, "k string, d date"), "k", "d", 90).collect()}
    assert got == {"a": 3, "c": 2}


def test_greedy_anchors_follow_the_state(spark):
    rows = [("a", day(n)) for n in (0, 2, 4, 5, 9)] + [("b", day(3))]
    got = {(r["k"], r["day"]): r["anchor"] for r in runs.greedy_anchors(spark.createDataFrame(rows, "k string, d date"), "k", "d", 3).collect()}
    assert got[("a", str(day(2)))] == str(day(0))
    assert got[("a", str(day(5)))] == str(day(4)) == got[("a", str(day(4)))]
    assert got[("a", str(day(9)))] == str(day(9)) and got[("b", str(day(3)))] == str(day(3))


def test_published_figures_of_the_rates():
    low, high = sv.poisson_limits(21, 116643.0)
    assert abs(21 / 116643 * sv.DAYS - 6.5758) < 1e-3 and abs(low - 4.0705) < 1e-3 and abs(high - 10.0519) < 1e-3
    low, high = sv.poisson_limits(12, 102210.0)
    assert abs(low - 2.2158) < 1e-3 and abs(high - 7.4907) < 1e-3
    assert sv.poisson_limits(0, 10.0)[0] == 0
    assert abs(sv.chi2_sf(6.804, 5) - 0.2356) < 1e-3


def test_survival_steps(spark):
    rows = [("x", 10, 1), ("y", 10, 0), ("z", 20, 1), ("w", 30, 0)]
    got = sv.survival_curve(spark.createDataFrame(rows, "entity string, duration_days int, event int")).orderBy("time_days").collect()
    assert [(r["time_days"], r["events"], r["at_risk"]) for r in got] == [(10, 1, 4), (20, 1, 2)]
    assert abs(got[1]["survival"] - 0.75 * 0.5) < 1e-12 and abs(got[1]["hazard"] - 0.75) < 1e-12


def test_exponential_fit_golden(spark):
    rows = [("e", 667491, 1)] + [("e", 0, 1)] * 91
    f = sv.exponential_fit(spark.createDataFrame(rows, "entity string, duration_days int, event int")).first()
    assert abs(f["log_likelihood"] + 909.8333) < 1e-3


def test_name_keys(spark):
    rows = [("Acme Pty Ltd",), ("ACME PTY. LIMITED",), ("Acme",), ("Company Ltd",), ("Crème & Co",), (None,), ("",)]
    got = [r["k"] for r in spark.createDataFrame(rows, "n string").select(nm.name_key(F.col("n")).alias("k")).collect()]
    assert got[:3] == ["acme"] * 3 and got[3] == "company" and got[4] == "creme and co" and got[5:] == ["", ""]


def test_dates_in_text_and_links(spark):
    texts = [("On 11 July 2026",), ("seen 2024-02-31 there",), ("March 5th, 2023 it",), ("in April 2024",), ("nothing",), (None,)]
    got = [r["d"] for r in spark.createDataFrame(texts, "t string").select(tx.first_date(F.col("t")).alias("d")).collect()]
    assert got == ["2026-07-11", "2024-02-28", "2023-03-05", "2024-04-01", None, None]
    links = [("https://x.org/blog/2026/2/25/",), ("https://x.org/29th-january-2026-update",), ("https://x.org/2025/11/story",), (None,)]
    got = [r["d"] for r in spark.createDataFrame(links, "u string").select(tx.url_date(F.col("u")).alias("d")).collect()]
    assert got == ["2026-02-25", "2026-01-29", "2025-11-01", None]


def test_cosine_is_clamped(spark):
    rows = [([1.0, 2.0], [1.0, 2.0]), ([0.0, 0.0], [1.0, 2.0]), ([1.0], [1.0, 2.0])]
    got = [r["c"] for r in spark.createDataFrame(rows, "a array<double>, b array<double>").select(cosine(F.col("a"), F.col("b")).alias("c")).collect()]
    assert abs(got[0] - 1) < 1e-12 and got[1:] == [0.0, 0.0]


def test_nearest_vectors_against_brute_force(spark):
    rng = np.random.RandomState(1)
    m = rng.randn(90, 8)
    df = spark.createDataFrame([(i, [float(x) for x in v], "extra") for i, v in enumerate(m)], "vec_id long, embedding array<double>, query_id string")
    n = m / np.linalg.norm(m, axis=1, keepdims=True)
    s = n @ n.T
    np.fill_diagonal(s, -9)
    got = {r["query_id"]: r["vec_id"] for r in nearest_vectors(df, every=20, k=1, block=2).collect()}
    assert got == {i: int(s[i].argmax()) for i in range(0, 90, 20)}


def test_merge_split_restore_round_trip(spark):
    rows = [(f"d{k}", a, g, "merge", 1.0, None, dt.datetime(2024, 1, 1)) for k, (a, g) in enumerate([("a", "G"), ("b", "G"), ("c", "H")])]
    ledger = spark.createDataFrame(rows, "decision_id string, enriched_event_id string, deduplicated_event_id string, action string, certainty double, superseded_by string, created_at timestamp")
    saved = lg.snapshot(ledger)
    at = lambda n: F.lit(dt.datetime(2024, 1, n))
    merged = ledger.unionByName(lg.merge(ledger, "G", "H", at(2)))
    who = lambda df: {(r["deduplicated_event_id"], r["enriched_event_id"]) for r in lg.membership(df).collect()}
    assert who(merged) == {("G", "a"), ("G", "b"), ("G", "c")}
    parted = merged.unionByName(lg.split(merged, "G", "a", "N", at(3)))
    assert who(parted) == {("N", "a"), ("G", "b"), ("G", "c")}
    back = parted.unionByName(lg.restore(parted, saved, at(4)))
    assert who(back) == who(ledger)
    try:
        lg.merge(ledger, "G", "G", at(2))
        raise AssertionError("self merge went through")
    except ValueError:
        pass


def test_calibration_steps():
    assert lg.calibrated_threshold(0.9, 5, 4, 1) == 0.92 and lg.calibrated_threshold(0.9, 5, 1, 4) == 0.88
    assert lg.calibrated_threshold(0.9, 4, 4, 0) == 0.9 and lg.calibrated_threshold(0.97, 9, 9, 0) == 0.97


def test_export_and_rejects(spark, tmp_path):
    df = spark.createDataFrame([(1, "x"), (2, "y"), (None, "z")], "n int, s string")
    sinks.export_table(df, str(tmp_path / "out"), "json", between=("n", 1, 1))
    assert spark.read.json(str(tmp_path / "out")).count() == 1
    good, bad = sinks.split_rejects(df, "n >= 2")
    assert good.count() == 1 and bad.count() == 2


def test_stream_counts_equal_the_batch(spark, tmp_path):
    from caseflux.sources.tables import table
    from caseflux.streaming import events as st

    src = table(spark, "/root/testdata/sf0.001", "events")
    src.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = st.daily_counts(st.read_events(spark, str(tmp_path / "in"), src.schema), "3650 days")
    q = stream.writeStream.format("memory").queryName("daily").outputMode("complete").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    got = {tuple(r) for r in spark.table("daily").collect()}
    assert got == {tuple(r) for r in st.daily_counts(src).collect()} and random.random() < 1






def test_poisson_regression_gives_the_crude_ratio(spark):
    from caseflux.operators.regression import poisson_glm

    rows = [("a", 6, 61071.0), ("b", 27, 157782.0)]
    fit = {r["term"]: r for r in poisson_glm(spark.createDataFrame(rows, "band string, e int, x double"), ["band"], "e", "x").collect()}
    assert abs(fit["band=b"]["rate_ratio"] - 1.74177) < 1e-4
    assert abs(fit["band=b"]["se"] - (1 / 6 + 1 / 27) ** 0.5) < 1e-6


def test_merge_chains_and_cycles(spark, work):
    from caseflux.operators.chains import merge_targets

    chain = [(f"n{k:03d}", f"n{k + 1:03d}") for k in range(20)]
    rows = [*chain, ("x", "y"), ("y", "x"), ("z", "x"), ("q", "q"), (None, "a"), ("a", None), ("x", "y")]
    got = {r["incident"]: r["final"] for r in merge_targets(spark.createDataFrame(rows, "source string, target string"), work).collect()}
    assert all(got[f"n{k:03d}"] == "n020" for k in range(20))
    assert got["x"] == got["y"] == "x" and got["z"] == "x" and "q" not in got


def test_name_parts(spark):
    rows = [("Acme (Holdings) Australia", "Acme and Borumal; Zen / Quo", "ACL", "Australian Clinical Labs"), ("University of Queensland", "Long Name of Many Words and Even More Words", "UoQ", "University of Queensland"), (None, None, None, None)]
    df = spark.createDataFrame(rows, "a string, b string, s string, l string")
    got = [tuple(r) for r in df.select(nm.without_place(F.col("a")), nm.split_compound(F.col("b")), nm.is_initialism(F.col("s"), F.col("l"))).collect()]
    assert got[0] == ("acme", ["Acme", "Borumal", "Zen", "Quo"], True)
    assert got[1][0] == "university of queensland" and len(got[1][1]) == 1 and got[1][2] is True
    assert got[2][0] == "" and got[2][1] == [] and got[2][2] is False


def test_greedy_stars_against_a_plain_walk(spark, work):
    from caseflux.operators.stars import greedy_stars

    rng = random.Random(3)
    n = 120
    edges = {(min(a, b), max(a, b)) for a, b in ((rng.randrange(n), rng.randrange(n)) for _ in range(160)) if a != b} | {(k, k + 1) for k in range(40)}
    seed: dict[int, int] = {}
    for k in range(n):
        seed[k] = next((j for j in range(k) if seed[j] == j and (j, k) in edges), k)
    nodes = spark.createDataFrame([(k,) for k in range(n)] + [(5,)], "n long")
    got = {r["n"]: r["seed"] for r in greedy_stars(nodes, spark.createDataFrame([*edges, (7, None)], "a long, b long"), work, "n", "a", "b").collect()}
    assert got == seed
    assert greedy_stars(nodes.where("false"), spark.createDataFrame([], "a long, b long"), work, "n", "a", "b").count() == 0


def test_components_of_a_chain_that_labels_cross_node_by_node(spark, work):
    from caseflux.operators.components import connected_components

    # 000 - 150 - 149 - ... - 001: all labels point to 001, away from 000
    way = ["000", *(f"{k:03d}" for k in range(150, 0, -1))]
    edges = spark.createDataFrame(list(zip(way, way[1:])), "a string, b string")
    got = connected_components(edges, work, "a", "b").collect()
    assert len(got) == 151 and {r["label"] for r in got} == {"000"}


def test_incremental_matches_part_words_once_a_record(spark):
    from caseflux.plans import catalog

    plan = catalog.QUERIES["d41_incremental_matches"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "split(" not in plan and "part" in plan


def test_connected_components_of_names(spark, work):
    from caseflux.operators.components import connected_components

    edges = [(f"c{k:03d}", f"c{k + 1:03d}") for k in range(60)] + [("x", "y"), ("y", "x"), ("z", None), ("q", "q")]
    got = {r["node"]: r["label"] for r in connected_components(spark.createDataFrame(edges, "a string, b string"), work, "a", "b").collect()}
    assert got == {**{f"c{k:03d}": "c000" for k in range(61)}, "x": "x", "y": "x", "q": "q"}


def test_upserts_survive_a_broken_batch(spark, tmp_path):
    import shutil

    from caseflux.streaming.events import read_upserted, upsert_by_key

    target, schema = str(tmp_path / "t"), "k string, v int, at int"
    put = upsert_by_key(target, ["k"], ["at", "v"], buckets=4)
    batch = lambda rows: spark.createDataFrame(rows, schema)
    state = lambda: {tuple(r) for r in read_upserted(spark, target, batch([]).schema).collect()}
    assert state() == set()
    put(batch([("a", 1, 1), ("b", 1, 1), ("a", 2, 2)]), 0)
    put(batch([("a", 9, 1), ("c", 3, 3), (None, 4, 4)]), 1)
    want = {("a", 2, 2), ("b", 1, 1), ("c", 3, 3), (None, 4, 4)}
    assert state() == want
    put(batch([("c", 3, 3), ("a", 9, 1), (None, 4, 4)]), 1)  # delivered again
    assert state() == want
    put(batch([("b", 7, 7)]), 2)
    (tmp_path / "t" / "pointer-2").unlink()  # broke off before its pointer
    (tmp_path / "t" / ".pointer-2.crc").unlink(missing_ok=True)
    assert state() == want
    put(batch([("b", 8, 8)]), 2)
    assert state() == want - {("b", 1, 1)} | {("b", 8, 8)}
    shutil.rmtree(target)


def test_five_censored_families(spark):
    import math

    from caseflux.operators.survival import parametric_models

    rng = random.Random(8)
    rows = []
    for k in range(400):
        t = max(1, int(300 * (-math.log(1 - rng.random())) ** (1 / 1.8)))  # Weibull, shape 1.8
        rows.append((f"e{k}", min(t, 500), int(t <= 500)))
    spells = spark.createDataFrame(rows, "entity string, duration_days int, event int")
    got = {r["family"]: r for r in parametric_models(spells).collect()}
    e, x = sum(r[2] for r in rows), sum(r[1] for r in rows)
    assert abs(got["exponential"]["log_likelihood"] - (e * math.log(e / x) - e)) < 1e-9
    assert abs(math.exp(got["weibull"]["theta"][1]) - 1.8) < 0.2 and got["weibull"]["log_likelihood"] > got["exponential"]["log_likelihood"] + 10
    assert got["generalised gamma"]["log_likelihood"] >= got["weibull"]["log_likelihood"] - 1e-6
    assert min(got.values(), key=lambda r: r["aic"])["family"] in ("weibull", "generalised gamma") and len(got) == 5
    assert parametric_models(spells.where("event = 0")).count() == 0


def test_likelihood_ratio_and_contrast_closed_forms(spark):
    import math

    from caseflux.operators.regression import contrast, likelihood_ratio

    rows = [("a", 6, 61071.0), ("b", 27, 157782.0), ("c", 9, 40000.0)]
    df = spark.createDataFrame(rows, "band string, e int, x double").selectExpr("*", "1 as one")
    test = likelihood_ratio(df, ["band"], [], "e", "x").first()
    total = math.fsum(e * math.log(e / x) for _, e, x in rows) - 42 * math.log(42 / sum(x for *_, x in rows))
    assert abs(test["statistic"] - 2 * total) < 1e-6 and test["df"] == 2 and 0 < test["p_value"] < 1
    row = contrast(df, ["band"], "e", "x", {"band=b": 1.0, "band=c": -1.0}).first()
    assert abs(row["estimate"] - math.log((27 / 157782) / (9 / 40000))) < 1e-6 and abs(row["se"] - (1 / 27 + 1 / 9) ** 0.5) < 1e-6


def test_wipe_needs_the_allow_list(spark, tmp_path):
    import pytest

    from caseflux.sources.sinks import wipe

    for name in ("child", "parent"):
        spark.range(3).write.parquet(str(tmp_path / name))
    paths = {n: str(tmp_path / n) for n in ("parent", "child")}
    with pytest.raises(ValueError):
        wipe(spark, paths, ("child",), ["child", "parent"])
    assert spark.read.parquet(paths["child"]).count() == 3
    assert wipe(spark, paths, ("child", "parent"), ["child", "parent"]) == {"child": 3, "parent": 3}
    assert spark.read.parquet(paths["child"]).count() == spark.read.parquet(paths["parent"]).count() == 0


def test_report_page_holds_its_data(spark, tmp_path):
    from caseflux.sources.sinks import write_html_report

    write_html_report({"a": spark.createDataFrame([("</script>", 1)], "x string, n int"), "b": spark.range(2).toDF("id")}, str(tmp_path / "page"))
    page = "".join(p.read_text() for p in (tmp_path / "page").glob("part-*"))
    assert page.count("</script>") == 1 and '\\"n\\":1' in page
