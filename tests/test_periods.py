from pyspark.sql import functions as F

from caseflux.functions import periods as fp
from caseflux.operators import periods as op

SCHEMA = "year int, period string, stamp string, total_notifications long, malicious_attacks long, human_error long, system_faults long, monthly_notifications array<struct<month:string,count:long>>, top_sectors array<struct<sector:string,count:long>>"


def test_newest_first_merge_falls_through(spark):
    rows = [
        (2024, "H1", "20240801", None, 60, None, None, [], [("Health", None)]),
        (2024, "H1", "20240701", 100, 50, 30, 20, [("Jan", 100)], [("Health", 40)]),
        (2024, "H2", "20240701", 90, None, None, None, None, None),
    ]
    got = {(r["year"], r["period"]): r for r in op.merge_newest_first(spark.createDataFrame(rows, SCHEMA)).collect()}
    one = got[(2024, "H1")]
    assert (one["total_notifications"], one["malicious_attacks"], one["human_error"]) == (100, 60, 30)
    assert one["top_sectors"][0]["count"] == 40 and len(one["monthly_notifications"]) == 1
    assert got[(2024, "H2")]["total_notifications"] == 90 and len(got) == 2


def test_replace_twins_and_consistency(spark):
    df = spark.createDataFrame([(2023, "H1", "a", 100, 60, 30, 10, [("Jan", 90)], [("Health", 120)]), (2023, "H2", "a", 100, 60, 30, 10, [], []), (2022, "H1", "a", 20, 10, 5, 5, None, None)], SCHEMA)
    assert [r["year"] for r in op.twin_halves(df, ["total_notifications", "malicious_attacks", "human_error"]).collect()] == [2023]
    assert op.drop_twin_halves(df, ["total_notifications", "malicious_attacks", "human_error"]).count() == 2
    assert {(r["year"], r["problem"]) for r in op.self_consistency(df).collect()} == {(2023, "months do not add up"), (2023, "sector above total"), (2022, "total out of range")}
    new = df.where("year = 2022").withColumn("total_notifications", F.lit(70).cast("long"))
    assert {r["total_notifications"] for r in op.replace_periods(df, new).where("year = 2022").collect()} == {70}


def test_outline_and_buckets(spark):
    rows = [("s", 1, "Malicious", 30), ("s", 2, "Phishing", 20), ("s", 3, "Phishing", 20), ("s", 4, "Human error", 5), ("s", 5, "Lost device", 5), ("s", 0, "Title", None)]
    got = {(r["category"], r["label"], r["count"]) for r in op.outline_totals(spark.createDataFrame(rows, "sheet string, ordinal int, label string, count int"), ["Malicious", "Human error"]).collect()}
    assert got == {("Malicious", "Phishing", 20), ("Human error", "Lost device", 5)}
    df = spark.createDataFrame([([("1-10", 3)],), ([("1-10", 4), ("11-100", 1)],)], "d array<struct<range:string,count:long>>")
    assert {(r["bucket"], r["count"]) for r in op.bucket_totals(df, "d", ["1-10", "11-100", "101+"]).collect()} == {("1-10", 7), ("11-100", 1), ("101+", 0)}


def test_labels(spark):
    df = spark.createDataFrame([("1 July 2025 to 31 December 2025", "H1 2025", "1,001 - 5,000"), ("January to June 2023", "Jul-Dec 2024", "5,001 or more"), ("none", "x", ""), (None, None, None)], "a string, b string, c string")
    got = [tuple(r) for r in df.select(fp.period_of_name(F.col("a")), fp.semester_label(F.col("b")), fp.range_label(F.col("c"))).collect()]
    assert got == [("2025 H2", "2025 H1", "1001-5000"), ("2023 H1", "2024 H2", "5001+"), (None, None, None), (None, None, None)]
