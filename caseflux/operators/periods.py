"""Consolidation of half-year period records.

A period record is a row of (year, period, stamp, total_notifications, counts
by cause, nested lists).  Records of one period come from several files; the
stamp orders them, newest first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KEYS = ("year", "period")


def merge_newest_first(records: DataFrame, stamp: str = "stamp") -> DataFrame:
    """One row per period: each field from the newest record that has a value.

    Empty lists count as missing.  A list of structs without any count falls
    through to an older record too.
    """
    w = Window.partitionBy(*KEYS).orderBy(F.desc(stamp)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    fields = [f for f in records.schema.fields if f.name not in (*KEYS, stamp)]

    def present(f) -> Column:
        c = F.col(f.name)
        if f.dataType.typeName() != "array":
            return c
        inner = f.dataType.elementType
        some = F.size(c) > 0
        if inner.typeName() == "struct" and "count" in inner.names:
            some = some & F.exists(c, lambda x: x["count"].isNotNull())
        return F.when(some, c)

    first = [F.first(present(f), ignorenulls=True).over(w).alias(f.name) for f in fields]
    return records.select(*KEYS, *first, F.row_number().over(Window.partitionBy(*KEYS).orderBy(F.desc(stamp))).alias("_k")).where("_k = 1").drop("_k")


def replace_periods(old: DataFrame, new: DataFrame) -> DataFrame:
    """New records replace the old ones of their periods; others stay."""
    return old.join(new.select(*KEYS).distinct(), list(KEYS), "left_anti").unionByName(new)


def twin_halves(records: DataFrame, fields: list[str], least: int = 3) -> DataFrame:
    """Years whose H1 and H2 records agree in every field, at least ``least`` of them not null."""
    a, b = records.where("period = 'H1'").alias("a"), records.where("period = 'H2'").alias("b")
    same = F.lit(True)
    for f in fields:
        same = same & F.col(f"a.{f}").eqNullSafe(F.col(f"b.{f}"))
    known = sum(F.col(f"a.{f}").isNotNull().cast("int") for f in fields)
    return a.join(b, "year").where(same & (known >= least)).select("year")


def drop_twin_halves(records: DataFrame, fields: list[str]) -> DataFrame:
    """Without the H2 record of a year whose halves are twins."""
    twins = twin_halves(records, fields).withColumn("period", F.lit("H2"))
    return records.join(twins, list(KEYS), "left_anti")


def plausible_sectors(sectors: Column, total: Column) -> Column:
    """Counts above 250 or the period's total become null."""
    most = F.least(F.lit(250), F.coalesce(total, F.lit(250)))
    return F.transform(sectors, lambda s: F.struct(s["sector"].alias("sector"), F.when(s["count"] <= most, s["count"]).alias("count")))


def outline_totals(rows: DataFrame, parents: list[str], ordinal: str = "ordinal", sheet: str = "sheet") -> DataFrame:
    """(sheet, category, label, count) of an outline sheet: sub-rows under their category row.

    Consecutive equal rows count once; a category row starts a new block.
    """
    w = Window.partitionBy(sheet).orderBy(ordinal)
    before = F.struct(F.lag("label").over(w).alias("label"), F.lag("count").over(w).alias("count"))
    rows = rows.withColumn("_before", before).where(~(F.col("label").eqNullSafe(F.col("_before.label")) & F.col("count").eqNullSafe(F.col("_before.count"))))
    parent = F.when(F.col("label").isin(*parents), F.col("label"))
    filled = F.last(parent, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    return rows.withColumn("category", filled).where("category is not null and label <> category").select(sheet, "category", "label", "count")


def bucket_totals(records: DataFrame, field: str, buckets: list[str]) -> DataFrame:
    """(bucket, count): nested (range, count) lists summed over all periods on a fixed spine."""
    spine = records.sparkSession.createDataFrame([(b, k) for k, b in enumerate(buckets)], "bucket string, place int")
    found = records.select(F.explode(field).alias("x")).groupBy(F.col("x.range").alias("bucket")).agg(F.sum("x.count").alias("count"))
    return spine.join(found, "bucket", "left").select("bucket", "place", F.coalesce("count", F.lit(0)).alias("count"))


def self_consistency(records: DataFrame) -> DataFrame:
    """(year, period, problem): parts that do not add up to the total."""
    total = F.col("total_notifications")
    parts = F.col("malicious_attacks") + F.col("human_error") + F.col("system_faults")
    monthly = F.aggregate("monthly_notifications", F.lit(0).cast("long"), lambda s, x: s + F.coalesce(x["count"], F.lit(0)))
    problems = F.array_compact(
        F.array(
            F.when(parts != total, F.lit("causes do not add up")),
            F.when((F.size("monthly_notifications") > 0) & (monthly != total), F.lit("months do not add up")),
            F.when(F.exists("top_sectors", lambda s: s["count"] > total), F.lit("sector above total")),
            F.when(~total.between(50, 2000), F.lit("total out of range")),
        )
    )
    return records.select(*KEYS, F.explode(problems).alias("problem"))
