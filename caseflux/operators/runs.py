"""Gap-chained runs and greedy date anchors of dated records."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def gap_runs(days: DataFrame, key: str, day: str, window_days: int, least: int = 2) -> DataFrame:
    """(key, run, first_day, last_day, events, span, longest_gap) of chained days.

    Neighbours belong to one run if their gap is strictly below ``window_days``;
    a run may be longer than the window.  Null keys and days are left out.
    """
    w = Window.partitionBy(key).orderBy(day)
    rows = days.where(F.col(key).isNotNull() & F.col(day).isNotNull()).select(key, day)
    gap = F.date_diff(F.col(day), F.lag(day).over(w))
    marked = rows.withColumn("_gap", gap).withColumn("_fresh", F.when(F.col("_gap") < window_days, 0).otherwise(1))
    runs = marked.withColumn("run", F.sum("_fresh").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    out = runs.groupBy(key, "run").agg(F.min(day).alias("first_day"), F.max(day).alias("last_day"), F.count("*").alias("events"), F.max(F.when(F.col("_fresh") == 0, F.col("_gap"))).alias("longest_gap"))
    return out.where(F.col("events") >= least).withColumn("span", F.date_diff("last_day", "first_day"))


def greedy_anchors(days: DataFrame, key: str, day: str, tolerance: int) -> DataFrame:
    """(key, day, anchor): each day's earliest anchor within ``tolerance`` days.

    A day becomes an anchor if no earlier anchor lies within the tolerance;
    that state is no window frame, so a task walks its sorted rows once and
    carries one anchor a key.  Keys of any size stream through: rows are sorted
    by Spark and never gathered.
    """
    rows = days.where(F.col(key).isNotNull() & F.col(day).isNotNull()).select(F.col(key).alias("k"), F.col(day).cast("date").alias("d"))

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, anchor = None, None
        for b in batches:
            out = []
            for k, x in zip(b["k"], b["d"]):
                if k != last or (x - anchor).days > tolerance:
                    last, anchor = k, x
                out.append(anchor)
            yield pd.DataFrame({"k": b["k"], "d": b["d"].astype(str), "a": [str(x) for x in out]})

    placed = rows.repartition("k").sortWithinPartitions("k", "d").mapInPandas(walk, "k string, d string, a string")
    return placed.select(F.col("k").alias(key), F.col("d").alias("day"), F.col("a").alias("anchor"))
