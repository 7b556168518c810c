"""Column functions of incident records: severity, types, periods, buckets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Severities by rank, and the labels of the record-count bins.
SEVERITIES = ("Critical", "High", "Medium", "Low")
RECORD_BINS = ("1-10", "11-100", "101-1K", "1K-10K", "10K-100K", "100K-1M", "1M-10M", "10M+")
MOST_RECORDS = 1_000_000_000


def severity_label(c: Column) -> Column:
    """Plain severity of a plain or qualified (``EventSeverity.HIGH``) spelling; null stays null."""
    return F.initcap(F.regexp_replace(c, "^EventSeverity\\.", ""))


def severity_rank(c: Column) -> Column:
    """4 for critical down to 1 for low; 0 for anything else and null."""
    s = severity_label(c)
    rank = F.lit(0)
    for k, name in enumerate(SEVERITIES):
        rank = F.when(s == name, 4 - k).otherwise(rank)
    return rank


def type_label(c: Column) -> Column:
    """Readable event type: prefix cut, underscores to blanks, words capitalised."""
    return F.initcap(F.replace(F.regexp_replace(c, "^[A-Za-z]+\\.", ""), F.lit("_"), F.lit(" ")))


def month(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM")


def half_year(c: Column) -> Column:
    """``2024 H1`` style key."""
    return F.concat(F.year(c).cast("string"), F.when(F.month(c) <= 6, " H1").otherwise(" H2"))


def record_bin(c: Column) -> Column:
    """Log-decade bin of a positive count; null for none."""
    ladder = F.when(c <= 0, None)
    for k, name in enumerate(RECORD_BINS[:-1]):
        ladder = ladder.when(c <= 10 ** (k + 1), name)
    return ladder.when(c.isNotNull(), RECORD_BINS[-1])


def plausible_records(c: Column) -> Column:
    return c.between(1, MOST_RECORDS)
