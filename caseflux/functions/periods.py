"""Column functions of half-year reports: period labels, ranges, bucket labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from caseflux.functions.text import MONTH_WORDS, month_number


def period_of_name(c: Column) -> Column:
    """``2025 H2`` of a name such as "1 July 2025 to 31 December 2025"; null where none is named.

    The first month and the last year decide; January to June is H1.
    """
    first = month_number(F.regexp_extract(c, f"(?i)({MONTH_WORDS})", 1))
    year = F.regexp_extract(c, "((?:19|20)\\d{2})\\D*$", 1)
    half = F.when(first <= 6, "H1").when(first <= 12, "H2")
    return F.when((year != "") & half.isNotNull(), F.concat_ws(" ", year, half))


def semester_label(c: Column) -> Column:
    """One spelling of a half-year label: ``H1 2025``, ``2025-h1``, ``Jan-Jun 2025`` and the like."""
    low = F.lower(F.trim(c))
    year = F.regexp_extract(low, "((?:19|20)\\d{2})", 1)
    half = F.when(low.rlike("\\bh1\\b|jan\\w*\\W+(to\\W+)?jun"), "H1").when(low.rlike("\\bh2\\b|jul\\w*\\W+(to\\W+)?dec"), "H2")
    return F.when((year != "") & half.isNotNull(), F.concat_ws(" ", year, half))


def range_label(c: Column) -> Column:
    """Range such as ``1,001 - 5,000`` as ``1001-5000``; open ends as ``5001+``."""
    t = F.regexp_replace(F.lower(F.trim(c)), "[, ]", "")
    t = F.regexp_replace(F.regexp_replace(t, "(to|–|—)", "-"), "(ormore|andabove|andover)$", "+")
    return F.nullif(t, F.lit(""))


def range_bounds(c: Column) -> Column:
    """struct<low, high> of a ``range_label``; an open end has a null high."""
    t = range_label(c)
    low = F.regexp_extract(t, "^(\\d+)", 1).try_cast("long")
    high = F.regexp_extract(t, "^\\d+-(\\d+)", 1).try_cast("long")
    return F.struct(low.alias("low"), F.when(t.rlike("^\\d+$"), low).otherwise(high).alias("high"))
