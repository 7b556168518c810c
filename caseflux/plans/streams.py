"""Batch runs of the streaming plans, and windows over the event table."""

from __future__ import annotations

from pyspark.sql import functions as F

from caseflux.plans.registry import query
from caseflux.sources.tables import table
from caseflux.streaming import events as st


@query("st01_daily_counts", "select strftime(ts, '%Y-%m-%d') as day, event_type, count(*) as n, round(sum(value), 4) as total from events group by 1, 2")
def st01(spark, d):
    return st.daily_counts(table(spark, d, "events"))


@query("st02_first_seen", "select distinct event_id from events")
def st02(spark, d):
    return st.first_seen(table(spark, d, "events")).select("event_id")


@query("st03_user_sessions", "select user_id, count(*) as sessions from (select user_id, case when date_diff('microsecond', lag(ts) over (partition by user_id order by ts, event_id), ts) < 1800000000 then 0 else 1 end as fresh from events) where fresh = 1 group by 1")
def st03(spark, d):
    from pyspark.sql import Window

    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    gap = F.unix_micros(F.col("ts").cast("timestamp")) - F.unix_micros(F.lag("ts").over(w).cast("timestamp"))
    rows = table(spark, d, "events").withColumn("gap", gap).where("gap is null or gap >= 1800000000")
    return rows.groupBy("user_id").agg(F.count("*").alias("sessions"))
