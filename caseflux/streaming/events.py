"""Structured Streaming over the event tables: windows, late data, upserts."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_events(spark: SparkSession, folder: str, schema: StructType, files_per_trigger: int = 16) -> DataFrame:
    """A stream of the Parquet files that arrive in ``folder``."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


def daily_counts(events: DataFrame, late: str = "3 days") -> DataFrame:
    """(day, event_type, n, total): tumbling days; rows later than ``late`` are dropped by the watermark.

    Works on a stream and, with the same result, on a batch.
    """
    rows = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)
    by = rows.groupBy(F.window("ts", "1 day").alias("w"), "event_type")
    return by.agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total")).select(F.date_format("w.start", "yyyy-MM-dd").alias("day"), "event_type", "n", "total")


def first_seen(events: DataFrame, late: str = "7 days") -> DataFrame:
    """Each event id once, however often it is delivered within the watermark."""
    rows = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)
    return rows.dropDuplicatesWithinWatermark(["event_id"]) if rows.isStreaming else rows.dropDuplicates(["event_id"])


def _filesystem(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _versions(spark: SparkSession, target: str, before: int | None = None) -> dict[int, int]:
    """Bucket -> version of the last complete pointer (before a batch, where that is given)."""
    at, fs = _filesystem(spark, target)
    if not fs.exists(at):
        return {}
    names = [s.getPath().getName() for s in fs.listStatus(at)]
    done = [int(n[8:]) for n in names if n.startswith("pointer-") and n[8:].isdigit() and (before is None or int(n[8:]) < before)]
    if not done:
        return {}
    text = spark.read.text(f"{target}/pointer-{max(done)}", wholetext=True).first()[0]
    return {int(k): v for k, v in json.loads(text).items()}


def _state(spark: SparkSession, target: str, schema: StructType, versions: dict[int, int]) -> DataFrame | None:
    paths = [f"{target}/v{v}/bucket={b}" for b, v in sorted(versions.items())]
    return spark.read.schema(schema).parquet(*paths) if paths else None


def read_upserted(spark: SparkSession, target: str, schema: StructType) -> DataFrame:
    """The table that ``upsert_by_key`` keeps: the versions that its last pointer names."""
    rows = _state(spark, target, schema, _versions(spark, target))
    return spark.createDataFrame([], schema) if rows is None else rows


def upsert_by_key(target: str, keys: list[str], order: list[str], buckets: int = 16):
    """A ``foreachBatch`` function that keeps the latest row of each key under ``target``.

    Keys are spread over buckets; a batch writes anew only the buckets it
    touches, in a version folder of its own, and then a pointer that names the
    version of every bucket.  A pointer appears by one rename, so a batch that
    breaks off leaves the last complete state readable, and a repeated batch
    starts from the state before it.
    """
    from caseflux.operators.ledger import keep_latest

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        versions = _versions(spark, target, batch_id)
        placed = batch.withColumn("_bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))
        touched = sorted(r[0] for r in placed.select("_bucket").distinct().collect())
        if not touched:
            return
        old = _state(spark, target, batch.schema, {b: v for b, v in versions.items() if b in touched})
        rows = batch if old is None else old.unionByName(batch)
        latest = keep_latest(rows, keys, order).withColumn("bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))
        latest.write.mode("overwrite").partitionBy("bucket").parquet(f"{target}/v{batch_id}")
        pointer = json.dumps({**versions, **dict.fromkeys(touched, batch_id)})
        draft, fs = _filesystem(spark, f"{target}/_pointer-{batch_id}")
        out = fs.create(draft, True)
        out.writeBytes(pointer)
        out.close()
        final, _ = _filesystem(spark, f"{target}/pointer-{batch_id}")
        fs.delete(final, False)
        fs.rename(draft, final)

    return run
