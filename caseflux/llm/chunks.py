"""Problem 1: new batches against all history, by content-defined chunking.

A text is normalised to its lower-cased words, one blank between them.  A
rolling hash over ``WINDOW`` bytes sets the chunk boundaries, so an edit moves
only the boundaries near it.  The chunk table (chunk -> record) persists under
a path; a new batch is the only thing that is chunked, it looks up its own
chunks in the table, sums the shared bytes by record and decides by coverage.
What the batch brings is appended after it has been answered.  Coverage says
nothing of reordered words; texts it leaves undecided go to ``wordlookup``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseflux.llm import wordlookup as wl
from caseflux.llm import wordsets as ws
from caseflux.session import Workspace, broadcast_if_small

WINDOW = 4
MEAN_BYTES = 12
#: Share of a new text's bytes that a record must share to be a candidate.
COVERAGE = 0.2
#: A new text is looked up by this many of its rarest chunks.
LOOKUPS = 16
#: Word sets that a chunking task remembers, so that it chunks copies once.
SEEN_CLASSES = 500_000
#: One-bit min-hashes of the word set, kept with every entry of the chunk table.
SKETCH = 128
#: Standard deviations below the expected agreement at which a pair is left out.
SKETCH_SLACK = 3.0
#: Parts of the chunk table by chunk; a batch reads those that its chunks fall into.
BUCKETS = 16

_MULT = 0x9E3779B97F4A7C15 | 1
_INV = pow(_MULT, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n, base, np.uint64)]), dtype=np.uint64)


def normalise(text: str) -> str:
    return " ".join(ws.WORD.findall(text.lower()))


def chunk_texts(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, bytes, text index) of every chunk, in order."""
    parts = [normalise(t).encode("utf-8", "surrogatepass") + b"\n" if t else b"" for t in texts]
    parts = [p if len(p) > 1 else b"" for p in parts]
    lengths = np.array([len(p) for p in parts], np.int64)
    total = int(lengths.sum())
    if not total:
        z = np.zeros(0, np.int64)
        return z, z, z
    data = np.frombuffer(b"".join(parts), np.uint8).astype(np.uint64)
    with np.errstate(over="ignore"):
        roll = np.zeros(total, np.uint64)
        for k in range(WINDOW):
            roll[k:] += data[: total - k] * np.uint64(pow(0xD6E8FEB86659FD93, k + 1, 1 << 64))
        cut = ws.mix(roll) % np.uint64(MEAN_BYTES) == 0
        ends_of_text = np.cumsum(lengths[lengths > 0]) - 1
        cut[ends_of_text] = True
        pw, inv = _powers(_MULT, total), _powers(_INV, total)
        prefix = np.concatenate([np.zeros(1, np.uint64), np.cumsum((data + np.uint64(1)) * pw[:total], dtype=np.uint64)])
        ends = np.flatnonzero(cut) + 1
        starts = np.concatenate([np.zeros(1, np.int64), ends[:-1]])
        h = (prefix[ends] - prefix[starts]) * inv[starts]
        size = ends - starts
        h = ws.mix(h + size.astype(np.uint64) * np.uint64(_MULT))
    owner = np.repeat(np.arange(len(texts)), lengths)[starts]
    return (h >> np.uint64(1)).view(np.int64), size, owner


def sketches(flat: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """SKETCH one-bit min-hashes of each word set, as rows of 64-bit words."""
    rng = np.random.RandomState(7)
    a, b = (rng.randint(0, 2**32, SKETCH, dtype=np.uint64).astype(np.uint32) for _ in range(2))
    out = np.zeros((len(counts), SKETCH // 8), np.uint8)
    some = np.flatnonzero(counts > 0)
    if len(some):
        x = (ws.mix(flat) >> np.uint64(32)).astype(np.uint32)
        y = x[:, None] * (a | np.uint32(1)) + b
        y ^= y >> np.uint32(15)
        y *= np.uint32(0x2C1B3C6D)
        least = np.minimum.reduceat(y, (np.cumsum(counts) - counts)[some], axis=0)
        out[some] = np.packbits(np.bitwise_count(least) & 1, axis=1)
    return out.view(np.int64)


def sketch_limit(t: float) -> int:
    """Bits two sketches may differ in; at Jaccard t about one pair in a thousand differs more."""
    p = (1 - t) / 2
    return int(SKETCH * p + SKETCH_SLACK * (SKETCH * p * (1 - p)) ** 0.5)


def _chunker(order: tuple[np.ndarray, np.ndarray], t: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for b in ws.slices(batches, 256):
            texts = b.column(1).to_pylist()
            flat, counts = ws.flat_hashes(texts)
            # chunks of the first copy that this task meets; its later copies share them
            hs = ws.set_hashes(flat, counts).tolist()
            if len(seen) > SEEN_CLASSES:
                seen.clear()
            first = [not (k in seen or seen.add(k)) for k in hs]
            h, size, owner = chunk_texts([t if f else None for t, f in zip(texts, first)])
            n = np.bincount(owner, minlength=len(texts)).astype(np.int64)
            sk = sketches(flat, counts)
            mine = np.where(first, counts, 0)
            p, kept = wl.prefixes(flat[np.repeat(first, counts)], mine, order, t)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(hs, pa.int64()), pa.array(counts.astype(np.int32)), pa.array(sk[:, 0]), pa.array(sk[:, 1]), ws.list_array(h, n), ws.list_array(size.astype(np.int32), n), ws.fp_array(ws.fingerprints(flat, counts)), ws.list_array(p, kept)],
                ["id", "h", "n", "s0", "s1", "chunks", "sizes", "fp", "prefix"],
            )

    return run


def chunk_records(texts: DataFrame, id_col: str, text: str, order: tuple[np.ndarray, np.ndarray], t: float) -> DataFrame:
    """(id, h, n, s0, s1, chunks, sizes, fp, prefix): sketch, chunk list, fingerprint and word prefix of every text with a word.

    Chunks and prefix are filled for the first copy that a task meets.
    """
    read = texts.select(F.col(id_col).cast("string").alias("id"), F.col(text).alias("text")).where("id is not null and text is not null")
    schema = "id string, h long, n int, s0 long, s1 long, chunks array<long>, sizes array<int>, fp binary, prefix array<long>"
    return read.mapInArrow(_chunker(order, t), schema).where("n > 0")


class ChunkIndex:
    """The persistent chunk-to-record table, kept as Parquet under ``path``.

    ``append`` adds the records of a batch and nothing else; ``candidates``
    compares a batch with all that was appended before it and with itself.
    Opening an existing path goes on with what it holds: the order of words
    (fixed when the index is made), postings by bucket, the records by class
    and the ids.  Records are word-set classes: exact copies share one entry.
    """

    RECORD = "h long, n int, s0 long, s1 long, chunks array<long>, sizes array<int>, fp binary, prefix array<long>"
    POSTING = "chunk long, h long, s0 long, s1 long, bucket int"

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS):
        self.spark, self.path, self.buckets = spark, path, buckets

    def _has(self, name: str) -> bool:
        sc = self.spark.sparkContext
        at = sc._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}/_SUCCESS")
        return at.getFileSystem(sc._jsc.hadoopConfiguration()).exists(at)

    def _read(self, name: str, schema: str) -> DataFrame:
        if not self._has(name):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.path}/{name}")

    def _write(self, rows: DataFrame, name: str, by: str | None = None) -> None:
        out = rows.write.mode("append").option("compression", "zstd")
        (out.partitionBy(by) if by else out).parquet(f"{self.path}/{name}")

    def order(self, texts: DataFrame, id_col: str, text: str) -> tuple[np.ndarray, np.ndarray]:
        """The order of words of this index; taken from ``texts`` when the index is new."""
        if not self._has("order"):
            w, rank = wl.word_order(texts, id_col, text)
            self._write(self.spark.createDataFrame(pa.table({"w": w, "rank": rank})), "order")
        rows = self._read("order", "w long, rank long").toPandas().sort_values("w")
        return rows["w"].to_numpy(np.int64), rows["rank"].to_numpy(np.int64)

    def append(self, records: DataFrame) -> None:
        """Adds the output of ``chunk_records``; the ids come last, so an append that breaks off is taken up again."""
        once = records.where(F.size("chunks") > 0)
        bucket = F.pmod("chunk", F.lit(self.buckets)).cast("int").alias("bucket")
        self._write(postings(once).select("*", bucket), "postings", "bucket")
        self._write(once.select("h", "n", "s0", "s1", "chunks", "sizes", "fp", "prefix"), "records")
        self._write(records.select("id", "h").distinct(), "ids")

    def ids(self) -> DataFrame:
        """(id, h) of every article with a word that was appended."""
        return self._read("ids", "id string, h long")

    def records(self) -> DataFrame:
        return self._read("records", self.RECORD)

    def table(self, buckets: list[int]) -> DataFrame:
        return self._read("postings", self.POSTING).where(F.col("bucket").isin(buckets)).drop("bucket")

    def candidates(self, asking: DataFrame, work: Workspace, t: float, coverage: float = COVERAGE, lookups: int = LOOKUPS) -> DataFrame:
        """(q, h, coverage): records sharing at least ``coverage`` of a batch text's bytes.

        ``asking`` has the records of the batch, which are not appended yet.
        The frequency of the batch's chunks is counted over table and batch and
        each batch text is looked up by its ``lookups`` rarest chunks that
        another record has; entries whose sketch rules out Jaccard ``t`` fall
        away in the join.  Coverage counts the shared bytes of all chunks.
        """
        own = asking.where(F.size("chunks") > 0).dropDuplicates(["h"])
        own = own.select(F.col("h").alias("q"), F.col("s0").alias("q0"), F.col("s1").alias("q1"), "chunks", "sizes")
        own = work.save(own, "batch_records")
        parts = work.save(postings(own.select(F.col("q").alias("h"), F.col("q0").alias("s0"), F.col("q1").alias("s1"), "chunks")), "batch_chunks")
        touched = [r[0] for r in parts.select(F.pmod("chunk", F.lit(self.buckets)).cast("int").alias("b")).distinct().collect()]
        everything = self.table(touched).unionByName(parts)
        mine = broadcast_if_small(parts.select("chunk").distinct(), parts.count(), 24)
        counted = everything.join(mine, "chunk", "left_semi").groupBy("chunk").agg(F.count("*").alias("df"), F.min("h").alias("low"), F.max("h").alias("high"))
        counted = counted.where("low <> high").select("chunk", "df")
        rarest = (
            parts.select(F.col("h").alias("q"), F.col("s0").alias("q0"), F.col("s1").alias("q1"), "chunk")
            .join(counted, "chunk")
            .groupBy("q", "q0", "q1")
            .agg(F.slice(F.array_sort(F.collect_list(F.struct("df", "chunk"))), 1, lookups).alias("p"))
            .select("q", "q0", "q1", F.explode("p.chunk").alias("chunk"))
        )
        rarest = work.save(rarest, "lookups")
        # the batch's lookups are the smaller side; sent whole only while they are known to be small
        asked = broadcast_if_small(rarest, rarest.count(), 48)
        differ = F.bit_count(F.col("s0").bitwiseXOR(F.col("q0"))) + F.bit_count(F.col("s1").bitwiseXOR(F.col("q1")))
        near = everything.join(asked, "chunk").where((F.col("q") != F.col("h")) & (differ <= sketch_limit(t))).select("q", "h").distinct()
        near = work.save(near, "chunk_pairs")
        theirs = self.records().select("h", "chunks").unionByName(own.select(F.col("q").alias("h"), "chunks")).select("h", F.col("chunks").alias("hc"))
        asked_h = near.select("h").distinct()
        theirs = theirs.join(broadcast_if_small(asked_h, near.count(), 24), "h", "left_semi").dropDuplicates(["h"])
        shared = F.expr("aggregate(arrays_zip(chunks, sizes), 0D, (s, c) -> s + if(array_contains(hc, c.chunks), c.sizes, 0))")
        total = F.expr("aggregate(sizes, 0D, (s, c) -> s + c)")
        covered = near.join(own.select("q", "chunks", "sizes"), "q").join(theirs, "h").withColumn("coverage", shared / total)
        return covered.where(F.col("coverage") >= coverage).select("q", "h", "coverage")


def postings(records: DataFrame) -> DataFrame:
    """(chunk, h, s0, s1): a row for each distinct chunk of each record."""
    return records.select(F.explode(F.array_distinct("chunks")).alias("chunk"), "h", "s0", "s1")
