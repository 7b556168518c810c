"""Problem 3: near-duplicate records with small edits, by vantage-point trees.

Plan
----
1. ``describe``: one pass over the texts gives the set hash, the number of
   words, a 256-bit parity fingerprint and the prefix of the set: its first
   n - ceil(t n) + 1 words in one order of all words, frequent ones last.  Exact
   copies (equal word sets) fall into one class.
2. Shards: each class enters the shard of every word of its prefix.  Two sets at
   Jaccard ``t`` have the first word they share in both prefixes, whatever the
   order, so they meet (prefix filter); the order, from a sample, decides the
   cost alone.  A shard above ``shard_rows`` is cut into parts, of which any two meet.
3. In each shard vantage-point trees over the fingerprints of one stretch of
   lengths answer the range queries.  The radius follows from the Jaccard limit
   and the triangle inequality leaves out branches, so no pair is lost; members
   whose place in the prefix and length rule each other out need not meet.
4. Pairs within the Hamming bound are verified on the exact word sets.

No bound loses a pair.  The price: unrelated texts are about equally far apart,
trees leave out little, and the rows of a word are compared with each other, a
cost that grows with their square where the vocabulary stays the same.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseflux.llm import vptree as vp
from caseflux.llm import wordlookup as wl
from caseflux.llm import wordsets as ws
from caseflux.session import Workspace, broadcast_if_small

THRESHOLD = 0.6
#: Rows of a word up to which they make one shard; those of a more frequent word are cut into parts.
SHARD_ROWS = 32_768
#: Postings that a task searches, where shards are not larger.
TASK_ROWS = 300_000
#: Copies of one class that meet in one task when all pairs of ids are asked for.
COPY_ROWS = 2048


def _describer(order: tuple[np.ndarray, np.ndarray], t: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for b in ws.slices(batches, 256):
            flat, counts = ws.flat_hashes(b.column(1).to_pylist())
            h = ws.set_hashes(flat, counts)
            first = np.zeros(len(counts), bool)
            for i, x in enumerate(h.tolist()):
                if counts[i] and x not in seen:
                    seen.add(x)
                    first[i] = True
            words, kept = wl.prefixes(flat[np.repeat(first, counts)], np.where(first, counts, 0), order, t)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(h), pa.array(counts.astype(np.int32)), ws.fp_array(ws.fingerprints(flat, counts)), ws.list_array(words, kept)],
                ["id", "h", "n", "fp", "prefix"],
            )

    return run


def describe(texts: DataFrame, id_col: str, text: str, work: Workspace, t: float = THRESHOLD) -> tuple[DataFrame, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(described rows, durable; ranked words).

    ``prefix`` is filled for the first row of each word set in a task only;
    copies carry the set hash alone.
    """
    texts = texts.select(F.col(id_col).cast("string").alias("id"), F.col(text).alias("text")).where("id is not null")
    ranked = wl.ranked_words(texts, "id", "text")
    described = work.save(texts.mapInArrow(_describer(ranked[:2], t), "id string, h long, n int, fp binary, prefix array<long>"), "described")
    return described, ranked


def longest_partner(n: np.ndarray, place: np.ndarray, t: float) -> np.ndarray:
    """Most words of a set whose first word in common with one of ``n`` words stands at ``place`` there.

    From that place on the two share t / (1 + t) of the words of both, or more.
    """
    return np.floor((n - place) * (1 + t) / t - n + 1e-6).astype(np.int64)


def _postings(hot: tuple[np.ndarray, np.ndarray], t: float):
    keys, parts_of = hot

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in ws.slices(batches, 4096):
            lists = b.column(3)
            counts = np.diff(lists.offsets.to_numpy())
            w = lists.flatten().to_numpy(zero_copy_only=False)
            doc = np.repeat(np.arange(len(counts)), counts)
            place = np.arange(len(w)) - np.repeat(np.cumsum(counts) - counts, counts)
            h, n, fp = b.column(0).to_numpy(zero_copy_only=False), b.column(1).to_numpy(zero_copy_only=False).astype(np.int64), ws.fp_words(b.column(2))
            most = longest_partner(n[doc], place, t)
            # the shards of a frequent word: its rows by hash in parts, a shard for any two of them
            parts = np.ones(len(w), np.int64)
            if len(keys):
                at = np.searchsorted(keys, w).clip(0, len(keys) - 1)
                parts = np.where(keys[at] == w, parts_of[at], 1)
            part = (ws.mix(h.view(np.uint64))[doc] % parts.astype(np.uint64)).astype(np.int64)
            other = np.arange(int(parts.sum())) - np.repeat(np.cumsum(parts) - parts, parts)
            w, doc, most, part, parts = (np.repeat(x, parts) for x in (w, doc, most, part, parts))
            low, high = np.minimum(part, other), np.maximum(part, other)
            with np.errstate(over="ignore"):
                cell = ws.mix(w.view(np.uint64) + ws.mix((low * parts + high).astype(np.uint64) + np.uint64(1))).view(np.int64)
            side = np.where(low == high, 0, np.where(part == low, 1, 2))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.where(parts > 1, cell, w)), pa.array(h[doc]), *(pa.array(x.astype(np.int32)) for x in (n[doc], most, side)), *(pa.array(fp[:, k].view(np.int64)[doc]) for k in range(4))],
                ["shard", "h", "n", "most", "side", "f0", "f1", "f2", "f3"],
            )

    return run


def _search_shards(t: float):
    def pairs(h: np.ndarray, i: np.ndarray, j: np.ndarray) -> Iterator[pa.RecordBatch]:
        lo, hi = np.minimum(h[i], h[j]), np.maximum(h[i], h[j])
        two = np.unique(np.stack([lo, hi], 1)[lo != hi], axis=0)
        if len(two):
            yield pa.RecordBatch.from_arrays([pa.array(two[:, 0]), pa.array(two[:, 1])], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # a task holds about TASK_ROWS postings, and no shard above twice SHARD_ROWS but for the error of the estimate
        read = [b for b in batches if b.num_rows]
        if not read:
            return
        shard, h, n, most, side, *f = (np.concatenate([b.column(k).to_numpy(zero_copy_only=False) for b in read]) for k in range(9))
        del read
        by = np.lexsort((h, shard))
        # copies of a class that several tasks described stand once
        by = by[np.concatenate([[True], (np.diff(shard[by]) != 0) | (np.diff(h[by]) != 0)])]
        shard, h, side = shard[by], h[by], side[by]
        n, most = n[by].astype(np.int64), most[by].astype(np.int64)
        fp = np.stack([x[by].view(np.uint64) for x in f], 1)
        starts = np.flatnonzero(np.concatenate([[True], np.diff(shard) != 0]))
        counts = np.diff(np.append(starts, len(shard)))
        small = (counts <= vp.LEAF) & (side[starts] == 0)
        for i, j in vp.small_shard_pairs(fp, n, starts[small], counts[small], t):
            yield from pairs(h, i, j)
        for s, c in zip(starts[~small].tolist(), counts[~small].tolist()):
            at = slice(s, s + c)
            i, j = vp.range_pairs(fp[at], n[at], most[at], t, side[at] if side[s] else None)
            yield from pairs(h[at], i, j)

    return run


def candidate_pairs(described: DataFrame, ranked: tuple[np.ndarray, np.ndarray, np.ndarray], t: float = THRESHOLD, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(a, b): set hashes within the Hamming bound in some shard, once each."""
    points = described.where("size(prefix) > 0")
    words, _, rows = ranked
    often = rows > shard_rows
    hot = words[often], -(-rows[often] // shard_rows)
    postings = points.select("h", "n", "fp", "prefix").mapInArrow(_postings(hot, t), "shard long, h long, n int, most int, side int, f0 long, f1 long, f2 long, f3 long")
    total = points.agg(F.sum(F.size("prefix"))).first()[0] or 0
    tasks = max(int(described.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // TASK_ROWS))
    return postings.repartition(tasks, "shard").mapInArrow(_search_shards(t), "a long, b long").distinct()


def _word_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in ws.slices(batches):
        flat, counts = ws.flat_hashes(b.column(0).to_pylist())
        yield pa.RecordBatch.from_arrays([pa.array(ws.set_hashes(flat, counts)), ws.list_array(flat.view(np.int64), counts)], ["h", "words"])


def verify(pairs: DataFrame, described: DataFrame, texts: DataFrame, id_col: str, text: str, work: Workspace, t: float = THRESHOLD) -> DataFrame:
    """(a, b, similarity) of the class pairs whose exact Jaccard is at least ``t``."""
    pairs = work.save(pairs, "candidates")
    needed = pairs.select(F.col("a").alias("h")).union(pairs.select("b")).distinct()
    reps = described.join(needed, "h").groupBy("h").agg(F.min("id").alias("id"))
    reps = work.save(reps, "representatives")
    n = reps.count()
    read = texts.select(F.col(id_col).cast("string").alias("id"), F.col(text).alias("text"))
    read = read.join(broadcast_if_small(reps.select("id"), n, 80), "id", "left_semi")
    words = read.select("text").mapInArrow(_word_lists, "h long, words array<long>").dropDuplicates(["h"])
    words = work.save(words, "pair_words")
    left = words.select(F.col("h").alias("a"), F.col("words").alias("wa"))
    right = words.select(F.col("h").alias("b"), F.col("words").alias("wb"))
    both = F.size(F.array_intersect("wa", "wb")).cast("double")
    joined = pairs.join(left, "a").join(right, "b").withColumn("both", both)
    sim = F.col("both") / (F.size("wa") + F.size("wb") - F.col("both"))
    return joined.select("a", "b", sim.alias("similarity")).where(F.col("similarity") >= t)


def near_duplicate_classes(texts: DataFrame, id_col: str, text: str, work: Workspace, t: float = THRESHOLD, shard_rows: int = SHARD_ROWS) -> tuple[DataFrame, DataFrame]:
    """(membership, links) of the texts.

    membership: (id, h), one row for each id and word set, ``h`` its class.
    links: (a, b, similarity), the classes a < b whose words overlap by ``t``.

    Null, empty and wordless texts belong to no class; null ids are left out;
    repeated rows count once; ties do not matter, all links are given.
    """
    described, ranked = describe(texts, id_col, text, work, t)
    pairs = candidate_pairs(described, ranked, t, shard_rows)
    links = work.save(verify(pairs, described, texts, id_col, text, work, t), "links")
    members = described.where("n > 0").select("id", "h").distinct()
    return members, links


def near_duplicate_pairs(texts: DataFrame, id_col: str, text: str, work: Workspace, t: float = THRESHOLD, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(left_id, right_id), left_id < right_id as text: all near-duplicate ids."""
    members, links = near_duplicate_classes(texts, id_col, text, work, t, shard_rows)
    members = work.save(members, "members")
    m1, m2 = members.select(F.col("id").alias("i"), F.col("h").alias("a")), members.select(F.col("id").alias("j"), F.col("h").alias("b"))
    across = links.select("a", "b").join(m1, "a").join(m2, "b").select("i", "j")
    # a class of many copies is cut into parts: each part meets every copy in a task of its own
    shared = members.groupBy("h").agg(F.ceil(F.count("*") / COPY_ROWS).cast("int").alias("parts"), F.count("*").alias("c")).where("c > 1").drop("c")
    copies = members.join(shared, "h")
    own = copies.select("h", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int").alias("part"), F.col("id").alias("i"))
    every = copies.select("h", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.col("id").alias("j"))
    inside = own.join(every, ["h", "part"]).where("i < j").select("i", "j")
    pairs = across.unionByName(inside).where("i <> j")
    return pairs.select(F.least("i", "j").alias("left_id"), F.greatest("i", "j").alias("right_id")).distinct()


def _compare_rows(t: float):
    ratio = vp.limit_ratio(t)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in ws.slices(batches):
            left, right = b.column(2).to_pylist(), b.column(3).to_pylist()
            fl, cl = ws.flat_hashes(left)
            fr, cr = ws.flat_hashes(right)
            d = vp.hamming(*(ws.fingerprints(f, c).view(np.uint64) for f, c in ((fl, cl), (fr, cr))))
            near = (d <= ratio * (cl + cr)) & (cl > 0) & (cr > 0)
            sim = np.array([ws.jaccard(left[i], right[i]) if near[i] else 0.0 for i in range(len(left))])
            keep = pa.array(sim >= t)
            yield pa.RecordBatch.from_arrays([b.column(0).filter(keep), b.column(1).filter(keep)], ["left_id", "right_id"])

    return run


def near_duplicate_sides(rows: DataFrame, left_id: str, right_id: str, left: str, right: str, t: float = THRESHOLD) -> DataFrame:
    """(left_id, right_id) of the rows whose two texts are near-duplicates.

    The Hamming bound on the fingerprints comes first, the exact sets follow.
    Rows with a null id or a wordless side are no pair; repeats count once.
    """
    read = rows.select(*(F.col(c).cast("string") for c in (left_id, right_id)), left, right).where(F.col(left_id).isNotNull() & F.col(right_id).isNotNull())
    pairs = read.mapInArrow(_compare_rows(t), "left_id string, right_id string")
    return pairs.where("left_id <> right_id").select(F.least("left_id", "right_id").alias("left_id"), F.greatest("left_id", "right_id").alias("right_id")).distinct()
