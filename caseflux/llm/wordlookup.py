"""Exact lookup of texts by their words, blind to word order (problem 1).

Prefix filter: with the words of all sets in one fixed order, two sets of n and
m words at Jaccard ``t`` share ``o = ceil(t / (1 + t) * (n + m))`` words, so the
first of these stands within the first n - o + 1 words of one and the first
m - o + 1 of the other.  The order has frequent words last; any order gives the
same result, so it is taken from a sample.  Shared words are looked up by the
length band of the asking set, then the positions and the Hamming bound of the
parity fingerprints sort out the rest.  None of these bounds loses a pair.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseflux.llm import vptree as vp
from caseflux.llm import wordsets as ws
from caseflux.session import Workspace

#: Frequent words that are put in order of frequency; the others come before them, by hash.
ORDERED_WORDS = 65_536
#: One row in so many is counted for the order.
SAMPLE = 8
#: Ratio of the longest to the shortest set of a length band.
BAND = 1.15
#: Asking sets that one pass over the history takes along (about 550 bytes each for texts of 76 words).
PASS_SETS = 80_000
#: Matches expanded at once.
MATCHES = 1 << 17


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        flat, counts = ws.flat_hashes(b.column(0).to_pylist())
        if not len(flat):
            continue
        h = np.repeat(ws.set_hashes(flat, counts), counts)
        order = np.argsort(flat, kind="stable")
        w, starts, n = np.unique(flat[order], return_index=True, return_counts=True)
        low, high = np.minimum.reduceat(h[order], starts), np.maximum.reduceat(h[order], starts)
        yield pa.RecordBatch.from_arrays([pa.array(w.view(np.int64)), pa.array(n), pa.array(low), pa.array(high)], ["w", "df", "low", "high"])


def word_counts(texts: DataFrame, text: str) -> DataFrame:
    """(w, df): rows of ``texts`` with each word (its hash), for words of two or more word sets.

    A word of one set alone, however often that set is repeated, ties nothing.
    """
    part = texts.select(text).mapInArrow(_count_words, "w long, df long, low long, high long")
    counts = part.groupBy("w").agg(F.sum("df").alias("df"), F.min("low").alias("low"), F.max("high").alias("high"))
    return counts.where("low <> high").select("w", "df")


def ranked_words(texts: DataFrame, id_col: str, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word hashes, sorted; their ranks from 1, frequent words last; their rows, estimated)."""
    part = texts.where(F.pmod(F.xxhash64(id_col), F.lit(SAMPLE)) == 0)
    rows = word_counts(part, text).orderBy(F.desc("df"), "w").limit(ORDERED_WORDS).toPandas()
    w = rows["w"].to_numpy(np.int64) if len(rows) else np.zeros(0, np.int64)
    df = rows["df"].to_numpy(np.int64) if len(rows) else np.zeros(0, np.int64)
    by = np.argsort(w)
    return w[by], (len(w) - np.arange(len(w)))[by], df[by] * SAMPLE


def word_order(texts: DataFrame, id_col: str, text: str) -> tuple[np.ndarray, np.ndarray]:
    """(word hashes, sorted; their ranks from 1), frequent words last."""
    return ranked_words(texts, id_col, text)[:2]


def need(n, m, t: float):
    """Words that sets of n and m words share at least at Jaccard ``t``."""
    return np.ceil(t / (1 + t) * (n + m) - 1e-9).astype(np.int64)


def prefixes(flat: np.ndarray, counts: np.ndarray, order: tuple[np.ndarray, np.ndarray], t: float) -> tuple[np.ndarray, np.ndarray]:
    """(words, counts): the first words of each set in the order, as many as any partner can ask for."""
    keys, ranks = order
    f = flat.view(np.int64)
    rank = np.zeros(len(f), np.int64)
    if len(keys):
        at = np.searchsorted(keys, f).clip(0, len(keys) - 1)
        rank = np.where(keys[at] == f, ranks[at], 0)
    doc = np.repeat(np.arange(len(counts)), counts)
    if len(counts) <= 256:  # one key instead of three: document, frequent or not, rank or hash
        low = np.where(rank > 0, rank.astype(np.uint64) | np.uint64(1 << 54), flat >> np.uint64(9))
        f = f[np.argsort(doc.astype(np.uint64) << np.uint64(55) | low)]
    else:
        f = f[np.lexsort((f >> 9, rank, doc))]
    keep = np.where(counts > 0, counts - np.ceil(t * counts - 1e-9).astype(np.int64) + 1, 0)
    place = np.arange(len(f)) - np.repeat(np.cumsum(counts) - counts, counts)
    return f[place < np.repeat(keep, counts)], keep


def _band(n: np.ndarray) -> np.ndarray:
    return np.floor(np.log(np.maximum(n, 1)) / np.log(BAND)).astype(np.int64)


class Postings:
    """Prefix words of the asking sets: entries by (word, band), ordered by place."""

    def __init__(self, h: np.ndarray, n: np.ndarray, fp: np.ndarray, words: np.ndarray, counts: np.ndarray, t: float):
        self.h, self.n, self.fp, self.t = h, n, fp, t
        ask = np.repeat(np.arange(len(n)), counts)
        place = np.arange(len(words)) - np.repeat(np.cumsum(counts) - counts, counts)
        bands, band = np.unique(_band(n), return_inverse=True)
        self.bands = [(int(n[band == b].min()), int(n[band == b].max())) for b in range(len(bands))]
        self.most = int(counts.max()) + 1
        self.words = np.unique(words)
        key = (np.searchsorted(self.words, words) * len(bands) + band[ask]) * self.most + place
        by = np.argsort(key, kind="stable")
        self.key, self.ask = key[by], ask[by].astype(np.int32)
        self.first = np.searchsorted(self.key, np.arange(len(self.words) * len(bands) + 1) * self.most)
        self.halves = [np.ascontiguousarray(fp[:, c]) for c in (0, 1)]

    def pairs(self, h: np.ndarray, m: np.ndarray, fp: np.ndarray, words: np.ndarray, counts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(asking hash, record hash) of the pairs that no bound rules out."""
        doc = np.repeat(np.arange(len(m)), counts)
        place = np.arange(len(words)) - np.repeat(np.cumsum(counts) - counts, counts)
        at = np.searchsorted(self.words, words).clip(0, len(self.words) - 1)
        known = self.words[at] == words
        doc, place, at = doc[known], place[known], at[known]
        ratio = vp.limit_ratio(self.t)
        n32, own0, own1 = self.n.astype(np.float32), fp[:, 0], fp[:, 1]
        for b, (low, high) in enumerate(self.bands):
            least, last = m - need(low, m, self.t), high - need(high, m, self.t)
            k = np.flatnonzero((place <= least[doc]) & (last[doc] >= 0))
            cell = at[k] * len(self.bands) + b
            lo = self.first[cell]
            some = self.first[cell + 1] > lo
            k, lo, cell = k[some], lo[some], cell[some]
            hi = np.searchsorted(self.key, cell * self.most + np.minimum(last[doc[k]], self.most - 1), "right")
            some = hi > lo
            k, lo, size = k[some], lo[some], (hi - lo)[some]
            # cut so that about MATCHES are expanded at once
            cuts = np.flatnonzero(np.diff(np.cumsum(size) // MATCHES)) + 1
            for k, lo, size in zip(np.split(k, cuts), np.split(lo, cuts), np.split(size, cuts)):
                d = doc[k]
                x = np.arange(int(size.sum())) + np.repeat(lo - (np.cumsum(size) - size), size)
                q = self.ask[x]
                # half of the fingerprint sorts out nearly all; a part never exceeds the whole distance
                far = np.bitwise_count(self.halves[0][q] ^ np.repeat(own0[d], size)) + np.bitwise_count(self.halves[1][q] ^ np.repeat(own1[d], size))
                near = np.flatnonzero(far <= ratio * (n32[q] + np.repeat(m[d].astype(np.float32), size)) + np.float32(0.01))
                if len(near):
                    q, d = q[near], np.repeat(d, size)[near]
                    keep = (vp.hamming(self.fp[q], fp[d]) <= ratio * (self.n[q] + m[d]) + 1e-9) & (self.h[q] != h[d])
                    yield self.h[q[keep]], h[d[keep]]


def _columns(b: pa.RecordBatch):
    lists = b.column(3)
    return b.column(0).to_numpy(zero_copy_only=False), b.column(1).to_numpy(zero_copy_only=False).astype(np.int64), ws.fp_words(b.column(2)), lists.flatten().to_numpy(zero_copy_only=False), np.diff(lists.offsets.to_numpy())


def _lookup(postings: Postings):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in ws.slices(batches, 1024):
            if not b.num_rows:
                continue
            found = list(postings.pairs(*_columns(b)))
            if sum(len(q) for q, _ in found):
                two = np.unique(np.stack([np.concatenate(x) for x in zip(*found)], 1), axis=0)
                yield pa.RecordBatch.from_arrays([pa.array(two[:, 0]), pa.array(two[:, 1])], ["q", "h"])

    return run


def lookup(asking: DataFrame, records: DataFrame, work: Workspace, t: float) -> DataFrame:
    """(q, h): classes of ``records`` that may reach ``t`` with a class of ``asking``; none that does is lost.

    Both have (h, n, fp, prefix).  The asking side goes along in passes of
    bounded size; a class may be given several times.
    """
    asking = asking.select("h", "n", "fp", "prefix").dropDuplicates(["h"])
    asking = work.save(asking, "asking")
    passes = -(-asking.count() // PASS_SETS)
    out = []
    for k in range(passes):
        part = asking.where(F.pmod(F.xxhash64("h"), F.lit(passes)) == k).toArrow().combine_chunks().to_batches()
        if part:
            found = records.select("h", "n", "fp", "prefix").mapInArrow(_lookup(Postings(*_columns(part[0]), t)), "q long, h long")
            out.append(work.save(found, f"word_pairs_{k}"))
    if not out:
        return asking.select(F.col("h").alias("q"), "h").where("false")
    return reduce(DataFrame.unionByName, out).distinct()
