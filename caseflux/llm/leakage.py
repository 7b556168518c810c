"""Problem 8: held-out passages inside training documents.

A prefix-filtered set join on word shingles.  The items are few and fixed, so
their shingles travel to the documents.  One pass notes which item shingles
stand where in each document and counts them over the corpus; an item's rarest
shingles are its prefix: a document that holds enough of the item must hold one
of them.  Documents with a prefix hit are then held against the length and
position bounds, and the survivors are verified word by word.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterable, Iterator
from difflib import SequenceMatcher
from functools import reduce
from itertools import repeat, zip_longest
from operator import or_

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseflux.llm import wordsets as ws
from caseflux.session import Workspace, broadcast_if_small

#: The densest edit allowed changes every fourth word, which leaves runs of three.
SHINGLE = 3
#: Share of an item's shingles that must stand close together. The least that the
#: rule leaves: pieces of seven words cut 2 + 3 + 2, one shingle each, half of the words.
LEAST_SHINGLES = 1 / 14
#: Share of an item's words that those shingles cover: three words of each such piece.
LEAST_COVERED = 3 / 14
#: Share of an item's words that must be carried.
LEAST_WORDS = 0.5
#: Pieces are close together within so many item lengths.
WINDOW = 2.0
#: Equal words that a piece (runs that single changed words part) must have to count.
RUN_WORDS = 7
_P = np.uint64(0x9E3779B97F4A7C15 | 1)


def word_list(text: str | None) -> list[str]:
    return ws.WORD.findall(text.lower()) if text else []


def _shingles(h: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k words from each place on, given the words' hashes."""
    out = np.zeros(len(at), np.uint64)
    with np.errstate(over="ignore"):
        for j in range(k):
            out = out * _P + h[at + j]
    return (ws.mix(out) >> np.uint64(1)).view(np.int64)


def shingle_hashes(words: list[str], k: int = SHINGLE) -> np.ndarray:
    """Hash of every window of k words, by position (a shorter text: its whole)."""
    if not words:
        return np.zeros(0, np.int64)
    h = np.array([ws.word_hash(w) for w in words], np.uint64)
    k = min(k, len(h))
    return _shingles(h, np.arange(len(h) - k + 1), k)


class ItemSet:
    """Shingles of the items: sorted distinct hashes, and items by shingle."""

    def __init__(self, items: list[tuple[int, str]], k: int = SHINGLE):
        self.ids = [i for i, _ in items]
        self.words = [word_list(t) for _, t in items]
        sets = [np.unique(shingle_hashes(w, k)) for w in self.words]
        self.size = np.array([len(s) for s in sets])
        self.length = np.array([len(w) for w in self.words])
        self.keys = np.unique(np.concatenate([*sets, np.zeros(0, np.int64)])).astype(np.int64)
        self.of_item = [np.searchsorted(self.keys, s) for s in sets]
        self.k = k
        self.masks = [word_masks(w) for w in self.words]
        # the words of the item that each of its shingles covers, as bits
        self.cover: list[dict[int, int]] = []
        for w in self.words:
            by: dict[int, int] = {}
            for p, x in enumerate(np.searchsorted(self.keys, shingle_hashes(w, k)).tolist()):
                by[x] = by.get(x, 0) | ((1 << min(k, len(w))) - 1) << p
            self.cover.append(by)

    def prefix(self, df: np.ndarray, share: float) -> dict[int, list[int]]:
        """Shingle -> items in whose prefix it is; rarest shingles first."""
        by: dict[int, list[int]] = {}
        for n, s in enumerate(self.of_item):
            need = max(1, int(np.ceil(share * len(s))))
            for x in s[np.lexsort((s, df[s]))][: len(s) - need + 1]:
                by.setdefault(int(x), []).append(n)
        return by


def _hits(items: ItemSet):
    keys, k = items.keys, items.k
    # a word that no item has stands in no shingle of one
    known = {w: ws.word_hash(w) for words in items.words for w in words}
    # a table by the last bits of the hash sorts out most shingles before the search
    low = np.int64((1 << max(16, int(32 * len(keys)).bit_length())) - 1)
    maybe = np.zeros(int(low) + 1, bool)
    maybe[keys & low] = True

    def places(words: list[str], counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places, in the words of all texts one after the other, at which item shingles begin; their numbers."""
        h = np.fromiter(map(known.get, words, repeat(-1)), np.int64, len(words))
        ends = np.cumsum(counts)
        whole = h >= 0
        begins = whole[: max(0, len(h) - k + 1)].copy()
        for j in range(1, k):
            begins &= whole[j : j + len(begins)]
        # nor does one begin so late that it runs into the next text
        for j in range(1, k):
            late = ends - j
            begins[late[(late >= 0) & (late < len(begins))]] = False
        p = np.flatnonzero(begins)
        out = _shingles(h.view(np.uint64), p, k)
        p, out = p[maybe[out & low]], out[maybe[out & low]]
        short = np.flatnonzero((counts > 0) & (counts < k))
        if len(short):  # a shorter text is one shingle
            first = ends[short] - counts[short]
            ok = np.array([whole[f:e].all() for f, e in zip(first, ends[short])])
            one = [_shingles(h.view(np.uint64), np.array([f]), int(e - f))[0] for f, e in zip(first[ok], ends[short][ok])]
            p, out = np.append(p, first[ok]), np.append(out, np.array(one, np.int64))
            by = np.argsort(p, kind="stable")
            p, out = p[by], out[by]
        at = np.searchsorted(keys, out).clip(0, len(keys) - 1)
        hit = keys[at] == out
        return p[hit], at[hit]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in ws.slices(batches, 512):
            words: list[str] = []
            counts = np.zeros(b.num_rows, np.int64)
            for i, t in enumerate(b.column(1).to_pylist()):
                found = word_list(t)
                counts[i] = len(found)
                words += found
            p, at = places(words, counts)
            ends = np.cumsum(counts)
            doc = np.searchsorted(ends, p, "right")
            c = np.bincount(doc, minlength=len(counts))
            some = np.flatnonzero(c)
            if len(some):
                p = p - (ends - counts)[doc]
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(some)), ws.list_array(at.astype(np.int32), c[some]), ws.list_array(p.astype(np.int32), c[some])], ["doc_id", "shingle", "position"])

    return run


def _windows(at: list[int], shingles: list[int], cover: dict[int, int], least: float, span: int) -> list[tuple[int, int]]:
    """First and last hit of each stretch whose shingles cover ``least`` words of the item.

    Blocks are two spans long and start every span, so one holds any window;
    blocks that follow each other become one stretch, others stay apart.
    """
    masks: dict[int, int] = {}
    for p, x in zip(at, shingles):
        k = p // span
        masks[k] = masks.get(k, 0) | cover[x]
    spans = sorted({b + j for k in masks for b in (k - 1, k) if (masks.get(b, 0) | masks.get(b + 1, 0)).bit_count() >= least for j in (0, 1)})
    out: list[tuple[int, int]] = []
    for k in spans:
        lo, hi = bisect_left(at, k * span), bisect_left(at, (k + 1) * span)
        if lo == hi:
            continue
        if out and k - out[-1][1] // span <= 1:
            out[-1] = (out[-1][0], at[hi - 1])
        else:
            out.append((at[lo], at[hi - 1]))
    return out


def _candidates(items: ItemSet, df: np.ndarray, share: float, window: float):
    """Documents and items that the prefix, length, coverage and position bounds leave."""
    prefix = items.prefix(df, share)
    flags = np.zeros(len(items.keys), bool)
    flags[list(prefix)] = True
    # every place of every shingle in the items, by shingle
    placed = [np.searchsorted(items.keys, shingle_hashes(w, items.k)) for w in items.words]
    shingle = np.concatenate([*placed, np.zeros(0, np.int64)])
    item = np.repeat(np.arange(len(placed)), [len(x) for x in placed])
    place = np.concatenate([*(np.arange(len(x)) for x in placed), np.zeros(0, np.int64)]).astype(np.int64)
    by = np.argsort(shingle, kind="stable")
    shingle, item, place = shingle[by], item[by], place[by]
    first = np.searchsorted(shingle, np.arange(len(items.keys) + 1))
    asks = np.array([n in prefix.get(x, ()) for x, n in zip(shingle.tolist(), item.tolist())], bool)
    needs = np.maximum(1, np.ceil(share * items.size)).astype(np.int64)
    covers = LEAST_COVERED * items.length
    width = int(items.length.max(initial=0)) + items.k

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            lists = b.column(1)
            offsets, flat, spots = lists.offsets.to_numpy().tolist(), lists.values.to_numpy(), b.column(2).values.to_numpy()
            for i, lo, hi in zip(b.column(0).to_pylist(), offsets, offsets[1:]):
                s, p = flat[lo:hi], spots[lo:hi]
                if not flags[s].any():
                    continue
                size = first[s + 1] - first[s]
                x = np.arange(int(size.sum())) + np.repeat(first[s] - (np.cumsum(size) - size), size)
                n = item[x]
                # length bound, and a shingle of the item's prefix
                enough = np.bincount(n, minlength=len(needs)) >= needs
                if not enough.any():
                    continue
                enough &= np.bincount(n[asks[x]], minlength=len(needs)) > 0
                some = np.flatnonzero(enough)
                if not len(some):
                    continue
                kept = np.flatnonzero(enough[n])
                n = n[kept]
                row = (np.cumsum(enough) - 1)[n] * width + place[x[kept]]
                covered = np.zeros(len(some) * width, bool)
                for j in range(items.k):
                    covered[row + j] = True
                enough[some] = covered.reshape(len(some), width).sum(axis=1) >= covers[some]
                still = enough[n]
                if not still.any():
                    continue
                n, hit = n[still], np.repeat(np.arange(len(s)), size)[kept[still]]
                order = np.argsort(n, kind="stable")
                n, hit = n[order], hit[order]
                cuts = np.flatnonzero(np.diff(n)) + 1
                for one, ks in zip(n[np.concatenate([[0], cuts])].tolist(), np.split(hit, cuts)):
                    need, at = int(needs[one]), p[ks]
                    span = int(window * items.length[one]) + 1
                    if at[-1] - at[0] <= 2 * span:
                        out.append((i, one, at[0], at[-1]))
                    # position bound: enough of the item's shingles within one window
                    elif (at[need - 1 :] - at[: len(at) - need + 1] <= span).any():
                        out += [(i, one, *w) for w in _windows(at.tolist(), s[ks].tolist(), items.cover[one], covers[one], span)]
            if out:
                a = [pa.array(c) for c in zip(*out)]
                yield pa.RecordBatch.from_arrays([a[0].cast(pa.int64()), a[1].cast(pa.int32()), a[2].cast(pa.int32()), a[3].cast(pa.int32())], ["doc_id", "item", "first", "last"])

    return run


def word_masks(item: list[str]) -> dict[str, int]:
    """The places of each word of the item, as bits."""
    at: dict[str, int] = {}
    for k, w in enumerate(item):
        at[w] = at.get(w, 0) | 1 << k
    return at


def in_order(masks: Iterable[int], n: int) -> int:
    """Length of the longest common subsequence with an item of n words, by bit vectors."""
    full = v = (1 << n) - 1
    for m in masks:
        x = v & m
        if x:
            v = (v + x | v & ~m) & full
    return n - v.bit_count()


def _pieces(masks: list[int | None], least: int) -> int:
    """The places of the item, as bits, that stand in some piece of ``least`` words or more.

    ``masks``: the places of each word of the text in the item.  Level r of a word
    holds the places at which r words of a piece end (or, from behind, begin).
    """

    def levels(rows: list[int | None], back: bool) -> list[list[int]]:
        out: list[list[int]] = []
        one: list[int] = []
        two: list[int] = []
        for m in rows:
            now: list[int] = []
            if m:
                now.append(m)
                for u, v in zip_longest(one[: least - 1], two[: least - 1], fillvalue=0):
                    u |= v
                    m &= u >> 1 | u >> 2 if back else u << 1 | u << 2
                    if not m:
                        break
                    now.append(m)
            out.append(now)
            one, two = now, one
        return out

    ahead = levels(masks, False)
    if not any(len(x) >= least for x in ahead):
        return 0
    behind = levels(masks[::-1], True)[::-1]
    held = 0
    for x, y in zip(ahead, behind):
        if len(x) + len(y) > least:
            for r in range(max(1, least + 1 - len(y)), min(least, len(x)) + 1):
                held |= x[r - 1] & y[least - r]
    return held


def _greedy(item: list[str], part: list[str], least: int) -> int:
    total, piece, last = 0, 0, None
    for m in SequenceMatcher(None, item, part, autojunk=False).get_matching_blocks():
        if last and m.size and m.a - last.a - last.size <= 1 and m.b - last.b - last.size <= 1:
            piece += m.size
        else:
            total += piece if piece >= least else 0
            piece = m.size
        last = m
    return total + (piece if piece >= least else 0)


def _aligned(item: list[str], part: list[str], least: int) -> int:
    """Most words that pieces of at least ``least`` words hold in order (exact).

    v[r] holds, by place in the text, the best total with r words (``least``: or
    more) in the current piece; closed holds the best total up to a place.
    """
    none = -(1 << 20)
    code = {w: k for k, w in enumerate(dict.fromkeys(item))}
    y = np.array([code.get(w, -1) for w in part])
    width = len(part)
    closed = np.zeros(width + 1, np.int64)
    one = two = np.full((least + 1, width), none)
    for w in item:
        at = np.flatnonzero(y == code[w])
        v = np.full((least + 1, width), none)
        if len(at):
            before = np.full((least + 1, len(at)), none)
            for row in (one, two):
                for back in (1, 2):
                    ok = at >= back
                    before[:, ok] = np.maximum(before[:, ok], row[:, at[ok] - back])
            new = np.full((least + 1, len(at)), none)
            new[1] = closed[at] + (1 if least == 1 else 0)
            new[2:] = before[1:-1]
            if least > 1:
                new[least] += least
            new[least] = np.maximum(new[least], before[least] + 1)
            v[:, at] = new
        two, one = one, v
        closed[1:] = np.maximum(closed[1:], np.maximum.accumulate(v[least]))
    return int(closed[-1])


def carried_share(item: list[str], text: list[str], window: float = WINDOW, floor: float = 0.0, at: dict[str, int] | None = None) -> float:
    """Largest share of the item's words that some window of the text has in order.

    Runs that a single changed word parts are one piece; pieces of RUN_WORDS
    equal words count.  Windows whose longest common subsequence is below
    ``floor`` of the item, or whose pieces hold less of it, are left out: they cannot reach it.  ``at`` has the
    item's ``word_masks``, where known.
    """
    best, n = 0, len(item)
    if not n:
        return 0.0
    least = min(RUN_WORDS, n)
    size = max(n + 2 * SHINGLE, int(window * n))
    step = max(1, size // 8)
    at = word_masks(item) if at is None else at
    found = list(map(at.get, text))
    masks = list(filter(None, found))
    # nor can any part of the text where the whole stays below
    if len(masks) < floor * n or reduce(or_, masks, 0).bit_count() < floor * n or in_order(masks, n) < floor * n:
        return 0.0
    places = [k for k, m in enumerate(found) if m]
    for start in range(0, max(1, len(text) - size + step), step):
        lo, hi = bisect_left(places, start), bisect_left(places, start + size)
        if hi - lo <= best or hi - lo < floor * n:
            continue
        bound = in_order(masks[lo:hi], n)
        if bound <= best or bound < floor * n:
            continue
        # both alignments hold words of pieces alone
        if floor and _pieces(found[start : start + size], least).bit_count() < floor * n:
            continue
        part = text[start : start + size]
        best = max(best, _greedy(item, part, least))
        if best < floor * n:  # the greedy blocks may miss the best alignment
            best = max(best, _aligned(item, part, least))
    return best / n


def _verify(items: ItemSet, least: float, window: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out_d, out_i, out_s = [], [], []
            for i, t, found in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
                words = word_list(t)
                for f in found:
                    item = items.words[f["item"]]
                    lo, hi = max(0, f["first"] - len(item)), f["last"] + len(item) + SHINGLE
                    share = carried_share(item, words[lo:hi], window, least, items.masks[f["item"]])
                    if share >= least:
                        out_d.append(i), out_i.append(items.ids[f["item"]]), out_s.append(share)
            yield pa.RecordBatch.from_arrays([pa.array(out_d, pa.int64()), pa.array(out_i, pa.int64()), pa.array(out_s, pa.float64())], ["doc_id", "item_id", "carried"])

    return run


def find_leaks(documents: DataFrame, items: DataFrame, work: Workspace, least: float = LEAST_WORDS, share: float = LEAST_SHINGLES, window: float = WINDOW) -> DataFrame:
    """(doc_id, item_id, carried): documents that carry at least ``least`` of an item.

    Items are a small fixed set and are read to the driver (their texts must
    fit 32 MB, else an error).  Null or wordless texts and items match nothing;
    repeated rows of a document or item count once.
    """
    rows = items.where("item_id is not null and item_text is not null").select("item_id", "item_text").distinct()
    if (rows.agg(F.sum(F.octet_length("item_text"))).first()[0] or 0) > 32 << 20:
        raise ValueError("the item set is too large to be sent to every executor; search it in parts")
    listed = ItemSet(sorted((r[0], r[1]) for r in rows.collect() if word_list(r[1])))
    read = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id is not null and text is not null")
    if not len(listed.keys):
        return read.select("doc_id", F.lit(0).cast("long").alias("item_id"), F.lit(0.0).alias("carried")).where("false")
    hits = work.save(read.mapInArrow(_hits(listed), "doc_id long, shingle array<int>, position array<int>"), "hits")
    counted = hits.select(F.explode(F.array_distinct("shingle")).alias("s")).groupBy("s").agg(F.count("*").alias("df")).toPandas()
    df = np.zeros(len(listed.keys), np.int64)
    df[counted["s"].to_numpy(np.int64)] = counted["df"].to_numpy(np.int64)
    near = hits.mapInArrow(_candidates(listed, df, share, window), "doc_id long, item int, first int, last int")
    near = work.save(near.groupBy("doc_id").agg(F.collect_set(F.struct("item", "first", "last")).alias("found")), "near")
    n, found = near.agg(F.count("*"), F.coalesce(F.sum(F.size("found")), F.lit(0))).first()
    # the documents of the candidates are read again; a broad net is joined by shuffle
    asked = broadcast_if_small(near.select("doc_id", "found"), n * 48 + found * 32, 1)
    texts = read.join(asked, "doc_id").select("doc_id", "text", "found")
    found = texts.mapInArrow(_verify(listed, least, window), "doc_id long, item_id long, carried double")
    return found.groupBy("doc_id", "item_id").agg(F.max("carried").alias("carried"))
